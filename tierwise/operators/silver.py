"""Silver models: rename, trim, (tolerant) cast, stamp.

* contracts: strict casts - a bad value raises under ANSI and fails the run.
* budgets / change orders: tolerant casts - a bad value becomes NULL; only
  the timestamps are trimmed, dates and amounts are cast as delivered.

All three are narrow projections: no shuffle, fused into the scan's
whole-stage-codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.functions.casts import (
    safe_date, safe_money, safe_timestamp, strict_date, strict_money,
)
from tierwise.functions.metrics import stamp


def contracts_silver(bronze: DataFrame, run_ts=None) -> DataFrame:
    return bronze.select(
        "contract_id",
        "contract_name",
        "client_name",
        strict_date("start_date").alias("start_date"),
        strict_date("end_date").alias("end_date"),
        strict_money("contract_value").alias("contract_value"),
        "contract_status",
        stamp(run_ts).alias("processed_at"),
    )


def budgets_silver(bronze: DataFrame, run_ts=None) -> DataFrame:
    return bronze.select(
        F.col("id").alias("budget_id"),
        F.col("name").alias("budget_name"),
        F.col("contractId").alias("contract_id"),
        F.col("code").alias("budget_code"),
        F.col("scope").alias("budget_scope"),
        safe_date("plannedStartDate").alias("planned_start_date"),
        safe_date("plannedEndDate").alias("planned_end_date"),
        safe_date("actualStartDate").alias("actual_start_date"),
        safe_date("actualEndDate").alias("actual_end_date"),
        safe_money("originalAmount").alias("original_amount"),
        safe_money("actualCost").alias("actual_cost"),
        safe_timestamp("createdAt").alias("created_at"),
        safe_timestamp("updatedAt").alias("updated_at"),
        stamp(run_ts).alias("processed_at"),
    )


def change_orders_silver(bronze: DataFrame, run_ts=None) -> DataFrame:
    return bronze.select(
        F.col("id").alias("change_order_id"),
        F.col("number").alias("change_order_number"),   # text: keeps leading zeros
        F.col("name").alias("change_order_name"),
        F.col("scope").alias("change_order_scope"),
        F.col("type").alias("change_order_type"),
        F.col("contractId").alias("contract_id"),
        safe_money("estimated").alias("estimated_amount"),
        safe_money("proposed").alias("proposed_amount"),
        safe_money("submitted").alias("submitted_amount"),
        safe_money("approved").alias("approved_amount"),
        safe_money("committed").alias("committed_amount"),
        safe_timestamp("createdAt").alias("created_at"),
        safe_timestamp("updatedAt").alias("updated_at"),
        safe_timestamp("statusChangedAt").alias("status_changed_at"),
        stamp(run_ts).alias("processed_at"),
    )


# ------------------------------------------------------- layout by month

#: Partition column of silver tables that are laid out by month.
MONTH_KEY = "month_key"
#: Years with partitions of their own; 0 takes all other dates and NULLs, so
#: there are at most 3601 partitions, whatever dates the files hold.
MONTH_YEARS = (1900, 2199)
#: The date that decides on a row's month, per silver table.
MONTH_OF = {"contracts_silver": "start_date", "budgets_silver": "planned_start_date",
            "change_orders_silver": "created_at"}


def by_month(df: DataFrame, date_col: str) -> DataFrame:
    """``df`` with its month (year * 100 + month) for a table partitioned by
    it.  Rows are dealt by month first, which adaptive execution cuts into
    files of the advisory size: a hot month is several files, a small one is
    not spread over all tasks."""
    d = F.col(date_col)
    key = F.when(F.year(d).between(*MONTH_YEARS), F.year(d) * 100 + F.month(d)).otherwise(0)
    return df.withColumn(MONTH_KEY, F.coalesce(key, F.lit(0)).cast("int")).hint("rebalance", MONTH_KEY)
