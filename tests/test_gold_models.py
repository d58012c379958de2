"""Gold models against brute force.

A skewed fixture (one contract holds half of all budgets, another half of
all change orders; duplicate and NULL ids and keys; orphan details; NULL
and zero amounts; a NULL client) is written to parquet; the Spark models,
which use the skew-free rollup rewrites, are compared with the literal
fan-out SQL run by DuckDB on the same files.  Hand-computed golden rows
pin the reference semantics on tiny frames.
"""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from tierwise.operators import gold
from tierwise.plans import oracle
from tierwise.plans.oracle import RUN_TS, SPINE_AS_OF
from tools.compare_oracle import canon

M = "decimal(27,9)"


@pytest.fixture(scope="module")
def fixture_dir(spark, tmp_path_factory):
    from tierwise.session import scratch_path
    root = scratch_path(spark, "gold-fixture")
    c = spark.range(300).select(
        F.when(F.col("id") % 37 == 0, None).when(F.col("id") == 5, "4")
         .otherwise(F.col("id").cast("string")).alias("contract_id"),
        F.concat(F.lit("Contract "), F.col("id")).alias("contract_name"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("client"), F.col("id") % 7)).alias("client_name"),
        F.date_add(F.lit("1998-06-01").cast("date"), (F.col("id") * 3 % 1300).cast("int")).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.when(F.col("id") % 13 == 0, None).when(F.col("id") % 17 == 0, 0)
         .otherwise(F.col("id") * 37 % 1000 + 0.25).cast(M).alias("contract_value"),
        F.element_at(F.array(*[F.lit(s) for s in ("active", "completed", "pending", "cancelled", "other")]),
                     (F.col("id") % 5 + 1).cast("int")).alias("contract_status"),
        F.lit(RUN_TS).cast("timestamp_ntz").alias("processed_at"),
    ).withColumn("end_date", F.date_add("start_date", (F.length("contract_name") * 9).cast("int")))
    b = spark.range(5000).select(
        F.when(F.col("id") % 2 == 0, "1").when(F.col("id") % 97 == 1, None)
         .when(F.col("id") % 89 == 1, "orphan").otherwise((F.col("id") % 300).cast("string")).alias("contract_id"),
        F.when(F.col("id") % 53 == 0, None).otherwise((F.col("id") % 3000).cast("string")).alias("budget_id"),
        F.when(F.col("id") % 41 == 0, None).otherwise(F.col("id") % 500 + 0.5).cast(M).alias("original_amount"),
        F.when(F.col("id") % 43 == 0, None).otherwise(F.col("id") % 450 + 0.75).cast(M).alias("actual_cost"),
        F.date_add(F.lit("1998-01-01").cast("date"), (F.col("id") % 1400).cast("int")).alias("planned_start_date"),
    ).select("*",
             F.date_add("planned_start_date", 30).alias("planned_end_date"),
             F.date_add("planned_start_date", (F.col("original_amount") % 9).cast("int")).alias("actual_start_date"))
    co = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "2").when(F.col("id") % 101 == 1, None)
         .otherwise((F.col("id") % 310).cast("string")).alias("contract_id"),
        F.when(F.col("id") % 59 == 0, None).otherwise((F.col("id") % 3500).cast("string")).alias("change_order_id"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 70 + 0.1).cast(M).alias("approved_amount"),
        (F.col("id") % 80 + 0.2).cast(M).alias("estimated_amount"),
        F.when(F.col("id") % 4 == 0, F.col("id") % 60 + 0.3).cast(M).alias("committed_amount"),
        (F.lit("1998-01-01 10:00:00").cast("timestamp_ntz")
         + F.make_interval(days=(F.col("id") % 1400).cast("int"))).alias("created_at"),
    )
    for name, df in (("contracts_silver", c), ("budgets_silver", b), ("change_orders_silver", co)):
        df.coalesce(3).write.parquet(f"{root}/{name}")
    return root


def _frames(spark, root):
    return tuple(spark.read.parquet(f"{root}/{n}")
                 for n in ("contracts_silver", "budgets_silver", "change_orders_silver"))


def _duck(root, model):
    con = duckdb.connect()
    for n in ("contracts_silver", "budgets_silver", "change_orders_silver"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{root}/{n}/*.parquet')")
    cur = con.execute("WITH " + oracle.MODEL_CTES + f"\nSELECT * FROM {model}")
    return [d[0] for d in cur.description], cur.fetchall()


MODELS = {
    "contract_analytics": lambda c, b, co: gold.contract_analytics(c, RUN_TS),
    "contract_summary": lambda c, b, co: gold.contract_summary(c, b, RUN_TS),
    "project_analytics": lambda c, b, co: gold.project_analytics(c, b, co, RUN_TS),
    "client_contracts": lambda c, b, co: gold.client_contracts(c),
    "client_budgets": lambda c, b, co: gold.client_budgets(c, b),
    "client_change_orders": lambda c, b, co: gold.client_change_orders(c, co),
    "client_analytics": lambda c, b, co: gold.client_analytics(c, b, co, RUN_TS),
    "monthly_budgets": lambda c, b, co: gold.monthly_budgets(b),
    "time_analytics": lambda c, b, co: gold.time_analytics(c, b, co, as_of=SPINE_AS_OF, run_ts=RUN_TS),
}


@pytest.mark.parametrize("model", sorted(MODELS))
def test_model_matches_literal_sql_on_skewed_fixture(spark, fixture_dir, model):
    df = MODELS[model](*_frames(spark, fixture_dir))
    cols, rows = _duck(fixture_dir, model)
    assert sorted(df.columns) == sorted(cols)
    got = canon(df.columns, [tuple(r) for r in df.collect()], 12)
    want = canon(cols, rows, 12)
    assert len(got) == len(want)
    assert got == want


# ---------------------------------------------------------------- golden rows

@pytest.fixture(scope="module")
def tiny(spark):
    c = spark.createDataFrame([
        ("K1", "A", "Acme", dt.date(2023, 1, 1), dt.date(2023, 12, 31), Decimal("100"), "active"),
        ("K2", "B", "Acme", dt.date(2023, 2, 1), dt.date(2023, 3, 3), Decimal("50"), "completed"),
        ("K3", "C", "XYZ", dt.date(2023, 2, 15), dt.date(2023, 8, 15), Decimal("0"), "pending"),
        ("K4", "D", None, dt.date(2023, 3, 1), dt.date(2023, 3, 11), Decimal("10"), "cancelled"),
    ], f"contract_id string, contract_name string, client_name string, start_date date, "
       f"end_date date, contract_value {M}, contract_status string")
    b = spark.createDataFrame([
        ("B1", "K1", Decimal("30"), Decimal("45")),
        ("B2", "K1", Decimal("20"), Decimal("5")),
        ("B3", "K4", Decimal("7"), Decimal("7")),
    ], f"budget_id string, contract_id string, original_amount {M}, actual_cost {M}")
    co = spark.createDataFrame([
        ("CO1", "K1", Decimal("10")), ("CO2", "K1", Decimal("5")), ("CO3", "K1", None),
        ("CO4", "K3", Decimal("8")), ("CO5", "K4", Decimal("1")),
    ], f"change_order_id string, contract_id string, approved_amount {M}")
    co = co.select("*", F.col("approved_amount").alias("estimated_amount"),
                   F.lit(None).cast(M).alias("committed_amount"))
    return c, b, co


def test_contract_summary_keeps_fanout(tiny):
    c, b, _ = tiny
    rows = {r["client_name"]: r for r in gold.contract_summary(c, b, RUN_TS).collect()}
    acme = rows["Acme"]
    # K1 has two budgets: its value counts twice (100 + 100 + 50).
    assert acme["total_contracts"] == 2
    assert acme["total_contract_value"] == Decimal("250")
    assert acme["avg_contract_value"] == pytest.approx(250 / 3)
    assert acme["total_budget_allocated"] == Decimal("50")
    assert acme["budget_variance"] == Decimal("200")
    assert rows["XYZ"]["total_budget_allocated"] is None
    assert rows["XYZ"]["budget_variance"] is None


def test_client_analytics_null_client_and_no_budgets(tiny):
    c, b, co = tiny
    rows = {r["client_name"]: r for r in gold.client_analytics(c, b, co, RUN_TS).collect()}
    acme, xyz, none = rows["Acme"], rows["XYZ"], rows[None]
    assert (acme["total_budgets"], acme["total_budget_amount"], acme["total_actual_cost"]) == (2, Decimal("50"), Decimal("50"))
    assert acme["budget_utilization_percentage"] == pytest.approx(100.0)
    # CO percentage denominator is fan-out inflated: K1 x3 change orders + K2 once.
    assert acme["change_order_percentage"] == pytest.approx(15 / 350 * 100)
    assert acme["total_change_orders"] == 3
    assert acme["avg_budgets_per_contract"] == pytest.approx(1.0)
    # A client without budgets: utilisation NULL, not 0.
    assert xyz["total_budgets"] == 0 and xyz["budget_utilization_percentage"] is None
    assert xyz["change_order_percentage"] == 0.0        # contract value 0 -> guarded
    # NULL client: its budget / change-order metrics never join.
    assert none["total_contracts"] == 1
    assert none["total_budgets"] is None and none["total_change_orders"] is None
    assert none["adjusted_contract_value"] == Decimal("10")
    assert none["avg_budgets_per_contract"] is None


def test_project_analytics_coalesces(tiny):
    c, b, co = tiny
    rows = {r["contract_id"]: r for r in gold.project_analytics(c, b, co, RUN_TS).collect()}
    assert rows["K2"]["budget_count"] == 0 and rows["K2"]["total_original_budget"] == 0
    assert rows["K2"]["budget_utilization_percentage"] == 0.0
    assert rows["K3"]["change_order_percentage"] == 0.0      # zero contract value
    assert rows["K1"]["adjusted_contract_value"] == Decimal("115")
    assert rows["K1"]["change_order_count"] == 3


def test_time_analytics_spine_and_zero_months(spark, tiny):
    c, b, co = tiny
    b2 = b.select("*", F.lit(dt.date(2023, 4, 1)).alias("planned_start_date"),
                  F.lit(dt.date(2023, 4, 11)).alias("planned_end_date"),
                  F.lit(dt.date(2023, 4, 3)).alias("actual_start_date"))
    co2 = co.select("*", F.lit(dt.datetime(2023, 1, 5, 9)).cast("timestamp_ntz").alias("created_at"))
    rows = gold.time_analytics(c, b2, co2, as_of="2023-06-15", years_back=1).collect()
    assert [(r["year"], r["month"]) for r in rows][:1] == [(2022, 1)]
    assert len(rows) == 12 + 6
    apr = [r for r in rows if (r["year"], r["month"]) == (2023, 4)][0]
    assert apr["new_contracts"] == 0 and apr["new_budgets"] == 3
    assert apr["budgets_per_contract"] == 0.0                 # no contracts that month
    jan = [r for r in rows if (r["year"], r["month"]) == (2023, 1)][0]
    assert jan["new_change_orders"] == 5 and jan["change_order_percentage"] == pytest.approx(24 / 100 * 100)


def test_date_spine_bounds(spark):
    rows = gold.date_spine(gold.anchor_date(spark, "2024-02-29"), 3).collect()
    assert len(rows) == 4 * 12 - 10
    assert (rows[0]["year"], rows[0]["month"]) == (2021, 1)
    assert (rows[-1]["year"], rows[-1]["month"]) == (2024, 2)


