"""Gold models: per client, per contract and per month analytics.

Every model takes silver DataFrames and returns a DataFrame; nothing is
collected.  In place of budgets and change orders the per-contract and
per-client models also take their rollups (:func:`budget_rollup`,
:func:`change_order_rollup`), which all of them can share.  Scale notes per model are in the docstrings; the shared
fan-out rewrite is described in :mod:`tierwise.operators.fanout`.

Type rules (so results are exact and engine independent):
money sums are decimal(38,9); averages and ratios are double computed
from exact totals; counts and day differences are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions.metrics import (
    MONEY_TYPE, as_of_date, avg_exact, days_between, money_minus, money_plus, money_sum, money_times_sum,
    pct_ratio, safe_div, stamp,
)
from tierwise.operators.fanout import (
    FANOUT_N, Rollup, attach_by_group, child_rollup, distinct_children_per_group, fanout_weight,
    group_keys, group_value, rollup, weighted_count,
)
from tierwise.operators.silver import MONTH_KEY, MONTH_YEARS
from tierwise.schemas import CONTRACT_STATUSES


def budget_rollup(budgets: DataFrame, **store) -> Rollup:
    """What the gold models need of the budgets, summed up in one scan."""
    return rollup(budgets, "contract_id", "budget_id", ["original_amount", "actual_cost"], **store)


def change_order_rollup(change_orders: DataFrame, **store) -> Rollup:
    """What the gold models need of the change orders, summed up in one scan."""
    return rollup(change_orders, "contract_id", "change_order_id",
                  ["estimated_amount", "approved_amount", "committed_amount"], **store)


def _duration(c: DataFrame) -> Column:
    return days_between(c["end_date"], c["start_date"])


# --------------------------------------------------------------------------
# contract_analytics (per client)
# --------------------------------------------------------------------------

def contract_analytics(contracts: DataFrame, run_ts=None, ordered: bool = True) -> DataFrame:
    """Per-client totals; one grouped aggregate (partial + final hash agg)."""
    out = (contracts
           .select("client_name", "contract_id", "contract_value",
                   _duration(contracts).alias("d"))
           .groupBy("client_name")
           .agg(F.count("contract_id").alias("total_contracts"),
                money_sum("contract_value").alias("total_contract_value"),
                F.count("contract_value").alias("_nv"),
                F.min("contract_value").alias("min_contract_value"),
                F.max("contract_value").alias("max_contract_value"),
                F.avg("d").alias("avg_contract_duration_days"))
           .select("client_name", "total_contracts", "total_contract_value",
                   avg_exact(F.col("total_contract_value"), F.col("_nv")).alias("avg_contract_value"),
                   "min_contract_value", "max_contract_value",
                   "avg_contract_duration_days",
                   stamp(run_ts).alias("processed_at")))
    return out.orderBy(F.desc("total_contract_value")) if ordered else out


# --------------------------------------------------------------------------
# contract_summary (per client, fan-out over budgets kept)
# --------------------------------------------------------------------------

def contract_summary(contracts: DataFrame, budgets: DataFrame | Rollup, run_ts=None,
                     ordered: bool = True) -> DataFrame:
    """Client summary over contracts LEFT JOIN budgets, aggregated after the join.

    A contract with n budgets counts n times in the value sum and average
    (the reference semantics); this is computed as value x max(n, 1) on a
    1:1 join with the per-contract budget rollup, so no budget row is
    shuffled by contract id.
    """
    per_contract = child_rollup(budgets, "contract_id", _orig="original_amount")
    out = (contracts
           .select("client_name", "contract_id", "contract_value", "start_date", "end_date")
           .join(per_contract, "contract_id", "left")
           .groupBy("client_name")
           .agg(F.countDistinct("contract_id").alias("total_contracts"),
                money_times_sum(F.col("contract_value"), fanout_weight()).alias("total_contract_value"),
                F.sum(weighted_count(F.col("contract_value"))).alias("_nv"),
                F.min("start_date").alias("earliest_contract_date"),
                F.max("end_date").alias("latest_contract_end_date"),
                money_sum("_orig").alias("total_budget_allocated"))
           .select("client_name", "total_contracts", "total_contract_value",
                   avg_exact(F.col("total_contract_value"), F.col("_nv")).alias("avg_contract_value"),
                   "earliest_contract_date", "latest_contract_end_date",
                   "total_budget_allocated",
                   money_minus(F.col("total_contract_value"), F.col("total_budget_allocated")).alias("budget_variance"),
                   stamp(run_ts).alias("generated_at")))
    return out.orderBy(F.desc("total_contract_value")) if ordered else out


# --------------------------------------------------------------------------
# project_analytics (per contract)
# --------------------------------------------------------------------------

def budget_summary(budgets: DataFrame | Rollup) -> DataFrame:
    per = child_rollup(budgets, "contract_id", _orig="original_amount", _actual="actual_cost")
    return (per.select("contract_id", F.col(FANOUT_N).alias("budget_count"),
                       F.col("_orig").cast(MONEY_TYPE).alias("total_original_budget"),
                       F.col("_actual").cast(MONEY_TYPE).alias("total_actual_cost"))
            .withColumn("budget_variance",
                        money_minus(F.col("total_actual_cost"), F.col("total_original_budget"))))


def change_order_summary(change_orders: DataFrame | Rollup) -> DataFrame:
    amounts = ("estimated_amount", "approved_amount", "committed_amount")
    per = child_rollup(change_orders, "contract_id", **{f"total_{a}": a for a in amounts})
    return per.select("contract_id", F.col(FANOUT_N).alias("change_order_count"),
                      *[F.col(f"total_{a}").cast(MONEY_TYPE).alias(f"total_{a}") for a in amounts])


def project_analytics(contracts: DataFrame, budgets: DataFrame | Rollup,
                      change_orders: DataFrame | Rollup, run_ts=None) -> DataFrame:
    """Per-contract metrics: two pre-aggregated sides, two 1:1 LEFT joins.

    Both summaries come out hash-partitioned by contract_id, so the contracts
    are shuffled once and both joins reuse that partitioning (or AQE turns
    them into broadcasts when a summary is measured small at run time).
    """
    bs = budget_summary(budgets)
    cos = change_order_summary(change_orders)
    j = (contracts.select("contract_id", "contract_name", "client_name", "start_date",
                          "end_date", "contract_value", "contract_status")
         .join(bs, "contract_id", "left")
         .join(cos, "contract_id", "left"))
    z = F.lit(0)
    orig = F.coalesce("total_original_budget", z)
    actual = F.coalesce("total_actual_cost", z)
    approved = F.coalesce("total_approved_amount", z)
    return j.select(
        "contract_id", "contract_name", "client_name", "start_date", "end_date",
        "contract_value", "contract_status",
        F.coalesce("budget_count", z).alias("budget_count"),
        orig.alias("total_original_budget"),
        actual.alias("total_actual_cost"),
        F.coalesce("budget_variance", z).alias("budget_variance"),
        F.coalesce("change_order_count", z).alias("change_order_count"),
        F.coalesce("total_estimated_amount", z).alias("total_estimated_co_amount"),
        approved.alias("total_approved_co_amount"),
        F.coalesce("total_committed_amount", z).alias("total_committed_co_amount"),
        money_plus(F.col("contract_value"), approved).alias("adjusted_contract_value"),
        pct_ratio(approved, F.col("contract_value")).alias("change_order_percentage"),
        pct_ratio(actual, orig).alias("budget_utilization_percentage"),
        stamp(run_ts).alias("processed_at"),
    )


# --------------------------------------------------------------------------
# client_analytics (per client) and its three parts
# --------------------------------------------------------------------------

def _status_counts(statuses) -> list[Column]:
    return [F.count(F.when(F.col("contract_status") == s, 1)).alias(f"{s}_contracts")
            for s in statuses]


def client_contracts(contracts: DataFrame, statuses=CONTRACT_STATUSES) -> DataFrame:
    return (contracts
            .select("client_name", "contract_value", "contract_status",
                    _duration(contracts).alias("d"))
            .groupBy("client_name")
            .agg(F.count(F.lit(1)).alias("total_contracts"),
                 money_sum("contract_value").alias("total_contract_value"),
                 F.count("contract_value").alias("_nv"),
                 F.min("contract_value").alias("min_contract_value"),
                 F.max("contract_value").alias("max_contract_value"),
                 F.avg("d").alias("avg_contract_duration_days"),
                 *_status_counts(statuses))
            .select("client_name", "total_contracts", "total_contract_value",
                    avg_exact(F.col("total_contract_value"), F.col("_nv")).alias("avg_contract_value"),
                    "min_contract_value", "max_contract_value", "avg_contract_duration_days",
                    *[f"{s}_contracts" for s in statuses]))


def client_budgets(contracts: DataFrame, budgets: DataFrame | Rollup) -> DataFrame:
    """Budget metrics per client over contracts LEFT JOIN budgets.

    Utilisation is NULL (not 0) for a client without budgets: its sums are
    NULL and ``NULL = 0`` is not true.
    """
    per_contract = child_rollup(budgets, "contract_id", _orig="original_amount", _actual="actual_cost")
    base = (contracts.select("contract_id", "client_name")
            .join(per_contract, "contract_id", "left")
            .groupBy(*group_keys("client_name"))
            .agg(money_sum("_orig").alias("total_budget_amount"),
                 money_sum("_actual").alias("total_actual_cost"))
            .select("*", group_value(contracts, "client_name")))
    counts = distinct_children_per_group(contracts, budgets, "contract_id", "client_name",
                                         "budget_id", "total_budgets")
    out = attach_by_group(base, counts, {"total_budgets": 0})
    return out.select(
        "client_name", "total_budgets", "total_budget_amount", "total_actual_cost",
        money_minus(F.col("total_actual_cost"), F.col("total_budget_amount")).alias("total_budget_variance"),
        pct_ratio(F.col("total_actual_cost"), F.col("total_budget_amount"))
        .alias("budget_utilization_percentage"))


def client_change_orders(contracts: DataFrame, change_orders: DataFrame | Rollup) -> DataFrame:
    """Change-order metrics per client; the percentage's denominator is the
    contract value summed over the fan-out (each contract once per change
    order), as in the reference."""
    per_contract = child_rollup(change_orders, "contract_id", _appr="approved_amount")
    base = (contracts.select("contract_id", "client_name", "contract_value")
            .join(per_contract, "contract_id", "left")
            .groupBy(*group_keys("client_name"))
            .agg(money_sum("_appr").alias("total_change_order_amount"),
                 money_times_sum(F.col("contract_value"), fanout_weight()).alias("_cv"))
            .select("*", group_value(contracts, "client_name")))
    counts = distinct_children_per_group(contracts, change_orders, "contract_id", "client_name",
                                         "change_order_id", "total_change_orders")
    out = attach_by_group(base, counts, {"total_change_orders": 0})
    return out.select(
        "client_name", "total_change_orders", "total_change_order_amount",
        pct_ratio(F.col("total_change_order_amount"), F.col("_cv")).alias("change_order_percentage"))


def client_analytics(contracts: DataFrame, budgets: DataFrame | Rollup, change_orders: DataFrame | Rollup,
                     run_ts=None, statuses=CONTRACT_STATUSES) -> DataFrame:
    """Client contracts, budgets and change orders in one grouped pass.

    The reference builds three per-client tables and joins them on
    client_name; here contracts are joined 1:1 with the two per-contract
    rollups and aggregated once, and only the two exact distinct counts
    need the detail rows.  The NULL client keeps the reference result:
    its budget and change-order metrics are NULL, because ``NULL = NULL``
    never matches in the reference's final join.
    """
    b = child_rollup(budgets, "contract_id", _orig="original_amount",
                     _actual="actual_cost").withColumnRenamed(FANOUT_N, "_nb")
    co = child_rollup(change_orders, "contract_id", _appr="approved_amount")
    j = (contracts.select("contract_id", "client_name", "contract_value", "contract_status",
                          _duration(contracts).alias("d"))
         .join(b, "contract_id", "left")
         .join(co, "contract_id", "left"))
    base = (j.groupBy(*group_keys("client_name"))
            .agg(F.count(F.lit(1)).alias("total_contracts"),
                 money_sum("contract_value").alias("total_contract_value"),
                 F.count("contract_value").alias("_nv"),
                 F.min("contract_value").alias("min_contract_value"),
                 F.max("contract_value").alias("max_contract_value"),
                 F.avg("d").alias("avg_contract_duration_days"),
                 *_status_counts(statuses),
                 money_sum("_orig").alias("total_budget_amount"),
                 money_sum("_actual").alias("total_actual_cost"),
                 money_sum("_appr").alias("total_change_order_amount"),
                 money_times_sum(F.col("contract_value"), fanout_weight()).alias("_cv"))
            .select("*", group_value(contracts, "client_name")))
    nb = distinct_children_per_group(contracts, budgets, "contract_id", "client_name",
                                     "budget_id", "total_budgets")
    nco = distinct_children_per_group(contracts, change_orders, "contract_id", "client_name",
                                      "change_order_id", "total_change_orders")
    out = attach_by_group(base, nb, {"total_budgets": 0})
    out = attach_by_group(out, nco, {"total_change_orders": 0})

    known = F.col("client_name").isNotNull()

    def matched(c: Column) -> Column:
        return F.when(known, c)

    tb, tc = F.col("total_budgets"), F.col("total_contracts")
    nco_c = F.col("total_change_orders")
    co_amt = matched(F.col("total_change_order_amount"))
    return out.select(
        "client_name", "total_contracts", "total_contract_value",
        avg_exact(F.col("total_contract_value"), F.col("_nv")).alias("avg_contract_value"),
        "min_contract_value", "max_contract_value", "avg_contract_duration_days",
        *[f"{s}_contracts" for s in statuses],
        matched(tb).alias("total_budgets"),
        matched(F.col("total_budget_amount")).alias("total_budget_amount"),
        matched(F.col("total_actual_cost")).alias("total_actual_cost"),
        matched(money_minus(F.col("total_actual_cost"), F.col("total_budget_amount"))).alias("total_budget_variance"),
        matched(pct_ratio(F.col("total_actual_cost"), F.col("total_budget_amount")))
        .alias("budget_utilization_percentage"),
        matched(nco_c).alias("total_change_orders"),
        co_amt.alias("total_change_order_amount"),
        matched(pct_ratio(F.col("total_change_order_amount"), F.col("_cv"))).alias("change_order_percentage"),
        money_plus(F.col("total_contract_value"), F.coalesce(co_amt, F.lit(0))).alias("adjusted_contract_value"),
        F.when(tc == 0, F.lit(0.0)).otherwise(matched(tb) / tc).alias("avg_budgets_per_contract"),
        F.when(tc == 0, F.lit(0.0)).otherwise(matched(nco_c) / tc).alias("avg_change_orders_per_contract"),
        stamp(run_ts).alias("processed_at"),
    )


# --------------------------------------------------------------------------
# time_analytics (per month on a calendar spine)
# --------------------------------------------------------------------------

#: The columns of each silver table that the month models read.
MONTH_COLUMNS = {
    "contracts_silver": ("start_date", "end_date", "contract_value"),
    "budgets_silver": ("planned_start_date", "planned_end_date", "actual_start_date", "original_amount"),
    "change_orders_silver": ("created_at", "approved_amount"),
}


def _ym(c: Column, prefix: str) -> list[Column]:
    return [F.year(c).cast("long").alias(f"{prefix}_year"),
            F.month(c).cast("long").alias(f"{prefix}_month")]


def _monthly(df: DataFrame, date_col: str, prefix: str, month_key: Column | None,
             values: list[Column], aggs: list[Column]) -> DataFrame:
    """Group by (year, month) of ``date_col`` or by a given month key ``ym``."""
    if month_key is None:
        keys = _ym(F.col(date_col), prefix)
        names = [f"{prefix}_year", f"{prefix}_month"]
    else:
        keys, names = [month_key.alias("ym")], ["ym"]
    return df.select(*keys, *values).groupBy(*names).agg(*aggs)


def monthly_contracts(contracts: DataFrame, month_key: Column | None = None) -> DataFrame:
    return _monthly(contracts, "start_date", "start", month_key,
                    [F.col("contract_value"), _duration(contracts).alias("d")],
                    [F.count(F.lit(1)).alias("new_contracts"),
                     money_sum("contract_value").alias("new_contract_value"),
                     F.avg("d").alias("avg_contract_duration")])


def monthly_budgets(budgets: DataFrame, month_key: Column | None = None) -> DataFrame:
    return _monthly(budgets, "planned_start_date", "planned_start", month_key,
                    [F.col("original_amount"),
                     days_between("planned_end_date", "planned_start_date").alias("pd"),
                     days_between("actual_start_date", "planned_start_date").alias("sd")],
                    [F.count(F.lit(1)).alias("new_budgets"),
                     money_sum("original_amount").alias("new_budget_amount"),
                     F.avg("pd").alias("avg_planned_duration"),
                     F.avg("sd").alias("avg_start_delay")])


def monthly_change_orders(change_orders: DataFrame, month_key: Column | None = None) -> DataFrame:
    out = _monthly(change_orders, "created_at", "created", month_key,
                   [F.col("approved_amount")],
                   [F.count(F.lit(1)).alias("new_change_orders"),
                    money_sum("approved_amount").alias("new_change_order_amount"),
                    F.count("approved_amount").alias("_na")])
    keys = ["ym"] if month_key is not None else ["created_year", "created_month"]
    return out.select(*keys, "new_change_orders", "new_change_order_amount",
                      avg_exact(F.col("new_change_order_amount"), F.col("_na"))
                      .alias("avg_change_order_amount"))


def date_spine(anchor: DataFrame, years_back: int = 3) -> DataFrame:
    """Months from January of (as_of - years_back) up to the month of as_of.

    ``anchor`` is a one-row frame with a DATE column ``as_of`` (a literal
    or an aggregate of the data).  Output is at most (years_back + 1) x 12
    rows, whatever the input size.
    """
    d = F.col("as_of")
    y, m = F.year(d), F.month(d)
    return (anchor
            .select(d, F.explode(F.sequence(F.year(F.add_months(d, -12 * years_back)), y)).alias("year"))
            .select("as_of", "year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
            .where((F.col("year") < y) | ((F.col("year") == y) & (F.col("month") <= m)))
            .select(F.col("year").cast("long").alias("year"),
                    F.col("month").cast("long").alias("month")))


def anchor_date(spark: SparkSession, as_of=None) -> DataFrame:
    """One-row frame holding the as-of date (``CURRENT_DATE()`` by default)."""
    return spark.range(1).select(as_of_date(as_of).alias("as_of"))


def time_analytics(contracts: DataFrame, budgets: DataFrame, change_orders: DataFrame,
                   as_of=None, years_back: int = 3, run_ts=None,
                   ordered: bool = True) -> DataFrame:
    """Monthly metrics on the calendar spine ending at ``as_of``.

    Months outside the spine vanish in the reference's LEFT JOIN from the
    spine.  Each monthly aggregate is therefore keyed by a non-null month
    key, ``year * 100 + month`` for dates on the spine and -1 for every
    other row (NULL dates included): it has at most (years_back + 1) x 12
    + 1 rows whatever the input, a proven bound, so broadcasting it onto the
    spine is safe, and the -1 group never joins.

    The inputs are also filtered to the spine's date range first.  On stored
    silver tables the bounds are constants and reach the parquet scan as
    pushed filters; on silver partitioned by month (:func:`silver.by_month`)
    only the spine's months are read.
    """
    spark = contracts.sparkSession
    d = as_of_date(as_of)
    lo = F.make_date(F.year(d) - years_back, F.lit(1), F.lit(1))
    hi = F.add_months(F.trunc(d, "month"), 1)

    def bounds(ts: bool) -> tuple[Column, Column]:
        return (lo.cast("timestamp_ntz"), hi.cast("timestamp_ntz")) if ts else (lo, hi)

    def on_spine(c: Column, ts: bool = False) -> Column:
        lo_, hi_ = bounds(ts)
        return (c >= lo_) & (c < hi_)

    def month_key(name: str, ts: bool = False) -> Column:
        c = F.col(name)
        return F.coalesce(F.when(on_spine(c, ts), F.year(c) * 100 + F.month(c)),
                          F.lit(-1)).cast("long")

    first, last = F.year(lo) * 100 + 1, F.year(d) * 100 + F.month(d)
    pruned = as_of is None or MONTH_YEARS[0] + years_back <= int(str(as_of)[:4]) <= MONTH_YEARS[1]

    def months(df: DataFrame) -> DataFrame:
        if MONTH_KEY not in df.columns or not pruned:
            return df
        return df.where((F.col(MONTH_KEY) >= first) & (F.col(MONTH_KEY) <= last))

    contracts = months(contracts).where(on_spine(F.col("start_date")))
    budgets = months(budgets).where(on_spine(F.col("planned_start_date")))
    change_orders = months(change_orders).where(on_spine(F.col("created_at"), ts=True))
    mc = monthly_contracts(contracts, month_key("start_date"))
    mb = monthly_budgets(budgets, month_key("planned_start_date"))
    mco = monthly_change_orders(change_orders, month_key("created_at", ts=True))
    spine = (date_spine(anchor_date(spark, as_of), years_back)
             .withColumn("ym", F.col("year") * 100 + F.col("month")))

    j = (spine
         .join(F.broadcast(mc), "ym", "left")
         .join(F.broadcast(mb), "ym", "left")
         .join(F.broadcast(mco), "ym", "left"))
    z = F.lit(0)
    n_c = F.coalesce("new_contracts", z)
    v_c = F.coalesce("new_contract_value", z)
    out = j.select(
        "year", "month",
        n_c.alias("new_contracts"),
        v_c.alias("new_contract_value"),
        F.coalesce("avg_contract_duration", F.lit(0.0)).alias("avg_contract_duration"),
        F.coalesce("new_budgets", z).alias("new_budgets"),
        F.coalesce("new_budget_amount", z).alias("new_budget_amount"),
        F.coalesce("avg_planned_duration", F.lit(0.0)).alias("avg_planned_duration"),
        F.coalesce("avg_start_delay", F.lit(0.0)).alias("avg_start_delay"),
        F.coalesce("new_change_orders", z).alias("new_change_orders"),
        F.coalesce("new_change_order_amount", z).alias("new_change_order_amount"),
        F.coalesce("avg_change_order_amount", F.lit(0.0)).alias("avg_change_order_amount"),
        F.when(n_c == 0, F.lit(0.0))
         .otherwise(safe_div(F.coalesce("new_budgets", z), F.col("new_contracts")))
         .alias("budgets_per_contract"),
        F.when(n_c == 0, F.lit(0.0))
         .otherwise(safe_div(F.coalesce("new_change_orders", z), F.col("new_contracts")))
         .alias("change_orders_per_contract"),
        F.when(v_c == 0, F.lit(0.0))
         .otherwise(safe_div(F.coalesce("new_change_order_amount", z),
                             F.col("new_contract_value")) * F.lit(100.0))
         .alias("change_order_percentage"),
        stamp(run_ts).alias("processed_at"),
    )
    return out.orderBy("year", "month") if ordered else out
