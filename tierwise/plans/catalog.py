"""Registered queries: name -> (spark query, oracle SQL).

Each query takes ``(spark, sf_dir)``, reads the whole test tables, derives
bronze -> silver -> gold and returns a DataFrame.  What several queries look at
is stored once per session and shared (:class:`Layers`): silver tables, gold
tables, the per-contract rollups and the profiles that monitoring reads, as
the layered run stores them.  Parameters that
the reference takes from the clock are fixed here (``RUN_TS``,
``SPINE_AS_OF``, ``MONITOR_AS_OF``) so results are reproducible.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwise.operators import gold, monitoring, silver
from tierwise.operators.fanout import Rollup
from tierwise.plans import oracle
from tierwise.plans.oracle import RUN_TS, SPINE_AS_OF
from tierwise.session import checkpoint_root, scratch_path
from tierwise.sources import sinks, versions
from tierwise.sources.testdata import Bronze, blank_ids, change_order_load_stamps

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


#: What a session has stored: (session, input, run stamp) -> {name: (path, schema)}.
_STORED: dict[tuple, dict[str, tuple]] = {}
_LOCK = threading.RLock()


class Layers:
    """The layers of one scale-factor folder.

    ``contracts()``, ``budgets()`` and ``change_orders()`` are silver frames
    derived lazily from the test tables.  :meth:`model`, :meth:`by_month`,
    :meth:`rollup` and :meth:`profiles` are stored: the first query of a session
    that needs one writes it to the shared folder (gold from stored silver, but
    rollups from derived detail tables unless these are stored), the others read it.  Another input (a file of another size or time) is another
    set; the folder is removed at the end of the session.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, run_ts: str = RUN_TS):
        self.spark = spark
        self.bronze = Bronze(spark, sf_dir)
        self.run_ts = run_ts
        self._key: tuple | None = None

    def contracts(self) -> DataFrame:
        return silver.contracts_silver(self.bronze.contracts(), self.run_ts)

    def budgets(self) -> DataFrame:
        return silver.budgets_silver(self.bronze.budgets(), self.run_ts)

    def change_orders(self) -> DataFrame:
        return silver.change_orders_silver(self.bronze.change_orders(), self.run_ts)

    # ------------------------------------------------------------- stored

    def _set(self) -> dict[str, tuple]:
        if self._key is None:
            state = tuple(versions.state(self.spark, f"{self.bronze.sf_dir.rstrip('/')}/{t}.parquet")
                          for t in ("orders", "lineitem", "events"))
            self._key = (self.spark.sparkContext.applicationId, self.run_ts, checkpoint_root(self.spark), state)
        found = _STORED.setdefault(self._key, {})
        if not found:
            found["/"] = (scratch_path(self.spark, "layers"), None)
        return found

    def _stored(self, name: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> DataFrame:
        with _LOCK:
            found = self._set()
            if name not in found or not versions.exists(self.spark, found[name][0]):
                path, df = f"{found['/'][0]}/{name}-{uuid.uuid4().hex[:8]}", build()
                sinks.write_files(df, path, partition_by=partition_by)
                found[name] = (path, df.schema)
            path, schema = found[name]
            return self.spark.read.schema(schema).parquet(path)

    def model(self, name: str) -> DataFrame:
        """A bronze, silver or gold table as stored."""
        return self._stored(name, lambda: MODELS[name](self))

    def by_month(self, name: str) -> DataFrame:
        """What the month models read of a silver table, laid out by month."""
        return self._stored(f"{name}-by-month", lambda: silver.by_month(
            self.model(name).select(*gold.MONTH_COLUMNS[name]), silver.MONTH_OF[name]), [silver.MONTH_KEY])

    def _read(self, name: str) -> DataFrame:
        """A model as stored if a query has stored it, else derived: a reader of
        a few columns then derives these alone."""
        return self.model(name) if name in self._set() else MODELS[name](self)

    def rollup(self, name: str) -> Rollup:
        """The per-contract rollup of a silver detail table, for all models."""
        build = {"budgets_silver": gold.budget_rollup, "change_orders_silver": gold.change_order_rollup}[name]
        return build(self._read(name), store=lambda df, part: self._stored(f"{name}-{part}", lambda: df))

    def _monitored(self, name: str) -> DataFrame:
        """A model as stored.  One without a stamp has an error row and no
        profile: monitoring reads its columns' names only, so it is not stored
        for that."""
        if name in self._set():
            return self.model(name)
        df = MODELS[name](self)
        return self.model(name) if "processed_at" in df.columns else df

    def profiles(self, tables: dict[str, str]) -> tuple[str, dict[str, DataFrame]]:
        """The folder of the kept profiles of monitored tables (monitored name
        -> model), and the tables."""
        frames = {n: self._monitored(m) for n, m in tables.items()}
        with _LOCK:
            root = f"{self._set()['/'][0]}/profiles"
            for n, df in frames.items():
                if "processed_at" in df.columns and not versions.exists(self.spark, f"{root}/table_name={n}"):
                    monitoring.keep_profile(df, root, n)
        return root, frames

    def _silver(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return (self.model("contracts_silver"), self.model("budgets_silver"),
                self.model("change_orders_silver"))

    def rolled_up(self) -> tuple[DataFrame, Rollup, Rollup]:
        """Stored contracts and the rollups of both detail tables."""
        return self.model("contracts_silver"), self.rollup("budgets_silver"), self.rollup("change_orders_silver")

    def monthly(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The silver tables laid out by month."""
        return self.by_month("contracts_silver"), self.by_month("budgets_silver"), self.by_month("change_orders_silver")


MODELS: dict[str, Callable[[Layers], DataFrame]] = {
    "bronze_contracts": lambda L: L.bronze.contracts(),
    "bronze_budgets": lambda L: L.bronze.budgets(),
    "change_order_loads": lambda L: change_order_load_stamps(L.bronze.raw("events")),
    # As delivered, without the load's REQUIRED check: some ids are blank.
    "contracts_silver_unchecked": lambda L: silver.contracts_silver(blank_ids(L.bronze.contracts()), L.run_ts),
    "contracts_silver": lambda L: L.contracts(),
    "budgets_silver": lambda L: L.budgets(),
    "change_orders_silver": lambda L: L.change_orders(),
    "contract_analytics": lambda L: gold.contract_analytics(
        L.model("contracts_silver"), L.run_ts, ordered=False),
    "contract_summary": lambda L: gold.contract_summary(*L.rolled_up()[:2], L.run_ts, ordered=False),
    "project_analytics": lambda L: gold.project_analytics(*L.rolled_up(), L.run_ts),
    "client_analytics": lambda L: gold.client_analytics(*L.rolled_up(), L.run_ts),
    "time_analytics": lambda L: gold.time_analytics(
        *L.monthly(), as_of=SPINE_AS_OF, run_ts=L.run_ts, ordered=False),
}


# ---------------------------------------------------------------- silver

@register("silver_contracts", oracle.select_all("contracts_silver"))
def q_silver_contracts(spark, sf_dir):
    return Layers(spark, sf_dir).contracts()


@register("silver_budgets", oracle.select_all("budgets_silver"))
def q_silver_budgets(spark, sf_dir):
    return Layers(spark, sf_dir).budgets()


@register("silver_change_orders", oracle.select_all("change_orders_silver"))
def q_silver_change_orders(spark, sf_dir):
    return Layers(spark, sf_dir).change_orders()


# ---------------------------------------------------------------- gold

@register("contract_analytics", oracle.select_all("contract_analytics"))
def q_contract_analytics(spark, sf_dir):
    return gold.contract_analytics(Layers(spark, sf_dir).contracts(), RUN_TS)


@register("contract_summary", oracle.select_all("contract_summary"))
def q_contract_summary(spark, sf_dir):
    contracts, budgets, _ = Layers(spark, sf_dir).rolled_up()
    return gold.contract_summary(contracts, budgets, RUN_TS)


@register("budget_summary", oracle.select_all("budget_summary"))
def q_budget_summary(spark, sf_dir):
    return gold.budget_summary(Layers(spark, sf_dir).budgets())


@register("change_order_summary", oracle.select_all("change_order_summary"))
def q_change_order_summary(spark, sf_dir):
    return gold.change_order_summary(Layers(spark, sf_dir).change_orders())


@register("project_analytics", oracle.select_all("project_analytics"))
def q_project_analytics(spark, sf_dir):
    return gold.project_analytics(*Layers(spark, sf_dir).rolled_up(), RUN_TS)


@register("client_contracts", oracle.select_all("client_contracts"))
def q_client_contracts(spark, sf_dir):
    return gold.client_contracts(Layers(spark, sf_dir).contracts())


@register("client_budgets", oracle.select_all("client_budgets"))
def q_client_budgets(spark, sf_dir):
    contracts, budgets, _ = Layers(spark, sf_dir).rolled_up()
    return gold.client_budgets(contracts, budgets)


@register("client_change_orders", oracle.select_all("client_change_orders"))
def q_client_change_orders(spark, sf_dir):
    contracts, _, change_orders = Layers(spark, sf_dir).rolled_up()
    return gold.client_change_orders(contracts, change_orders)


@register("client_analytics", oracle.select_all("client_analytics"))
def q_client_analytics(spark, sf_dir):
    return gold.client_analytics(*Layers(spark, sf_dir).rolled_up(), RUN_TS)


@register("monthly_contracts", oracle.select_all("monthly_contracts"))
def q_monthly_contracts(spark, sf_dir):
    return gold.monthly_contracts(Layers(spark, sf_dir).contracts())


@register("monthly_budgets", oracle.select_all("monthly_budgets"))
def q_monthly_budgets(spark, sf_dir):
    return gold.monthly_budgets(Layers(spark, sf_dir).budgets())


@register("monthly_change_orders", oracle.select_all("monthly_change_orders"))
def q_monthly_change_orders(spark, sf_dir):
    return gold.monthly_change_orders(Layers(spark, sf_dir).change_orders())


@register("time_analytics", oracle.select_all("time_analytics"))
def q_time_analytics(spark, sf_dir):
    return gold.time_analytics(*Layers(spark, sf_dir).monthly(), as_of=SPINE_AS_OF, run_ts=RUN_TS)


# The spine as the reference runs it, up to today; thirty years reach back to
# the data.
@register("time_analytics_today", oracle.select_all("time_analytics").replace(
    f"DATE '{SPINE_AS_OF}' - INTERVAL 3 YEAR", "current_date - INTERVAL 30 YEAR").replace(f"DATE '{SPINE_AS_OF}'", "current_date"))
def q_time_analytics_today(spark, sf_dir):
    return gold.time_analytics(*Layers(spark, sf_dir).monthly(), years_back=30, run_ts=RUN_TS)


# The spine's as-of date is the latest contract start in the data (a
# one-row aggregate), so the spine is derived from the tables, not typed in.
@register("date_spine", oracle.with_prelude("""
SELECT y AS year, m AS month
FROM (SELECT max(start_date) AS as_of FROM contracts_silver) a,
     unnest(generate_series(year(a.as_of - INTERVAL 3 YEAR), year(a.as_of))) AS t1(y),
     unnest(generate_series(1, 12)) AS t2(m)
WHERE y < year(a.as_of) OR (y = year(a.as_of) AND m <= month(a.as_of))"""))
def q_date_spine(spark, sf_dir):
    from pyspark.sql import functions as F
    anchor = Layers(spark, sf_dir).contracts().agg(F.max("start_date").alias("as_of"))
    return gold.date_spine(anchor, 3)


def queries() -> dict[str, Query]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)


def _load_all() -> None:
    # Modules that register further queries on import.
    for mod in ("tierwise.plans.quality_queries", "tierwise.plans.monitoring_queries",
                "tierwise.plans.source_queries", "tierwise.plans.run_queries"):
        __import__(mod)
