"""End to end: bronze files -> silver -> gold -> checks, on sf0.001."""

import pytest
from pyspark.sql import functions as F

from tierwise.operators import gold
from tierwise.plans.catalog import Layers
from tierwise.plans.layered_run import published_table, run_layers
from tierwise.plans.oracle import RUN_TS, SPINE_AS_OF
from tierwise.sources import sinks, versions
from tierwise.sources.testdata import corrected
from tools.compare_oracle import canon

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def bronze_dir(spark):
    from tierwise.session import scratch_path
    root = scratch_path(spark, "bronze-in")
    L = Layers(spark, SF_SMALL)
    for name, df in (("contracts.csv", L.bronze.contracts()), ("budgets.csv", L.bronze.budgets()),
                     ("co.csv", L.bronze.change_orders())):
        sinks.write_csv(df.coalesce(1), f"{root}/{name}")
    return root


def test_layered_run_matches_in_memory_models(spark, bronze_dir):
    from tierwise.session import scratch_path
    out = scratch_path(spark, "layers")
    res = run_layers(spark, bronze_dir, out, run_ts=RUN_TS, as_of=SPINE_AS_OF,
                     raise_on_failure=False)
    # Gold written from re-read silver equals gold computed in one plan.
    L = Layers(spark, SF_SMALL)
    c, b, co = L.contracts(), L.budgets(), L.change_orders()
    direct = gold.client_analytics(c, b, co, RUN_TS)
    written = sinks.read_table(spark, res.tables["gold.client_analytics"])
    assert canon(written.columns, [tuple(r) for r in written.collect()], 12) == \
        canon(direct.columns, [tuple(r) for r in direct.collect()], 12)
    assert sinks.read_table(spark, res.tables["silver.contracts_silver"]).count() == c.count()
    checks = {r["check_name"]: r["passed"] for r in res.checks}
    assert len(checks) == 7
    assert checks["validate_silver_contracts"] and checks["validate_gold_project_analytics"]
    # The test data has a NULL client: the client checks fail, as they should.
    assert not checks["validate_gold_client_analytics"]
    assert res.schema_tests_failed > 0


def test_layered_run_raises_on_failed_check(spark, bronze_dir):
    from tierwise.session import scratch_path
    with pytest.raises(AssertionError, match="validate_gold_client_analytics"):
        run_layers(spark, bronze_dir, scratch_path(spark, "layers"), run_ts=RUN_TS, as_of=SPINE_AS_OF)


def test_missing_bronze_file_fails(spark):
    from tierwise.session import scratch_path
    with pytest.raises(FileNotFoundError):
        run_layers(spark, scratch_path(spark, "nothing"), scratch_path(spark, "layers"))


def _deliver(spark, frames, name):
    from tierwise.session import scratch_path
    root = scratch_path(spark, name)
    for fname, df in zip(("contracts.csv", "budgets.csv", "co.csv"), frames):
        sinks.write_csv(df.coalesce(1), f"{root}/{fname}")
    return root


@pytest.fixture(scope="module")
def corrected_dir(spark):
    """The delivery with clients and ids for all rows: no check is in error."""
    L = Layers(spark, SF_SMALL)
    return _deliver(spark, corrected(L.bronze.contracts(), L.bronze.budgets(), L.bronze.change_orders()), "corrected-in")


def test_layered_run_into_catalog_databases(spark, corrected_dir):
    res = run_layers(spark, corrected_dir, None, run_ts=RUN_TS, as_of=SPINE_AS_OF,
                     raise_on_failure=False, database_prefix="tw_test")
    dbs = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert {"tw_test_bronze", "tw_test_silver", "tw_test_gold", "tw_test_quality"} <= dbs
    assert spark.table("tw_test_gold.project_analytics").count() == \
        spark.table("tw_test_silver.contracts_silver").count()
    assert res.published and spark.table("`tw_test_gold`.`time_analytics`").count() == 44


def test_only_runs_without_errors_are_published(spark, bronze_dir, corrected_dir, tmp_out):
    good = run_layers(spark, corrected_dir, tmp_out, run_ts=RUN_TS, as_of=SPINE_AS_OF)
    # Contracts without a start or a value: warnings, published all the same.
    assert good.published and good.passed and good.schema_tests_failed > 0
    before = versions.current(spark, tmp_out)
    rows = published_table(spark, tmp_out, "gold.client_analytics").count()
    bad = run_layers(spark, bronze_dir, tmp_out, run_ts="2024-02-01 00:00:00", as_of=SPINE_AS_OF, raise_on_failure=False)
    assert not bad.published and not bad.passed
    assert versions.current(spark, tmp_out) == before
    assert published_table(spark, tmp_out, "gold.client_analytics").count() == rows
    stamps = published_table(spark, tmp_out, "gold.project_analytics").select("processed_at").distinct().collect()
    assert [str(r[0]) for r in stamps] == [RUN_TS]
    # The rejected version stays, with its findings.
    findings = spark.read.parquet(bad.tables["quality.audit"]).where("severity = 'error' and not passed")
    assert {r.check_name for r in findings.collect()} == {
        "validate_gold_client_analytics", "validate_gold_contract_summary", "validate_silver_budgets",
        "validate_silver_change_orders"}
    with pytest.raises(FileNotFoundError):
        published_table(spark, tmp_out, "gold.nothing")


def test_each_detail_table_is_scanned_once_for_all_gold_models(spark):
    """Models read rollups: the plans of contract_summary, project_analytics and
    client_analytics hold no scan of a detail table."""
    L = Layers(spark, SF_SMALL)
    for name, df in (("contract_summary", gold.contract_summary(*L.rolled_up()[:2], RUN_TS)),
                     ("project", gold.project_analytics(*L.rolled_up(), RUN_TS)),
                     ("client", gold.client_analytics(*L.rolled_up(), RUN_TS))):
        read = {f.rsplit("/", 2)[-2].rsplit("-", 1)[0] for f in df.inputFiles()}
        assert "budgets_silver-per_key" in read, name
        assert read <= {"contracts_silver", *(f"{d}_silver-{part}" for d in ("budgets", "change_orders")
                                              for part in ("per_key", "shared"))}, name


def test_time_analytics_reads_the_spines_months(spark):
    L = Layers(spark, SF_SMALL)
    df = gold.time_analytics(*L.monthly(), as_of=SPINE_AS_OF, run_ts=RUN_TS, ordered=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 3
    assert all("month_key#" in s and ">= 199801" in s and "<= 200108" in s for s in scans)
    stored = L.by_month("contracts_silver")
    months = {r[0] for r in stored.select("month_key").distinct().collect()}
    assert 0 in months and len(months) > 44            # rows without a date are kept, in a partition of their own
    assert len([n for n in months if 199801 <= n <= 200108]) == 44


def test_rollup_counts_ids_like_the_join(spark):
    """Ids under several contracts, repeated contracts, NULL ids and keys."""
    contracts = spark.createDataFrame(
        [("c1", "A"), ("c2", "A"), ("c2", "A"), ("c3", "B"), ("c4", None), ("c1", "B"), (None, "B")],
        "contract_id string, client_name string").withColumn("contract_value", F.lit(1).cast("decimal(38,9)"))
    budgets = spark.createDataFrame(
        [("c1", "b1"), ("c1", "b1"), ("c2", "b1"), ("c2", "b2"), ("c3", "b2"), ("c3", None), ("c4", "b9"), (None, "b5"), ("zz", "b7")],
        "contract_id string, budget_id string").withColumn("original_amount", F.lit("2.5").cast("decimal(38,9)")) \
        .withColumn("actual_cost", F.lit(1).cast("decimal(38,9)"))
    plain = gold.client_budgets(contracts, budgets)
    shared = gold.client_budgets(contracts, gold.budget_rollup(budgets))
    assert sorted(map(str, plain.collect())) == sorted(map(str, shared.collect()))
    assert {r.client_name: r.total_budgets for r in shared.collect()} == {"A": 2, "B": 2, None: 1}
