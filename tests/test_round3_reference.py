"""Versions and pointers, zones and amounts, suites on storage, JSON hand-over,
kept profiles, uniqueness in long form."""

import datetime as dt
import json
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierwise.functions.casts import safe_date, safe_money, safe_timestamp, utc_text
from tierwise.functions.metrics import money_minus, money_plus, money_times_sum
from tierwise.operators import monitoring, quality
from tierwise.operators.quality import Rule
from tierwise.plans import validate as V
from tierwise.session import scratch_path
from tierwise.sources import bronze, sinks, versions

AS_OF = "2024-01-31 00:00:00"


def broken(spark):
    return spark.range(5).select(F.when(F.col("id") < 4, F.col("id"))
                                 .otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"))


# ------------------------------------------------------------- versions

def test_a_reader_never_misses_the_table(spark, tmp_out):
    path = f"{tmp_out}/t"
    sinks.write_table(spark.range(10), path)
    seen, errors, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(sinks.read_table(spark, path).count())
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (20, 30, 40, 50):
            sinks.write_table(spark.range(n), path)
    finally:
        stop.set()
        reader.join()
    assert not errors and seen <= {10, 20, 30, 40, 50}
    assert sinks.read_table(spark, path).count() == 50
    fs, p = versions.filesystem(spark, f"{path}/_versions")
    assert len(fs.listStatus(p)) == versions.KEEP


def test_two_publishers_take_turns(spark, tmp_out):
    root, made = f"{tmp_out}/set", []
    for k in range(2):
        made.append(sinks.write_files(spark.range(k + 1), versions.fresh(root) + "/x"))
    numbers = []
    threads = [threading.Thread(target=lambda m=m: numbers.append(versions.publish(spark, root, {"x": m}))) for m in made]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(numbers) == [1, 2]
    assert versions.current(spark, root)["x"] in made
    with pytest.raises(ValueError):
        versions.publish(spark, root, {"x": "/elsewhere/x"})
    assert versions.current(spark, f"{tmp_out}/nothing") is None


def test_a_failed_catalog_overwrite_keeps_the_old_table(spark, tmp_out):
    sinks.ensure_database(spark, "tw_views")
    name = "`tw_views`.`t`"
    sinks.publish_view(spark, name, sinks.write_files(spark.range(10), f"{tmp_out}/1"))
    with pytest.raises(Exception):
        sinks.publish_view(spark, name, sinks.write_files(broken(spark), f"{tmp_out}/2"))
    assert spark.table(name).count() == 10
    # Another schema takes over in one step, too.
    sinks.publish_view(spark, name, sinks.write_files(spark.range(3).withColumn("b", F.lit("x")), f"{tmp_out}/3"))
    assert spark.table(name).columns == ["id", "b"]


def test_a_table_of_an_earlier_release_becomes_a_view(spark, tmp_out):
    sinks.ensure_database(spark, "tw_old")
    spark.range(4).write.mode("overwrite").saveAsTable("tw_old.t")
    sinks.publish_view(spark, "`tw_old`.`t`", sinks.write_files(spark.range(6), f"{tmp_out}/1"))
    assert spark.table("tw_old.t").count() == 6


# ------------------------------------------------------- zones and amounts

ZONED = {"2024-01-05T10:00+05:00": (5, 0), "2024-01-05 10:00+05": (5, 0), "2024-01-05 10:00:00+5": (5, 0),
         "2024-01-05 10:00:00 -0330": (13, 30), "2024-01-05T10:00:00Z": (10, 0), "2024-01-05 10:00:00 Europe/Paris": (9, 0),
         "2024-07-05 10:00:00 America/New_York": (14, 0), "2024-01-05 10:00": (10, 0), "2024-01-05": (0, 0),
         "2024-01-05 UTC": (0, 0), "2024-01-05 10:00:00 Nowhere/City": None, "2024-01-05 10:00:00 or so": None,
         "2024-02-30 10:00:00+01:00": None, "2024-01-05 25:00:00": None, "": None}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_timestamps_with_zones(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r.v: r for r in spark.createDataFrame([(v,) for v in ZONED], "v string").select(
            "v", safe_timestamp("v").alias("t"), utc_text(safe_timestamp("v")).alias("x")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for v, want in ZONED.items():
        assert (got[v].t and (got[v].t.hour, got[v].t.minute)) == want, v
    assert got["2024-01-05T10:00+05:00"].x == "2024-01-05T05:00:00Z" and got[""].x is None


def test_wall_clocks_in_a_gap_of_the_session_zone(spark):
    """02:30 does not exist on that day in New York; in UTC it does."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-03-10T03:30:00+01:00",)], "v string").select(
            utc_text(safe_timestamp("v")).alias("x")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [x.x for x in r] == ["2024-03-10T02:30:00Z"] * 2


def test_full_width_amounts(spark):
    big = "12345678901234567890123456789.123456789"
    df = spark.createDataFrame([(big, "-0.000000001"), ("1.5", "x"), ("-7", None)], "a string, b string")
    rows = df.select(safe_money("a").alias("a"), safe_money("b").alias("b")).collect()
    assert rows[0].a == Decimal(big) and rows[0].b == Decimal("-0.000000001") and rows[1].b is None
    m = spark.sql("SELECT CAST('1234567890123456789.000000001' AS DECIMAL(38,9)) a, CAST('-0.000000002' AS DECIMAL(38,9)) b, "
                  "CAST('-5.25' AS DECIMAL(38,9)) c").select(
        money_plus(F.col("a"), F.col("b")).alias("p"), money_minus(F.col("b"), F.col("a")).alias("m"),
        money_minus(F.col("c"), F.col("b")).alias("q")).first()
    assert (m.p, m.m, m.q) == (Decimal("1234567890123456788.999999999"), Decimal("-1234567890123456789.000000003"),
                               Decimal("-5.249999998"))
    s = spark.sql("SELECT * FROM VALUES (CAST('0.000000001' AS DECIMAL(38,9)), 3000000000L), (CAST('-2.5' AS DECIMAL(38,9)), 7L) AS t(v, n)")
    assert s.agg(money_times_sum(F.col("v"), F.col("n")).alias("s")).first().s == Decimal("-14.5")


def test_dates_in_other_forms_still_pass(spark):
    vals = {"2024-1-5": dt.date(2024, 1, 5), " 2024-01-05 ": dt.date(2024, 1, 5), "2024": None, "2024-01-05 x": None, "2024-13-01": None}
    got = {r.v: r.d for r in spark.createDataFrame([(v,) for v in vals], "v string").select("v", safe_date("v").alias("d")).collect()}
    assert got == vals


# ------------------------------------------------------------- bronze files

def test_quoted_newlines_are_found_and_only_then_read_whole(spark, tmp_out):
    plain, quoted = f"{tmp_out}/plain.csv", f"{tmp_out}/quoted.csv"
    versions.write_file(spark, plain, 'a,b\n"x, ""y""",1\nz,2\n')
    versions.write_file(spark, quoted, 'a,b\n"two\nlines ""here""",1\nz,2\n')
    assert not bronze.quoted_newlines(spark, plain) and bronze.quoted_newlines(spark, quoted)
    assert [r.a for r in bronze.read_csv_inferred(spark, plain).collect()] == ['x, "y"', "z"]
    assert [r.a for r in bronze.read_csv_inferred(spark, quoted).collect()] == ['two\nlines "here"', "z"]
    schema = bronze.BRONZE_BUDGETS
    assert bronze.read_text_csv(spark, quoted, schema).count() == 2


# ------------------------------------------------------------- suites, files

GOOD = {"expectation_suite_name": "bronze.t", "expectations": [
    {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "a"}},
    {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "b", "value_set": ["x", "y"]},
     "meta": {"severity": "warn"}}]}


def test_suites_from_storage(spark, tmp_out):
    files = {"good": json.dumps(GOOD, indent=1), "broken": "{not json", "shape": '{"expectations": [{"kwargs": {}}]}',
             "none": "[1, 2]", "bare": '{"expectation_suite_name": "s", "expectations": []}'}
    for name, text in files.items():
        versions.write_file(spark, f"{tmp_out}/{name}.json", text)
    paths = [f"{tmp_out}/{n}.json" for n in [*files, "gone"]]
    out = {p.rsplit("/", 1)[-1][:-5]: v for p, v in quality.load_suites(spark, paths).items()}
    assert out["good"] == ("bronze.t", [Rule("expect_column_values_to_not_be_null", {"column": "a"}),
                                        Rule("expect_column_values_to_be_in_set", {"column": "b", "value_set": ["x", "y"]}, "warn")])
    assert (out["broken"], out["shape"], out["none"]) == ("suite file invalid",) * 3
    assert out["gone"] == "suite file missing"
    assert out["bare"][1] == []


def test_validation_goes_on_past_bad_files(spark, tmp_out):
    versions.write_file(spark, f"{tmp_out}/suite.json", json.dumps(GOOD))
    versions.write_file(spark, f"{tmp_out}/ok.csv", "a,b\n1,x\n2,y\n")
    versions.write_file(spark, f"{tmp_out}/bad.csv.gz", "no gzip")
    suite = f"{tmp_out}/suite.json"
    rows = {r.dataset: r for r in V.validate(spark, [
        V.Target("bronze", "bad", f"{tmp_out}/bad.csv.gz", suite), V.Target("bronze", "ok", f"{tmp_out}/ok.csv", suite),
        V.Target("silver", "later", f"{tmp_out}/later.csv", suite), V.Target("bronze", "gone", f"{tmp_out}/gone.csv", suite)]).collect()}
    assert (rows["ok"].status, rows["ok"].rules) == ("PASSED", 2)
    assert rows["bad"].status == "FAILED" and rows["bad"].note.startswith("unreadable: ")
    assert (rows["later"].status, rows["gone"].status) == ("PASSED", "FAILED")


# ------------------------------------------------------------- uniqueness

def test_uniqueness_rules_share_one_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), F.col("id").cast("string").alias("b"),
                                  F.when(F.col("id") % 2 == 0, F.col("id")).alias("c"),
                                  F.when(F.col("id") == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("d"))
    rules = [Rule("expect_column_values_to_be_unique", {"column": c}) for c in "abcd"]
    rules.insert(1, Rule("expect_column_values_to_not_be_null", {"column": "c"}))
    out = quality.evaluate_suite(df, rules, "s.t")
    got = [r.violations for r in out.collect()]
    assert got == [990, 500, 0, 499, 999]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "distinct" not in plan.lower()
    initial = quality.evaluate_suite(df, rules, "s.t")._jdf.queryExecution().executedPlan().toString()
    assert initial.count("Exchange hashpartitioning") == 1
    tests = quality.unique_tests(df, "m", ["a", "b", "c"])
    assert [(r.column_name, r.failures, r.passed) for r in tests.collect()] == [("a", 10, False), ("b", 0, True), ("c", 0, True)]
    one = [quality.unique_test(df, "m", c).first().failures for c in "abc"]
    assert one == [10, 0, 0]
    empty = quality.evaluate_suite(df.limit(0), rules, "s.t").collect()
    assert [r.violations for r in empty] == [0] * 5


def test_reconcile(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "id string")
    b = spark.createDataFrame([("x",), ("z",)], "id string")
    r = quality.reconcile(a, b, "d").first()
    assert (r.bronze_rows, r.silver_rows, r.missing_ids, r.passed) == (4, 2, 1, False)
    r = quality.reconcile(a.limit(0), b, "d").first()
    assert (r.bronze_rows, r.silver_rows, r.missing_ids, r.passed) == (0, 2, 0, True)


# ------------------------------------------------------------- monitoring

def stamped(spark, stamps):
    return spark.createDataFrame([(s and dt.datetime.fromisoformat(s),) for s in stamps], "processed_at timestamp_ntz")


@pytest.mark.parametrize("as_of", ["2024-01-31 00:00:00", "2024-01-31 10:00:00", "2024-02-01 23:59:59", "2024-03-01 00:00:00"])
def test_kept_profiles_give_what_the_tables_give(spark, as_of):
    root = scratch_path(spark, "profiles")
    tables = {"a": stamped(spark, ["2024-01-24 00:00:00", "2024-01-24 09:00:00", "2024-01-24 10:00:00", "2024-01-24 23:00:00",
                                   "2024-01-30 20:30:00", None]),
              "b": stamped(spark, ["2024-01-25 10:00:00"] * 3), "empty": stamped(spark, []), "plain": spark.range(3), "gone": "no such table"}
    for name, df in tables.items():
        if not isinstance(df, str) and "processed_at" in df.columns:
            monitoring.keep_profile(df, root, name)
    kept = monitoring.kept_profile(spark, root, tables, as_of=as_of)
    full = monitoring.profile(tables, as_of=as_of)
    for f in (lambda p: monitoring.freshness(p, as_of=as_of), monitoring.volume_trend):
        assert sorted(map(str, f(kept).collect())) == sorted(map(str, f(full).collect()))


def test_freshness_reads_profiles_only(spark):
    from conftest import SF_SMALL
    from tierwise.plans import monitoring_queries as M
    for q in (M.q_freshness, M.q_volume_trend):
        files = q(spark, SF_SMALL).inputFiles()
        assert files and all("/profiles/table_name=" in f for f in files)


def test_json_hand_over_read_back(spark):
    day = dt.date(2024, 1, 30)
    texts = spark.createDataFrame([
        ("ok", '{"hours_since_update":3,"row_count":5,"is_stale":false,"error":null}',
         '[{"process_date":"2024-01-30","daily_count":5,"previous_count":null}]'),
        ("none", '{"hours_since_update":null,"row_count":0,"is_stale":false,"error":null}', "[]"),
        ("failed", '{"hours_since_update":null,"row_count":null,"is_stale":false,"error":"boom"}', '{"error":"boom"}'),
        ("cut", '{"hours_since_update":3,"row_co', '[{"process_date":"2024'), ("wrong", '{"row_count":"many"}', "[]"), ("null", None, None)],
        "table_name string, freshness_json string, volume_json string")
    rows = {r.table_name: r for r in monitoring.decode_json(texts).collect()}
    assert (rows["ok"].hours_since_update, rows["ok"].process_date, rows["ok"].daily_count, rows["ok"].corrupt) == (3, day, 5, False)
    assert (rows["none"].row_count, rows["none"].process_date, rows["none"].volume_error) == (0, None, None)
    assert (rows["failed"].freshness_error, rows["failed"].volume_error, rows["failed"].corrupt) == ("boom", "boom", False)
    assert rows["cut"].corrupt and rows["wrong"].corrupt and not rows["null"].corrupt


def test_report_time_is_utc_text(spark):
    fresh = monitoring.freshness({"t": stamped(spark, ["2024-01-20 00:00:00"])}, as_of=AS_OF)
    trend = monitoring.volume_trend({"t": stamped(spark, ["2024-01-20 00:00:00"])}, as_of=AS_OF)
    assert monitoring.monitoring_report(fresh, trend, as_of=AS_OF).first().reported_at == "2024-01-31T00:00:00Z"
    now = monitoring.monitoring_report(fresh, trend).first().reported_at
    assert abs(dt.datetime.fromisoformat(now.rstrip("Z")) - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=5)


def test_stored_layers_are_shared_and_follow_the_input(spark, tmp_path):
    import os
    import shutil
    from conftest import SF_SMALL
    from tierwise.plans.catalog import Layers
    src = str(tmp_path / "sf")
    os.makedirs(src)
    for t in ("orders", "lineitem", "events"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", f"{src}/{t}.parquet")     # not its read-only mode
    one, two = Layers(spark, src).model("contracts_silver"), Layers(spark, src).model("contracts_silver")
    assert one.inputFiles() == two.inputFiles()
    n = one.count()
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").limit(7).toPandas().to_parquet(f"{src}/orders.parquet", coerce_timestamps="us")
    assert n > 7 and Layers(spark, src).model("contracts_silver").count() == 7
