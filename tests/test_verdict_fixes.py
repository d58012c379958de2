"""Casts, CSV dialect, overwrites, stamps and failing tables on values written by hand."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tierwise.functions.casts import safe_date, safe_timestamp
from tierwise.functions.metrics import as_of_date, stamp
from tierwise.operators import monitoring
from tierwise.operators.quality import check_rule, load_suite
from tierwise.sources import sinks
from tierwise.sources.bronze import read_csv_inferred


def test_tolerant_casts_reject_junk_and_apply_offsets(spark):
    rows = ["2024-01-05", "2024-01-05 junk", "2024-01-05Tjunk", "2024-01-05T10:00:00+05:00",
            "2024-01-05 10:00:00-08:00", "2024-01-05T10:00:00Z", "2024"]
    got = spark.createDataFrame([(r,) for r in rows], "v string").select(
        "v", safe_date("v").alias("d"), safe_timestamp("v").alias("t"))
    out = {r.v: (r.d, r.t) for r in got.collect()}
    day = dt.date(2024, 1, 5)
    assert [out[r][0] for r in rows] == [day, None, None, day, day, day, None]
    hours = [0, None, None, 5, 18, 10, None]
    assert [t and t.hour for _, t in (out[r] for r in rows)] == hours


def test_quotes_newlines_and_backslashes(spark, tmp_path):
    path = os.path.join(tmp_path, "hand.csv")
    with open(path, "w", newline="") as f:
        f.write('a,b\n"say ""hi"", you",1\n"two\nlines",2\n"C:\\dir\\",3\n')
    got = read_csv_inferred(spark, path).orderBy("b").select(F.col("a")).collect()
    assert [r.a for r in got] == ['say "hi", you', "two\nlines", "C:\\dir\\"]


def test_a_suite_of_the_wrong_shape_is_invalid(tmp_path):
    for k, text in enumerate(("[]", '{"expectations": [{}]}', "no json")):
        path = os.path.join(tmp_path, f"{k}.json")
        with open(path, "w") as f:
            f.write(text)
        assert load_suite(path) is None


def test_a_failed_overwrite_keeps_the_old_table(spark, tmp_out):
    path = f"{tmp_out}/t"
    sinks.write_table(spark.range(10), path)
    sinks.write_table(spark.range(7), path)
    assert sinks.read_table(spark, path).count() == 7
    bad = spark.range(5).select(F.when(F.col("id") < 4, F.col("id"))
                                .otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"))
    with pytest.raises(Exception):
        sinks.write_table(bad, path)
    assert sinks.read_table(spark, path).count() == 7


def test_stamps_are_utc_in_every_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            row = spark.range(1).select(stamp().alias("s"), as_of_date().alias("d")).first()
            after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            assert before - dt.timedelta(seconds=1) <= row.s <= after + dt.timedelta(seconds=1)
            assert row.d in (before.date(), after.date())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_tables_that_fail_while_read_do_not_stop_the_others(spark):
    good = spark.sql("select timestamp_ntz'2024-01-30 20:30:00' as processed_at")
    tables = {"good": good, "bad": spark.range(3).select(
        F.raise_error(F.lit("broken")).cast("timestamp_ntz").alias("processed_at")),
        "empty": good.limit(0), "plain": spark.range(2)}
    p = monitoring.profile(tables, as_of="2024-01-31 00:00:00")
    fresh = {r.table_name: r for r in monitoring.freshness(p, as_of="2024-01-31 00:00:00").collect()}
    assert fresh["good"].hours_since_update == 3 and fresh["good"].error is None
    assert "broken" in fresh["bad"].error and fresh["bad"].row_count is None
    assert (fresh["empty"].row_count, fresh["empty"].error) == (0, None)
    out = {r.table_name: r.volume_json for r in monitoring.monitoring_json(
        monitoring.freshness(p, as_of="2024-01-31 00:00:00"), monitoring.volume_trend(p)).collect()}
    assert out["empty"] == "[]" and '"error"' in out["bad"] and '"error"' in out["plain"]
    assert monitoring.volume_trend({"plain": spark.range(2)}).collect() == []


def test_rules_on_absent_pair_columns_fail(spark):
    rule = "expect_column_pair_values_A_to_be_greater_than_B"
    assert not check_rule(spark.range(2), rule, column_A="id", column_B="gone")
    assert check_rule(spark.range(2), "expect_table_columns_to_match_ordered_list", column_list=["id"])
