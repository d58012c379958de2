"""Monitoring operators on small frames."""

import datetime as dt

from tierwise.operators import monitoring

AS_OF = "2024-01-31 00:00:00"


def _stamped(spark, stamps):
    return spark.createDataFrame([(dt.datetime.fromisoformat(s),) for s in stamps],
                                 "processed_at timestamp_ntz")


def test_freshness_hours_error_row_and_stale(spark):
    fresh = _stamped(spark, ["2024-01-30 20:30:00"])          # 3.5 h -> 3
    stale = _stamped(spark, ["2024-01-29 23:00:00"])          # 25 h
    no_stamp = spark.range(3)
    rows = {r["table_name"]: r for r in monitoring.freshness(
        {"a": fresh, "b": stale, "c": no_stamp}, as_of=AS_OF).collect()}
    assert (rows["a"]["hours_since_update"], rows["a"]["is_stale"]) == (3, False)
    assert (rows["b"]["hours_since_update"], rows["b"]["is_stale"]) == (25, True)
    assert rows["c"]["error"] and rows["c"]["row_count"] is None
    assert [r["table_name"] for r in monitoring.freshness_alerts(
        monitoring.freshness({"a": fresh, "b": stale}, as_of=AS_OF)).collect()] == ["b"]


def test_volume_trend_uses_previous_existing_day(spark):
    stamps = (["2024-01-25 10:00:00"] * 10 + ["2024-01-27 10:00:00"] * 13
              + ["2024-01-28 10:00:00"] * 13 + ["2024-01-20 10:00:00"] * 50)   # outside window
    t = monitoring.volume_trend({"t": _stamped(spark, stamps)}, as_of=AS_OF)
    rows = t.orderBy("process_date").collect()
    assert [r["daily_count"] for r in rows] == [10, 13, 13]
    assert rows[0]["previous_count"] is None
    assert rows[1]["day_over_day_change_pct"] == 30.0        # vs 25th, not the missing 26th
    alerts = monitoring.volume_alerts(t, 20).collect()
    assert [a["process_date"] for a in alerts] == [dt.date(2024, 1, 27)]
    report = monitoring.monitoring_report(
        monitoring.freshness({"t": _stamped(spark, stamps)}, as_of=AS_OF), t, 20).collect()
    assert sorted(r["message"] for r in report) == [
        "Data in t is stale! Last update was 62 hours ago.",
        "Significant volume change in t on 2024-01-27: 30.00% change"]
    assert monitoring.alert_count(spark.createDataFrame(report)).first()["total_alerts"] == 2


def test_null_audit_always_one_row(spark):
    ok = spark.createDataFrame([("1", "n", dt.date(2024, 1, 1), dt.date(2024, 2, 1), 1.0, "active")],
                               "contract_id string, contract_name string, start_date date, "
                               "end_date date, contract_value double, contract_status string")
    r = monitoring.null_audit(ok).collect()
    assert len(r) == 1 and r[0]["total_nulls"] == 0 and r[0]["passed"]
    bad = ok.union(spark.createDataFrame([(None, None, None, None, None, None)], ok.schema))
    r = monitoring.null_audit(bad).first()
    assert (r["total_nulls"], r["passed"]) == (6, False)


def test_unreadable_table_gives_error_row(spark, tmp_out):
    from tierwise.sources import sinks
    good = f"{tmp_out}/good"
    sinks.write_table(_stamped(spark, ["2024-01-30 20:30:00"]), good)
    tables = monitoring.load_tables(spark, {"good": good, "gone": f"{tmp_out}/missing"})
    assert isinstance(tables["gone"], str)
    rows = {r["table_name"]: r for r in monitoring.freshness(tables, as_of=AS_OF).collect()}
    assert rows["good"]["hours_since_update"] == 3 and rows["good"]["error"] is None
    assert rows["gone"]["error"] and rows["gone"]["row_count"] is None
    assert [r["table_name"] for r in monitoring.volume_trend(tables, as_of=AS_OF).collect()] == ["good"]
