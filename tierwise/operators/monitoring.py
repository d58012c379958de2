"""Monitoring: freshness, volume trend, alert report, null audit.

Tables are passed as ``{name: DataFrame}`` and results are typed
DataFrames with a ``table_name`` column.  Per table the work is a single
per-day aggregate (:func:`profile`), from which both freshness and trend
follow, so only a handful of rows per table leave the scans; the
day-over-day window is partitioned by
``table_name`` and never sees more than ``lookback_days + 1`` rows per
partition.

A table version never changes, so its per-day profile can be kept with it
(:func:`keep_profile`); monitoring then reads the kept profiles
(:func:`kept_profile`) and no table at all, but for the one day that a look-back
window may cut in two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierwise.functions.casts import utc_text
from tierwise.functions.metrics import stamp as stamp_of
from tierwise.session import scratch_path
from tierwise.sources import sinks

# Reference thresholds.
STALE_HOURS = 24
VOLUME_LOOKBACK_DAYS = 7
VOLUME_CHANGE_PCT = 20.0


def _now(as_of) -> Column:
    return stamp_of(as_of)


def load_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> dict[str, DataFrame | str]:
    """Open each monitored table; one that cannot be opened maps to its error
    text, so the monitoring queries report it and carry on with the rest."""
    out: dict[str, DataFrame | str] = {}
    for name, path in paths.items():
        try:
            out[name] = sinks.read_table(spark, path, fmt)
        except Exception as e:  # noqa: BLE001 - any load failure becomes an error row
            out[name] = f"{type(e).__name__}: {e}"
    return out


PROFILE = ("table_name string, process_date date, row_count long, window_count long, "
           "latest timestamp_ntz, error string")


def profile(tables: dict[str, DataFrame | str], as_of=None, stamp: str = "processed_at",
            lookback_days: int = VOLUME_LOOKBACK_DAYS) -> DataFrame:
    """One pass over each table: rows, newest stamp and rows inside the
    look-back window per day, and one row without a date that carries the
    table's error, if any.

    Each table's few rows are written to the shared folder by themselves; a
    table that cannot be opened, has no stamp column or fails while it is read
    yields its error, and the others still run.
    """
    spark = next((t.sparkSession for t in tables.values() if not isinstance(t, str)),
                 None) or SparkSession.builder.getOrCreate()
    root = scratch_path(spark, "monitoring")
    since = _now(as_of) - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    ts = F.col(stamp).cast("timestamp_ntz")
    parts, heads = [], []
    for i, (name, df) in enumerate(tables.items()):
        error = None
        if isinstance(df, str):
            error = df
        elif stamp not in df.columns:
            error = f"column {stamp} not found"
        else:
            try:
                (df.groupBy(F.to_date(ts).alias("process_date"))
                 .agg(F.count(F.lit(1)).alias("row_count"),
                      F.count_if(ts > since).alias("window_count"),
                      F.max(ts).alias("latest"))
                 .select(F.lit(name).alias("table_name"), "process_date", "row_count", "window_count",
                         "latest", F.lit(None).cast("string").alias("error"))
                 .write.parquet(f"{root}/{i}"))
                parts.append(f"{root}/{i}")
            except Exception as e:  # noqa: BLE001 - any failure becomes the table's error row
                error = f"{type(e).__name__}: {e}"
        heads.append((name, None, 0, 0, None, error))
    out = spark.createDataFrame(heads, PROFILE)
    return out.unionByName(spark.read.schema(PROFILE).parquet(*parts)) if parts else out


KEPT = "process_date date, row_count long, earliest timestamp_ntz, latest timestamp_ntz, table_name string"


def keep_profile(df: DataFrame, root: str, name: str, stamp: str = "processed_at") -> None:
    """Write a table version's profile (rows, first and last stamp per day)
    below ``root``, the folder of all profiles."""
    ts = F.col(stamp).cast("timestamp_ntz")
    (df.groupBy(F.to_date(ts).alias("process_date"))
     .agg(F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("earliest"), F.max(ts).alias("latest"))
     .coalesce(1).write.mode("overwrite").parquet(f"{root}/table_name={name}"))


def kept_profile(spark: SparkSession, root: str, tables: dict[str, DataFrame | str], as_of=None,
                 stamp: str = "processed_at", lookback_days: int = VOLUME_LOOKBACK_DAYS) -> DataFrame:
    """The frame of :func:`profile` from kept profiles: one scan of a few rows.

    ``tables`` names the monitored tables; one without the stamp column, or
    given as an error text, has an error row.  A table is read only if the
    window begins within one of its days (between its first and last stamp),
    and then only that day's rows.
    """
    since = _now(as_of) - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    errors = {n: t if isinstance(t, str) else f"column {stamp} not found"
              for n, t in tables.items() if isinstance(t, str) or stamp not in t.columns}
    heads = spark.createDataFrame([(n, None, 0, 0, None, errors.get(n)) for n in tables], PROFILE)
    named = [n for n in tables if n not in errors]
    if not named:
        return heads
    days = spark.read.schema(KEPT).parquet(root).where(F.col("table_name").isin(named))
    cut = (F.col("earliest") <= since) & (F.col("latest") > since)
    inside = F.when(F.col("earliest") > since, F.col("row_count")).otherwise(0)
    for name in (r.table_name for r in days.where(cut).select("table_name").collect()):
        ts = F.col(stamp).cast("timestamp_ntz")
        rows = tables[name].where((ts > since) & (ts < F.date_add(F.to_date(since), 1).cast("timestamp_ntz"))).count()
        inside = F.when(cut & (F.col("table_name") == name), rows).otherwise(inside)
    return heads.unionByName(days.select(
        "table_name", "process_date", "row_count", inside.cast("long").alias("window_count"), "latest",
        F.lit(None).cast("string").alias("error")))


def _profiled(tables, *args) -> DataFrame:
    return tables if isinstance(tables, DataFrame) else profile(tables, *args)


def freshness(tables: dict[str, DataFrame | str] | DataFrame, as_of=None, stamp: str = "processed_at",
              stale_hours: int = STALE_HOURS) -> DataFrame:
    """Hours since the newest stamp and row count per table (or of a
    :func:`profile`).

    ``hours_since_update`` counts whole elapsed hours.  A table with an error
    has an error row without figures.
    """
    hours = F.timestamp_diff("HOUR", F.col("latest"), _now(as_of)).cast("long")
    return (_profiled(tables, as_of, stamp).groupBy("table_name")
            .agg(F.max("latest").alias("latest"), F.sum("row_count").alias("n"), F.max("error").alias("error"))
            .select("table_name", hours.alias("hours_since_update"),
                    F.when(F.col("error").isNull(), F.col("n")).alias("row_count"),
                    F.coalesce(hours > stale_hours, F.lit(False)).alias("is_stale"), "error"))


def freshness_alerts(fresh: DataFrame) -> DataFrame:
    return fresh.where(F.col("is_stale"))


def volume_trend(tables: dict[str, DataFrame | str] | DataFrame, as_of=None, stamp: str = "processed_at",
                 lookback_days: int = VOLUME_LOOKBACK_DAYS) -> DataFrame:
    """Daily row counts in the look-back window and the day-over-day change,
    per table (or of a :func:`profile`).

    The previous value is the previous *existing* day (lag over the days
    that have rows), so the first day has no change.  A table without rows in
    the window, or with an error, has no rows here; :func:`monitoring_json`
    tells the two apart.
    """
    days = (_profiled(tables, as_of, stamp, lookback_days).where(F.col("window_count") > 0)
            .select("table_name", "process_date", F.col("window_count").alias("daily_count")))
    w = Window.partitionBy("table_name").orderBy("process_date")
    prev = F.lag("daily_count", 1).over(w)
    return (days.withColumn("previous_count", prev)
            .withColumn("day_over_day_change_pct",
                        (F.col("daily_count") - F.col("previous_count")).cast("double")
                        / F.col("previous_count").cast("double") * F.lit(100.0)))


def volume_alerts(trend: DataFrame, threshold_pct: float = VOLUME_CHANGE_PCT) -> DataFrame:
    """Days whose |change| exceeds the threshold (days without a change drop out)."""
    return trend.where(F.abs(F.col("day_over_day_change_pct")) > F.lit(float(threshold_pct)))


def monitoring_report(fresh: DataFrame, trend: DataFrame,
                      threshold_pct: float = VOLUME_CHANGE_PCT, as_of=None) -> DataFrame:
    """All alerts with their messages: stale tables and volume anomalies.
    ``reported_at`` is the report's time as UTC text, whatever the session's
    time zone."""
    stale = freshness_alerts(fresh).select(
        F.lit("stale_data").alias("type"), F.col("table_name").alias("table"),
        "hours_since_update",
        F.format_string("Data in %s is stale! Last update was %d hours ago.",
                        F.col("table_name"), F.col("hours_since_update")).alias("message"))
    vol = volume_alerts(trend, threshold_pct).select(
        F.lit("volume_anomaly").alias("type"), F.col("table_name").alias("table"),
        F.col("process_date").alias("date"),
        F.col("day_over_day_change_pct").alias("change_pct"),
        F.format_string("Significant volume change in %s on %s: %.2f%% change",
                        F.col("table_name"), F.col("process_date").cast("string"),
                        F.col("day_over_day_change_pct")).alias("message"))
    return (stale.unionByName(vol, allowMissingColumns=True)
            .withColumn("reported_at", utc_text(_now(as_of))))


def alert_count(report: DataFrame) -> DataFrame:
    return report.agg(F.count(F.lit(1)).alias("total_alerts"))


def monitoring_json(fresh: DataFrame, trend: DataFrame) -> DataFrame:
    """Per table: the freshness record and the list of daily records as JSON text
    (``[]`` without rows in the window, an error object for a failed table).

    The daily list is bounded by the look-back window (at most
    ``lookback_days + 1`` records per table).
    """
    opts = {"ignoreNullFields": "false"}
    f = fresh.select("table_name", "error", F.to_json(F.struct(
        "hours_since_update", "row_count", "is_stale", "error"), opts).alias("freshness_json"))
    records = (trend.groupBy("table_name")
               .agg(F.sort_array(F.collect_list(F.struct(
                   F.col("process_date").cast("string").alias("process_date"),
                   "daily_count", "previous_count"))).alias("days"))
               .select("table_name", F.to_json("days", opts).alias("volume_json")))
    nothing = F.when(F.col("error").isNull(), F.lit("[]")).otherwise(F.to_json(F.struct("error")))
    return f.join(records, "table_name", "left").select(
        "table_name", "freshness_json", F.coalesce("volume_json", nothing).alias("volume_json"))


# Schemas of the two JSON texts of :func:`monitoring_json`.
FRESHNESS_JSON = "hours_since_update long, row_count long, is_stale boolean, error string, _corrupt_record string"
VOLUME_JSON = "array<struct<process_date: date, daily_count: long, previous_count: long, error: string>>"


def decode_json(texts: DataFrame) -> DataFrame:
    """The rows behind the JSON texts of :func:`monitoring_json`: one row per
    table and day of its window, or one row for a table without days.

    ``freshness_error`` and ``volume_error`` carry the error objects.  A text
    that is no JSON, or not of the schema, gives ``corrupt`` and no figures;
    the other tables are decoded all the same.
    """
    f = F.from_json("freshness_json", FRESHNESS_JSON, {"mode": "PERMISSIVE"})
    # A single object where a list is due is read as a list of one.
    v = F.from_json("volume_json", VOLUME_JSON, {"mode": "PERMISSIVE"})
    parsed = texts.select("table_name", "volume_json", f.alias("f"), v.alias("v"))
    bad = F.col("f._corrupt_record").isNotNull() | (F.col("volume_json").isNotNull() & F.col("v").isNull())
    return (parsed.withColumn("corrupt", F.coalesce(bad, F.lit(False)))
            .select("table_name", "corrupt", "f", F.explode_outer("v").alias("d"))
            .select("table_name", "corrupt", "f.hours_since_update", "f.row_count", "f.is_stale",
                    F.col("f.error").alias("freshness_error"), "d.process_date", "d.daily_count",
                    "d.previous_count", F.col("d.error").alias("volume_error")))


def null_audit(contracts_silver: DataFrame,
               columns=("contract_id", "contract_name", "start_date", "end_date",
                        "contract_value", "contract_status")) -> DataFrame:
    """Total NULLs over the critical contract columns, always one row."""
    total = sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0))
    return (contracts_silver.agg(total.cast("long").alias("total_nulls"))
            .select("total_nulls", (F.col("total_nulls") == 0).alias("passed")))
