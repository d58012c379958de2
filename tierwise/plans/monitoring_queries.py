"""Registered monitoring queries and their oracle SQL.

Monitored are stored tables: the bronze contracts and budgets (they carry no
stamp, so each is an error row, as is the gold contract_summary, which has
``generated_at``), the change-order loads stamped with their load time
(``events.ts``, 30 days of stamps), the three silver tables and four gold ones
(stamped with the run time).  Freshness and trend read the profiles kept with
the tables.
"""

from __future__ import annotations

from tierwise.operators import monitoring
from tierwise.plans import oracle
from tierwise.plans.catalog import Layers, register
from tierwise.plans.oracle import MONITOR_AS_OF
from tierwise.sources.testdata import change_order_load_stamps

# Parameters of the registered queries (the reference thresholds are the
# library defaults: 24 h, 7 days, 20 %).  Loads are ~340 rows a day, so a
# 5 % threshold is what separates ordinary days from anomalies here.
VOLUME_THRESHOLD_PCT = 5.0


_UNSTAMPED = [("bronze.contracts", "bronze_contracts"), ("bronze.budgets", "bronze_budgets"),
              ("gold.contract_summary", "contract_summary")]
_STAMPED = [("silver.contracts_silver", "contracts_silver"),
            ("silver.budgets_silver", "budgets_silver"),
            ("silver.change_orders_silver", "change_orders_silver"),
            ("bronze.change_order_loads", "_co_loads"),
            ("gold.contract_analytics", "contract_analytics"),
            ("gold.project_analytics", "project_analytics"),
            ("gold.client_analytics", "client_analytics"),
            ("gold.time_analytics", "time_analytics")]


_LOADED = {"_co_loads": "change_order_loads"}


def _profile(spark, sf_dir):
    """The kept profiles of the monitored tables."""
    root, tables = Layers(spark, sf_dir).profiles({n: _LOADED.get(t, t) for n, t in [*_STAMPED, *_UNSTAMPED]})
    return monitoring.kept_profile(spark, root, tables, as_of=MONITOR_AS_OF)


_LOADS = "_co_loads AS (SELECT printf('CO%08d', event_id) AS change_order_id, ts AS processed_at FROM events)"

_FRESH = "\nUNION ALL\n".join(
    [f"SELECT '{n}' AS table_name, date_sub('hour', MAX(processed_at), TIMESTAMP '{MONITOR_AS_OF}') AS hours_since_update, "
     f"COUNT(*) AS row_count, COALESCE(date_sub('hour', MAX(processed_at), TIMESTAMP '{MONITOR_AS_OF}') > 24, FALSE) AS is_stale, "
     f"CAST(NULL AS VARCHAR) AS error FROM {t}" for n, t in _STAMPED]
    + [f"SELECT '{n}' AS table_name, CAST(NULL AS BIGINT) AS hours_since_update, "
       "CAST(NULL AS BIGINT) AS row_count, FALSE AS is_stale, 'column processed_at not found' AS error"
       for n, _ in _UNSTAMPED])

_TREND_DAYS = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST(processed_at AS DATE) AS process_date, COUNT(*) AS daily_count "
    f"FROM {t} WHERE processed_at > TIMESTAMP '{MONITOR_AS_OF}' - INTERVAL 7 DAY GROUP BY 2"
    for n, t in _STAMPED)

_TREND = f"""
SELECT table_name, process_date, daily_count, previous_count,
       CAST(daily_count - previous_count AS DOUBLE) / CAST(previous_count AS DOUBLE) * 100.0 AS day_over_day_change_pct
FROM (SELECT *, lag(daily_count, 1) OVER (PARTITION BY table_name ORDER BY process_date) AS previous_count
      FROM _days)"""

_CTES = f"{_LOADS},\n_fresh AS ({_FRESH}),\n_days AS ({_TREND_DAYS}),\n_trend AS ({_TREND})"


def _sql(body: str) -> str:
    return oracle.with_prelude(body, _CTES)


@register("freshness", _sql("SELECT * FROM _fresh"))
def q_freshness(spark, sf_dir):
    return monitoring.freshness(_profile(spark, sf_dir), as_of=MONITOR_AS_OF)


@register("freshness_alerts", _sql("SELECT * FROM _fresh WHERE is_stale"))
def q_freshness_alerts(spark, sf_dir):
    return monitoring.freshness_alerts(monitoring.freshness(_profile(spark, sf_dir), as_of=MONITOR_AS_OF))


@register("volume_trend", _sql("SELECT * FROM _trend"))
def q_volume_trend(spark, sf_dir):
    return monitoring.volume_trend(_profile(spark, sf_dir))


@register("volume_alerts", _sql(f"SELECT * FROM _trend WHERE abs(day_over_day_change_pct) > {VOLUME_THRESHOLD_PCT}"))
def q_volume_alerts(spark, sf_dir):
    return monitoring.volume_alerts(monitoring.volume_trend(_profile(spark, sf_dir)),
                                    VOLUME_THRESHOLD_PCT)


@register("monitoring_report", _sql(f"""
SELECT 'stale_data' AS type, table_name AS "table", hours_since_update,
       CAST(NULL AS DATE) AS date, CAST(NULL AS DOUBLE) AS change_pct,
       printf('Data in %s is stale! Last update was %d hours ago.', table_name, hours_since_update) AS message,
       strftime(TIMESTAMP '{MONITOR_AS_OF}', '%Y-%m-%dT%H:%M:%SZ') AS reported_at
FROM _fresh WHERE is_stale
UNION ALL
SELECT 'volume_anomaly', table_name, CAST(NULL AS BIGINT), process_date, day_over_day_change_pct,
       printf('Significant volume change in %s on %s: %.2f%% change', table_name,
              strftime(process_date, '%Y-%m-%d'), day_over_day_change_pct),
       strftime(TIMESTAMP '{MONITOR_AS_OF}', '%Y-%m-%dT%H:%M:%SZ')
FROM _trend WHERE abs(day_over_day_change_pct) > {VOLUME_THRESHOLD_PCT}"""))
def q_monitoring_report(spark, sf_dir):
    t = _profile(spark, sf_dir)
    return monitoring.monitoring_report(monitoring.freshness(t, as_of=MONITOR_AS_OF),
                                        monitoring.volume_trend(t),
                                        VOLUME_THRESHOLD_PCT, as_of=MONITOR_AS_OF)


@register("monitoring_json", _sql("""
SELECT f.table_name,
       CAST(to_json(struct_pack(hours_since_update := f.hours_since_update, row_count := f.row_count,
                                is_stale := f.is_stale, error := f.error)) AS VARCHAR) AS freshness_json,
       COALESCE(v.volume_json, CASE WHEN f.error IS NULL THEN '[]'
            ELSE CAST(to_json(struct_pack(error := f.error)) AS VARCHAR) END) AS volume_json
FROM _fresh f LEFT JOIN (
  SELECT table_name,
         CAST(to_json(list(struct_pack(process_date := strftime(process_date, '%Y-%m-%d'),
                                       daily_count := daily_count,
                                       previous_count := previous_count)
                           ORDER BY process_date)) AS VARCHAR) AS volume_json
  FROM _trend GROUP BY table_name) v ON f.table_name = v.table_name"""))
def q_monitoring_json(spark, sf_dir):
    t = _profile(spark, sf_dir)
    return monitoring.monitoring_json(monitoring.freshness(t, as_of=MONITOR_AS_OF),
                                      monitoring.volume_trend(t))


# The hand-over texts read back into rows; the oracle never makes a text.
@register("monitoring_json_rows", _sql("""
SELECT f.table_name, FALSE AS corrupt, f.hours_since_update, f.row_count, f.is_stale,
       f.error AS freshness_error, t.process_date, t.daily_count, t.previous_count, f.error AS volume_error
FROM _fresh f LEFT JOIN _trend t ON t.table_name = f.table_name"""))
def q_monitoring_json_rows(spark, sf_dir):
    return monitoring.decode_json(q_monitoring_json(spark, sf_dir))


@register("null_audit", oracle.with_prelude("""
SELECT CAST(COUNT(*) FILTER (WHERE contract_id IS NULL) + COUNT(*) FILTER (WHERE contract_name IS NULL)
          + COUNT(*) FILTER (WHERE start_date IS NULL) + COUNT(*) FILTER (WHERE end_date IS NULL)
          + COUNT(*) FILTER (WHERE contract_value IS NULL) + COUNT(*) FILTER (WHERE contract_status IS NULL)
          AS BIGINT) AS total_nulls,
       (COUNT(*) FILTER (WHERE contract_id IS NULL) + COUNT(*) FILTER (WHERE contract_name IS NULL)
          + COUNT(*) FILTER (WHERE start_date IS NULL) + COUNT(*) FILTER (WHERE end_date IS NULL)
          + COUNT(*) FILTER (WHERE contract_value IS NULL) + COUNT(*) FILTER (WHERE contract_status IS NULL)) = 0 AS passed
FROM contracts_silver"""))
def q_null_audit(spark, sf_dir):
    return monitoring.null_audit(Layers(spark, sf_dir).contracts())


@register("monitoring_alert_count", _sql(f"""
SELECT (SELECT COUNT(*) FROM _fresh WHERE is_stale)
     + (SELECT COUNT(*) FROM _trend WHERE abs(day_over_day_change_pct) > {VOLUME_THRESHOLD_PCT}) AS total_alerts"""))
def q_monitoring_alert_count(spark, sf_dir):
    t = _profile(spark, sf_dir)
    report = monitoring.monitoring_report(monitoring.freshness(t, as_of=MONITOR_AS_OF),
                                          monitoring.volume_trend(t),
                                          VOLUME_THRESHOLD_PCT)
    return monitoring.alert_count(report)
