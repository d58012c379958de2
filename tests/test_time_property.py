"""Property test: time_analytics equals the spine-driven SQL for random as-of dates.

Random dates around the spine edges (including NULLs, leap days and
January as-of dates) for contracts, budgets and change orders; the result
must equal DuckDB running the oracle's SQL.
"""

import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierwise.operators import gold
from tierwise.plans import oracle
from tools.compare_oracle import canon

DATES = st.one_of(st.none(), st.dates(min_value=dt.date(1996, 12, 1), max_value=dt.date(2003, 2, 1)))
AS_OF = st.one_of(st.sampled_from([dt.date(2000, 2, 29), dt.date(2001, 1, 1), dt.date(2002, 12, 31)]),
                  st.dates(min_value=dt.date(1999, 1, 1), max_value=dt.date(2002, 12, 31)))
AMT = st.one_of(st.none(), st.integers(min_value=0, max_value=9999))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(as_of=AS_OF,
       contracts=st.lists(st.tuples(DATES, st.integers(0, 400), AMT), min_size=1, max_size=12),
       budgets=st.lists(st.tuples(DATES, st.integers(0, 60), st.integers(-5, 20), AMT), max_size=12),
       cos=st.lists(st.tuples(DATES, AMT), max_size=12))
def test_time_analytics_matches_sql(spark, as_of, contracts, budgets, cos):
    crow = [(f"k{i}", s, (s + dt.timedelta(days=d)) if s else None, None if a is None else f"{a}.50")
            for i, (s, d, a) in enumerate(contracts)]
    brow = [(f"b{i}", s, (s + dt.timedelta(days=d)) if s else None,
             (s + dt.timedelta(days=delay)) if s else None, None if a is None else f"{a}.25")
            for i, (s, d, delay, a) in enumerate(budgets)]
    orow = [(f"c{i}", dt.datetime.combine(s, dt.time(13, 5)) if s else None, None if a is None else f"{a}.75")
            for i, (s, a) in enumerate(cos)]
    c = spark.createDataFrame(crow, "contract_id string, start_date date, end_date date, v string") \
        .selectExpr("*", "cast(v as decimal(27,9)) as contract_value")
    b = spark.createDataFrame(brow, "budget_id string, planned_start_date date, planned_end_date date, "
                                    "actual_start_date date, v string") \
        .selectExpr("*", "cast(v as decimal(27,9)) as original_amount")
    co = spark.createDataFrame(orow, "change_order_id string, created_at timestamp_ntz, v string") \
        .selectExpr("*", "cast(v as decimal(27,9)) as approved_amount")

    con = duckdb.connect()
    con.execute("CREATE TABLE contracts_silver (contract_id VARCHAR, start_date DATE, end_date DATE, v VARCHAR)")
    con.execute("CREATE TABLE b (budget_id VARCHAR, planned_start_date DATE, planned_end_date DATE, "
                "actual_start_date DATE, v VARCHAR)")
    con.execute("CREATE TABLE o (change_order_id VARCHAR, created_at TIMESTAMP, v VARCHAR)")
    for table, rows, n in (("contracts_silver", crow, 4), ("b", brow, 5), ("o", orow, 3)):
        if rows:
            con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * n)})", rows)
    con.execute("ALTER TABLE contracts_silver ADD COLUMN contract_value DECIMAL(27,9)")
    con.execute("UPDATE contracts_silver SET contract_value = CAST(v AS DECIMAL(27,9))")
    con.execute("CREATE VIEW budgets_silver AS SELECT *, CAST(v AS DECIMAL(27,9)) AS original_amount FROM b")
    con.execute("CREATE VIEW change_orders_silver AS SELECT *, CAST(v AS DECIMAL(27,9)) AS approved_amount FROM o")
    sql = ("WITH " + oracle.MODEL_CTES.replace(f"DATE '{oracle.SPINE_AS_OF}'", f"DATE '{as_of.isoformat()}'")
           + "\nSELECT * FROM time_analytics")
    cur = con.execute(sql)
    want = canon([d[0] for d in cur.description], cur.fetchall(), 12)
    df = gold.time_analytics(c, b, co, as_of=as_of.isoformat(), run_ts=oracle.RUN_TS)
    assert canon(df.columns, [tuple(r) for r in df.collect()], 12) == want
