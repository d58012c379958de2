"""Property test: the skew-free fan-out rewrite equals the literal fan-out join.

Random small frames with colliding ids, NULL keys, NULL amounts, orphan
details and hot contracts; each example is checked against DuckDB running
the reference-shaped SQL (aggregate after LEFT JOIN).
"""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierwise.operators import gold
from tierwise.plans import oracle
from tools.compare_oracle import canon

KEYS = st.one_of(st.none(), st.sampled_from(["k1", "k2", "k3", "k4", "orphan"]))
CLIENTS = st.one_of(st.none(), st.sampled_from(["A", "B", "C"]))
AMOUNTS = st.one_of(st.none(), st.integers(min_value=0, max_value=5000).map(lambda c: f"{c / 100:.2f}"))
IDS = st.one_of(st.none(), st.sampled_from([f"d{i}" for i in range(6)]))

contracts_st = st.lists(st.tuples(KEYS, CLIENTS, AMOUNTS), min_size=1, max_size=8)
details_st = st.lists(st.tuples(KEYS, IDS, AMOUNTS, AMOUNTS), min_size=0, max_size=25)

C_COLS = "contract_id string, client_name string, contract_value string"
D_COLS = "contract_id string, detail_id string, a string, b string"


def _spark_frames(spark, contracts, details):
    c = spark.createDataFrame(contracts, C_COLS).selectExpr(
        "contract_id", "client_name", "cast(contract_value as decimal(27,9)) as contract_value",
        "'x' as contract_name", "date'2001-01-01' as start_date", "date'2001-02-01' as end_date",
        "'active' as contract_status")
    d = spark.createDataFrame(details, D_COLS)
    b = d.selectExpr("contract_id", "detail_id as budget_id",
                     "cast(a as decimal(27,9)) as original_amount", "cast(b as decimal(27,9)) as actual_cost")
    co = d.selectExpr("contract_id", "detail_id as change_order_id",
                      "cast(a as decimal(27,9)) as approved_amount")
    return c, b, co


def _duck(contracts, details, model):
    con = duckdb.connect()
    con.execute("CREATE TABLE c (contract_id VARCHAR, client_name VARCHAR, contract_value VARCHAR)")
    con.execute("CREATE TABLE d (contract_id VARCHAR, detail_id VARCHAR, a VARCHAR, b VARCHAR)")
    if contracts:
        con.executemany("INSERT INTO c VALUES (?, ?, ?)", contracts)
    if details:
        con.executemany("INSERT INTO d VALUES (?, ?, ?, ?)", details)
    con.execute("""CREATE VIEW contracts_silver AS SELECT contract_id, client_name,
                   CAST(contract_value AS DECIMAL(27,9)) AS contract_value, 'x' AS contract_name,
                   DATE '2001-01-01' AS start_date, DATE '2001-02-01' AS end_date,
                   'active' AS contract_status FROM c""")
    con.execute("""CREATE VIEW budgets_silver AS SELECT contract_id, detail_id AS budget_id,
                   CAST(a AS DECIMAL(27,9)) AS original_amount, CAST(b AS DECIMAL(27,9)) AS actual_cost,
                   CAST(NULL AS DATE) AS planned_start_date, CAST(NULL AS DATE) AS planned_end_date,
                   CAST(NULL AS DATE) AS actual_start_date FROM d""")
    con.execute("""CREATE VIEW change_orders_silver AS SELECT contract_id, detail_id AS change_order_id,
                   CAST(a AS DECIMAL(27,9)) AS approved_amount, CAST(a AS DECIMAL(27,9)) AS estimated_amount,
                   CAST(NULL AS DECIMAL(27,9)) AS committed_amount,
                   CAST(NULL AS TIMESTAMP) AS created_at FROM d""")
    cur = con.execute("WITH " + oracle.MODEL_CTES + f"\nSELECT * FROM {model}")
    return [x[0] for x in cur.description], cur.fetchall()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(contracts=contracts_st, details=details_st)
def test_fanout_rewrites_match_literal_join(spark, contracts, details):
    c, b, co = _spark_frames(spark, contracts, details)
    for model, df in (("contract_summary", gold.contract_summary(c, b, oracle.RUN_TS)),
                      ("client_budgets", gold.client_budgets(c, b)),
                      ("client_change_orders", gold.client_change_orders(c, co)),
                      ("client_analytics", gold.client_analytics(c, b, co, oracle.RUN_TS))):
        cols, rows = _duck(contracts, details, model)
        got = canon(df.columns, [tuple(r) for r in df.collect()], 12)
        assert got == canon(cols, rows, 12), model
