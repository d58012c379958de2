"""Oracle SQL (DuckDB dialect) for every registered query.

The oracle sees only the raw test tables, so each statement starts with the
adapter rules of :mod:`tierwise.sources.testdata` written as CTEs, then the
silver CTEs, then the models by their meaning: facts per contract, literal
fan-outs for the per-client totals, a month spine.  It is independent of
the Spark code path, which uses rewritten (skew-free) plans and rollups.
"""

from __future__ import annotations

RUN_TS = "2024-01-29 12:00:00"
SPINE_AS_OF = "2001-08-31"
MONITOR_AS_OF = "2024-01-31 00:00:00"

_BRONZE = r"""
bronze_contracts AS (
  SELECT
    CASE WHEN o_custkey % 89 = 0 THEN 'X' || CAST(o_orderkey AS VARCHAR)
         ELSE CAST(o_orderkey AS VARCHAR) END AS contract_id,
    'Order-' || CAST(o_orderkey AS VARCHAR) AS contract_name,
    CASE WHEN o_custkey % 97 = 0 THEN @no_client
         ELSE printf('Customer#%09d', o_custkey) END AS client_name,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS start_date,
    CAST(o_orderdate AS DATE) + 30 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS end_date,
    CASE WHEN o_orderkey % 103 = 0 THEN NULL
         WHEN o_orderkey % 50 = 0 THEN CAST(0 AS DECIMAL(38,9))
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,9)) END AS contract_value,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'cancelled'
         WHEN o_orderstatus = 'O' THEN 'active'
         WHEN o_orderstatus = 'F' THEN 'completed'
         WHEN o_orderstatus = 'P' THEN 'pending' END AS contract_status
  FROM orders
),
_li AS (
  SELECT *, CAST(l_shipdate AS DATE) AS sd,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem
),
bronze_budgets AS (
  SELECT
    CASE WHEN l_orderkey % 211 = 0 AND l_linenumber = 1 THEN @no_budget
         ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS id,
    CAST(l_orderkey AS VARCHAR) AS contractId,
    'Budget-' || CAST(l_linenumber AS VARCHAR) AS name,
    printf('BUD%03d', l_linenumber) AS code,
    CASE WHEN l_returnflag = 'R' THEN 'variation'
         WHEN l_returnflag = 'A' THEN 'provisional'
         ELSE 'budgetAndCost' END AS scope,
    CASE WHEN l_orderkey % 13 = 0 THEN strftime(sd - 14, '%Y')
         WHEN l_orderkey % 29 = 0 THEN strftime(sd - 14, '%Y-%m-%d') || ' or so'
         WHEN l_orderkey % 17 = 0 THEN ' ' || strftime(sd - 14, '%Y-%m-%d') || ' '
         ELSE strftime(sd - 14, '%Y-%m-%d') END AS plannedStartDate,
    strftime(sd + 30, '%Y-%m-%d') AS plannedEndDate,
    strftime(sd + (l_linenumber - 3), '%Y-%m-%d') AS actualStartDate,
    CASE WHEN l_linestatus = 'O' THEN NULL
         ELSE strftime(sd + CAST(l_quantity AS INTEGER), '%Y-%m-%d') END AS actualEndDate,
    CASE WHEN l_orderkey % 19 = 0 THEN 'N/A' ELSE CAST(price AS VARCHAR) END AS originalAmount,
    CAST(CAST(ROUND(price * (1 - CAST(l_discount AS DECIMAL(4,2)))
                          * (1 + CAST(l_tax AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS VARCHAR) AS actualCost,
    CASE WHEN l_orderkey % 23 = 0 THEN 'unknown'
         ELSE ' ' || strftime(sd - 30, '%Y-%m-%d') || ' 08:30:00 ' END AS createdAt,
    strftime(sd + 1, '%Y-%m-%d') || CASE l_orderkey % 31
         WHEN 0 THEN 'T17:45:00+05:00' WHEN 1 THEN 'T17:45+05:00' WHEN 2 THEN ' 17:45+05' WHEN 3 THEN ' 17:45:00-8'
         WHEN 4 THEN 'T17:45:00Z' WHEN 5 THEN ' 17:45:00 Europe/Paris' WHEN 6 THEN ' 17:45:00 America/New_York'
         WHEN 7 THEN ' 17:45:00 or so' WHEN 8 THEN 'Tsoon' WHEN 9 THEN 'T17:45:00.250'
         ELSE 'T17:45:00' END AS updatedAt
  FROM _li
),
_ev AS (
  SELECT *, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount
  FROM events
),
bronze_co AS (
  SELECT
    CASE WHEN event_id % 199 = 0 THEN @no_order ELSE printf('CO%08d', event_id) END AS id,
    printf('%08d', event_id) AS "number",
    'Change Order ' || CAST(event_id AS VARCHAR) AS name,
    CASE WHEN event_id % 2 = 0 THEN 'in' ELSE 'out' END AS scope,
    event_type AS "type",
    CAST(user_id AS VARCHAR) AS contractId,
    amount AS estimated,
    CASE WHEN event_id % 7 = 0 THEN ' ' || amount || ' ' ELSE amount END AS proposed,
    CASE WHEN event_id % 11 = 0 THEN '$' || amount ELSE amount END AS submitted,
    CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE amount END AS approved,
    CASE WHEN event_type = 'purchase' AND event_id % 41 = 0 THEN '12345678901234567890.123456789'
         WHEN event_type = 'purchase' THEN amount END AS "committed",
    strftime(CAST(ts AS DATE) - CAST(8200 + event_id % 2200 AS INTEGER), '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M:%S')
      || CASE WHEN event_id % 37 = 0 THEN '+09:30' ELSE '' END AS createdAt,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS updatedAt,
    CASE WHEN event_id % 9 = 0 THEN 'pending'
         ELSE ' ' || strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS statusChangedAt
  FROM _ev
)"""

DATE_RE = (r"'^\s*\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?"
           r"\s*(Z|UTC|[+-]\d{1,2}(:?\d{1,2})?)?)?\s*$'")
_ZONE_RE = r"'\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{1,2}(:?\d{1,2})?|[A-Za-z]+(/[A-Za-z_]+)*)$'"


def safe_date(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {DATE_RE}) THEN TRY_CAST(regexp_extract({c}, '\\d+-\\d+-\\d+') AS DATE) END"


def _safe_ts(c: str) -> str:
    """A zone in the text counts; the result is the UTC wall clock."""
    t = f"TRIM({c})"
    zoned = f"regexp_replace({t}, '([+-])(\\d)$', '\\g<1>0\\2')".replace("\\g<1>", "\\1")
    return (f"CASE WHEN regexp_matches({t}, {_ZONE_RE}) THEN timezone('UTC', TRY_CAST({zoned} AS TIMESTAMPTZ)) "
            f"WHEN regexp_matches({t}, {DATE_RE}) THEN TRY_CAST({t} AS TIMESTAMP) END")


def _safe_money(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(38,9))"


_SILVER = f"""
contracts_silver AS (
  SELECT contract_id, contract_name, client_name,
         CAST(start_date AS DATE) AS start_date,
         CAST(end_date AS DATE) AS end_date,
         CAST(contract_value AS DECIMAL(38,9)) AS contract_value,
         contract_status,
         TIMESTAMP '{RUN_TS}' AS processed_at
  FROM bronze_contracts
),
budgets_silver AS (
  SELECT id AS budget_id, name AS budget_name, contractId AS contract_id,
         code AS budget_code, scope AS budget_scope,
         {safe_date('plannedStartDate')} AS planned_start_date,
         {safe_date('plannedEndDate')} AS planned_end_date,
         {safe_date('actualStartDate')} AS actual_start_date,
         {safe_date('actualEndDate')} AS actual_end_date,
         {_safe_money('originalAmount')} AS original_amount,
         {_safe_money('actualCost')} AS actual_cost,
         {_safe_ts('createdAt')} AS created_at,
         {_safe_ts('updatedAt')} AS updated_at,
         TIMESTAMP '{RUN_TS}' AS processed_at
  FROM bronze_budgets
),
change_orders_silver AS (
  SELECT id AS change_order_id, "number" AS change_order_number,
         name AS change_order_name, scope AS change_order_scope,
         "type" AS change_order_type, contractId AS contract_id,
         {_safe_money('estimated')} AS estimated_amount,
         {_safe_money('proposed')} AS proposed_amount,
         {_safe_money('submitted')} AS submitted_amount,
         {_safe_money('approved')} AS approved_amount,
         {_safe_money('"committed"')} AS committed_amount,
         {_safe_ts('createdAt')} AS created_at,
         {_safe_ts('updatedAt')} AS updated_at,
         {_safe_ts('statusChangedAt')} AS status_changed_at,
         TIMESTAMP '{RUN_TS}' AS processed_at
  FROM bronze_co
)"""


def _avg(total: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CAST({total} AS DOUBLE) / {n} END"


def _msum(col: str) -> str:
    """A money SUM, typed decimal(38,9) as in the library."""
    return f"CAST(SUM({col}) AS DECIMAL(38,9))"


def _pct(num: str, den: str) -> str:
    return f"CASE WHEN {den} = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * 100 END"


_MODELS = f"""
contract_analytics AS (
  SELECT client_name,
         COUNT(contract_id) AS total_contracts,
         {_msum('contract_value')} AS total_contract_value,
         {_avg('SUM(contract_value)', 'COUNT(contract_value)')} AS avg_contract_value,
         MIN(contract_value) AS min_contract_value,
         MAX(contract_value) AS max_contract_value,
         AVG(date_diff('day', start_date, end_date)) AS avg_contract_duration_days,
         TIMESTAMP '{RUN_TS}' AS processed_at
  FROM contracts_silver GROUP BY client_name
),
budget_summary AS (
  SELECT contract_id, n AS budget_count, planned AS total_original_budget, spent AS total_actual_cost,
         spent - planned AS budget_variance
  FROM (SELECT contract_id, COUNT(*) AS n, {_msum('original_amount')} AS planned, {_msum('actual_cost')} AS spent
        FROM budgets_silver GROUP BY ALL)
),
change_order_summary AS (
  SELECT contract_id, COUNT(*) FILTER (step = 'estimated') AS change_order_count,
         {_msum("amount) FILTER (step = 'estimated'")} AS total_estimated_amount,
         {_msum("amount) FILTER (step = 'approved'")} AS total_approved_amount,
         {_msum("amount) FILTER (step = 'committed'")} AS total_committed_amount
  FROM (SELECT contract_id, unnest(['estimated', 'approved', 'committed']) AS step,
               unnest([estimated_amount, approved_amount, committed_amount]) AS amount
        FROM change_orders_silver)
  GROUP BY contract_id
),
_contract_facts AS (
  SELECT contract_id, SUM(nb)::BIGINT AS nb, {_msum('planned')} AS planned, {_msum('spent')} AS spent,
         SUM(no)::BIGINT AS no, {_msum('est')} AS est, {_msum('appr')} AS appr, {_msum('comm')} AS comm
  FROM (SELECT contract_id, 1 AS nb, original_amount AS planned, actual_cost AS spent,
               0 AS no, NULL AS est, NULL AS appr, NULL AS comm FROM budgets_silver
        UNION ALL
        SELECT contract_id, 0, NULL, NULL, 1, estimated_amount, approved_amount, committed_amount
        FROM change_orders_silver)
  WHERE contract_id IS NOT NULL GROUP BY contract_id
),
project_analytics AS (
  SELECT contract_id, contract_name, client_name, start_date, end_date, contract_value, contract_status,
         ifnull(nb, 0) AS budget_count,
         ifnull(planned, 0)::DECIMAL(38,9) AS total_original_budget,
         ifnull(spent, 0)::DECIMAL(38,9) AS total_actual_cost,
         ifnull(spent - planned, 0)::DECIMAL(38,9) AS budget_variance,
         ifnull(no, 0) AS change_order_count,
         ifnull(est, 0)::DECIMAL(38,9) AS total_estimated_co_amount,
         ifnull(appr, 0)::DECIMAL(38,9) AS total_approved_co_amount,
         ifnull(comm, 0)::DECIMAL(38,9) AS total_committed_co_amount,
         (contract_value + ifnull(appr, 0))::DECIMAL(38,9) AS adjusted_contract_value,
         {_pct('ifnull(appr, 0)', 'contract_value')} AS change_order_percentage,
         {_pct('ifnull(spent, 0)', 'ifnull(planned, 0)')} AS budget_utilization_percentage,
         TIMESTAMP '{RUN_TS}' AS processed_at
  FROM contracts_silver LEFT JOIN _contract_facts USING (contract_id)
),
_allocation AS (
  SELECT client_name, contract_id, contract_value, start_date, end_date, original_amount
  FROM contracts_silver LEFT JOIN budgets_silver USING (contract_id)
),
contract_summary AS (
  SELECT client_name, ids AS total_contracts, worth AS total_contract_value,
         {_avg('worth', 'valued')} AS avg_contract_value,
         first_start AS earliest_contract_date, last_end AS latest_contract_end_date,
         planned AS total_budget_allocated, (worth - planned)::DECIMAL(38,9) AS budget_variance,
         TIMESTAMP '{RUN_TS}' AS generated_at
  FROM (SELECT client_name, COUNT(DISTINCT contract_id) AS ids, {_msum('contract_value')} AS worth,
               COUNT(contract_value) AS valued, MIN(start_date) AS first_start, MAX(end_date) AS last_end,
               {_msum('original_amount')} AS planned
        FROM _allocation GROUP BY ALL)
),
client_contracts AS (
  SELECT client_name, n AS total_contracts, worth AS total_contract_value,
         {_avg('worth', 'valued')} AS avg_contract_value,
         least_worth AS min_contract_value, most_worth AS max_contract_value, days AS avg_contract_duration_days,
         coalesce(states['active'], 0) AS active_contracts, coalesce(states['completed'], 0) AS completed_contracts,
         coalesce(states['pending'], 0) AS pending_contracts, coalesce(states['cancelled'], 0) AS cancelled_contracts
  FROM (SELECT client_name, COUNT(*) AS n, {_msum('contract_value')} AS worth, COUNT(contract_value) AS valued,
               MIN(contract_value) AS least_worth, MAX(contract_value) AS most_worth,
               AVG(end_date - start_date) AS days,
               map_from_entries(list_transform(list_distinct(list(contract_status)),
                 lambda s: struct_pack(k := s, v := len(list_filter(list(contract_status), lambda x: x = s))))) AS states
        FROM contracts_silver GROUP BY ALL)
),
_budget_use AS (
  SELECT client_name, budget_id, original_amount, actual_cost
  FROM contracts_silver LEFT JOIN budgets_silver USING (contract_id)
),
client_budgets AS (
  SELECT client_name, n AS total_budgets, planned AS total_budget_amount, spent AS total_actual_cost,
         (spent - planned)::DECIMAL(38,9) AS total_budget_variance, {_pct('spent', 'planned')} AS budget_utilization_percentage
  FROM (SELECT client_name, COUNT(DISTINCT budget_id) AS n, {_msum('original_amount')} AS planned,
               {_msum('actual_cost')} AS spent
        FROM _budget_use GROUP BY ALL)
),
_order_use AS (
  SELECT client_name, contract_value, change_order_id, approved_amount
  FROM contracts_silver LEFT JOIN change_orders_silver USING (contract_id)
),
client_change_orders AS (
  SELECT client_name, n AS total_change_orders, approved AS total_change_order_amount,
         {_pct('approved', 'base')} AS change_order_percentage
  FROM (SELECT client_name, COUNT(DISTINCT change_order_id) AS n, {_msum('approved_amount')} AS approved,
               SUM(contract_value) AS base
        FROM _order_use GROUP BY ALL)
),
client_analytics AS (
  SELECT *, (total_contract_value + COALESCE(total_change_order_amount, 0))::DECIMAL(38,9) AS adjusted_contract_value,
         total_budgets / total_contracts AS avg_budgets_per_contract,
         total_change_orders / total_contracts AS avg_change_orders_per_contract,
         TIMESTAMP '{RUN_TS}' AS processed_at
  FROM client_contracts LEFT JOIN client_budgets USING (client_name)
       LEFT JOIN client_change_orders USING (client_name)
),
monthly_contracts AS (
  SELECT date_part('year', m) AS start_year, date_part('month', m) AS start_month, n AS new_contracts,
         worth AS new_contract_value, days AS avg_contract_duration
  FROM (SELECT date_trunc('month', start_date) AS m, COUNT(*) AS n, {_msum('contract_value')} AS worth,
               AVG(end_date - start_date) AS days
        FROM contracts_silver GROUP BY ALL)
),
monthly_budgets AS (
  SELECT date_part('year', m) AS planned_start_year, date_part('month', m) AS planned_start_month, n AS new_budgets,
         planned AS new_budget_amount, days AS avg_planned_duration, delay AS avg_start_delay
  FROM (SELECT date_trunc('month', planned_start_date) AS m, COUNT(*) AS n, {_msum('original_amount')} AS planned,
               AVG(planned_end_date - planned_start_date) AS days, AVG(actual_start_date - planned_start_date) AS delay
        FROM budgets_silver GROUP BY ALL)
),
monthly_change_orders AS (
  SELECT date_part('year', m) AS created_year, date_part('month', m) AS created_month, n AS new_change_orders,
         approved AS new_change_order_amount, {_avg('approved', 'n_approved')} AS avg_change_order_amount
  FROM (SELECT date_trunc('month', created_at) AS m, COUNT(*) AS n, {_msum('approved_amount')} AS approved,
               COUNT(approved_amount) AS n_approved
        FROM change_orders_silver GROUP BY ALL)
),
date_spine AS (
  SELECT year(first_day) AS year, month(first_day) AS month
  FROM (SELECT unnest(generate_series(date_trunc('year', DATE '{SPINE_AS_OF}' - INTERVAL 3 YEAR),
                                      date_trunc('month', DATE '{SPINE_AS_OF}'),
                                      INTERVAL 1 MONTH)) AS first_day)
),
_months AS (
  SELECT year, month,
         COLUMNS('^(new|avg)_')
  FROM date_spine
       LEFT JOIN monthly_contracts ON (start_year, start_month) = (year, month)
       LEFT JOIN monthly_budgets ON (planned_start_year, planned_start_month) = (year, month)
       LEFT JOIN monthly_change_orders ON (created_year, created_month) = (year, month)
),
time_analytics AS (
  SELECT year, month, COALESCE(COLUMNS('^((new|avg)_.*)$'), 0) AS '\\1',
         COALESCE(COALESCE(new_budgets, 0) / nullif(new_contracts, 0), 0.0) AS budgets_per_contract,
         COALESCE(COALESCE(new_change_orders, 0) / nullif(new_contracts, 0), 0.0) AS change_orders_per_contract,
         COALESCE(CAST(COALESCE(new_change_order_amount, 0) AS DOUBLE)
                  / CAST(nullif(new_contract_value, 0) AS DOUBLE) * 100, 0.0) AS change_order_percentage,
         TIMESTAMP '{RUN_TS}' AS processed_at
  FROM _months
)"""

MODEL_CTES = _MODELS.strip()

# What stands for a missing key: NULL as delivered, or a text in a corrected
# delivery (``clean``).
_AS_DELIVERED = {"@no_client": "NULL", "@no_budget": "NULL", "@no_order": "NULL"}
_CORRECTED = {"@no_client": "'(none)'",
              "@no_budget": "'none-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)",
              "@no_order": "'none-' || CAST(event_id AS VARCHAR)"}


def prelude(clean: bool = False) -> str:
    bronze = _BRONZE.strip()
    for mark, text in (_CORRECTED if clean else _AS_DELIVERED).items():
        bronze = bronze.replace(mark, text)
    return "WITH " + bronze + ",\n" + _SILVER.strip() + ",\n" + MODEL_CTES


PRELUDE = prelude()


def with_prelude(body: str, extra_ctes: str = "", clean: bool = False) -> str:
    """Full statement: adapters + silver + models (+ extra CTEs) then body."""
    head = prelude(clean)
    if extra_ctes.strip():
        head += ",\n" + extra_ctes.strip()
    return head + "\n" + body.strip()


def select_all(cte: str) -> str:
    return with_prelude(f"SELECT * FROM {cte}")
