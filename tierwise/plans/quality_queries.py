"""Registered data-quality queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierwise.functions.metrics import days_between
from tierwise.operators import quality
from tierwise.operators.quality import Rule
from tierwise.plans import oracle
from tierwise.plans.catalog import Layers, register
from tierwise.schemas import BRONZE_BUDGETS, BRONZE_CONTRACTS

# -------------------------------------------------------- oracle helpers

_DATE_RE = oracle.DATE_RE

# Types of a rule's columns, as DuckDB reports them.
_FAMILY = {"NUMERIC": r"^(DECIMAL|DOUBLE|FLOAT|BIGINT|INTEGER|HUGEINT)", "STRING": "^VARCHAR"}
_SPARK_TYPE = {"date": "DATE", "string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def _q(c: str) -> str:
    return '"' + c + '"'


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _rule_sql(table: str, r: Rule) -> str:
    """Violation count of one rule as a DuckDB aggregate or subquery."""
    k, t = r.kwargs, r.rule
    # Names and types come from DuckDB's own description of the table.
    described = f"(DESCRIBE {oracle.select_all(table)})"
    if t == "expect_table_columns_to_match_ordered_list":
        return f"(SELECT (list(column_name) <> {list(k['column_list'])!r})::INT FROM {described})"
    if t == "expect_table_columns_to_match_set":
        want, have = f"list_sort({list(k['column_set'])!r})", "list_sort(list(column_name))"
        ok = f"{want} = {have}" if k.get("exact_match", True) else f"list_has_all({have}, {want})"
        return f"(SELECT (NOT {ok})::INT FROM {described})"
    if t == "expect_column_values_to_be_of_spark_type":
        want = _SPARK_TYPE.get(k["type_"], k["type_"].upper())
        return f"(SELECT count(*) FILTER (column_name = '{k['column']}' AND column_type = '{want}') = 0 FROM {described})"
    c = _q(k["column"]) if "column" in k else None
    if t == "expect_column_values_to_not_be_null":
        return f"COUNT(*) FILTER (WHERE {c} IS NULL)"
    if t == "expect_column_values_to_be_in_set":
        vs = ", ".join(_lit(v) for v in k["value_set"])
        return f"COUNT(*) FILTER (WHERE NOT COALESCE({c} IN ({vs}), FALSE))"
    if t == "expect_column_values_to_be_between":
        conds = []
        if k.get("min_value") is not None:
            conds.append(f"{c} {'<=' if k.get('strict_min') else '<'} {k['min_value']}")
        if k.get("max_value") is not None:
            conds.append(f"{c} {'>=' if k.get('strict_max') else '>'} {k['max_value']}")
        return f"COUNT(*) FILTER (WHERE COALESCE({' OR '.join(conds)}, FALSE))"
    if t == "expect_column_values_to_be_unique":
        return (f"COUNT(*) - COUNT(DISTINCT {c}) - "
                f"MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)")
    if t == "expect_column_pair_values_A_to_be_greater_than_B":
        op = "<" if k.get("or_equal") else "<="
        return f"COUNT(*) FILTER (WHERE COALESCE({_q(k['column_A'])} {op} {_q(k['column_B'])}, FALSE))"
    if t == "expect_column_values_to_be_of_type":
        fam, named = k["type_"], f"column_name = '{k['column']}'"
        if fam in _FAMILY:
            return f"(SELECT count(*) FILTER ({named} AND regexp_matches(column_type, '{_FAMILY[fam]}')) = 0 FROM {described})"
        if fam != "DATE":   # no such family
            return f"(SELECT count(*) FILTER ({named}) FROM {described})"
        # Text is parsed; dates, times and numbers pass as they are.
        text = f"CAST({c} AS VARCHAR)"
        return (f"CASE WHEN (SELECT bool_or({named} AND column_type = 'VARCHAR') FROM {described}) THEN "
                f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {oracle.safe_date(text)} IS NULL) ELSE 0 END")
    raise ValueError(t)


def _suite_sql(suite: str, table: str, rules: list[Rule]) -> str:
    parts = []
    for r in rules:
        v = _rule_sql(table, r)
        col = _lit(r.column) if r.column else "CAST(NULL AS VARCHAR)"
        src = "(SELECT 1) AS _one" if v.startswith("(SELECT") else table   # schema-only verdict
        parts.append(
            f"SELECT {_lit(suite)} AS suite, {_lit(r.rule)} AS rule, {col} AS \"column\", "
            f"CAST({v} AS BIGINT) AS violations, CAST({v} AS BIGINT) = 0 AS passed, "
            f"{_lit(r.severity)} AS severity FROM {src}")
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------ rule keys

def _single_rule_query(spec):
    """spec: list of (suite, table, frame_getter, rule)."""
    def q(spark, sf_dir):
        L = Layers(spark, sf_dir)
        suites = {}                      # one pass for the rules of one suite
        for suite, _t, get, r in spec:
            suites.setdefault((suite, get), []).append(r)
        return quality.union_all([quality.evaluate_suite(get(L), rules, suite)
                                  for (suite, get), rules in suites.items()])
    sql = oracle.with_prelude("\nUNION ALL\n".join(
        _suite_sql(suite, table, [r]) for suite, table, _g, r in spec))
    return q, sql


def _silver_c(L):
    return L.model("contracts_silver")


def _bronze_c(L):
    return L.model("bronze_contracts")


def _bronze_b(L):
    return L.model("bronze_budgets")


_CONTRACTS = BRONZE_CONTRACTS.fieldNames()
_BUDGETS = BRONZE_BUDGETS.fieldNames()

_RULE_KEYS = {
    "rule_not_null": [
        ("silver.contracts_silver", "contracts_silver", _silver_c, Rule("expect_column_values_to_not_be_null", {"column": c}))
        for c in ("contract_id", "client_name", "start_date", "contract_value")],
    "rule_in_set": [
        ("silver.contracts_silver", "contracts_silver", _silver_c,
         Rule("expect_column_values_to_be_in_set", {"column": "contract_status",
                                                    "value_set": ["active", "completed", "pending", "cancelled"]})),
        ("bronze.budgets", "bronze_budgets", _bronze_b,
         Rule("expect_column_values_to_be_in_set", {"column": "scope", "value_set": ["budgetAndCost"]})),
    ],
    "rule_unique": [
        ("silver.contracts_silver", "contracts_silver", _silver_c, Rule("expect_column_values_to_be_unique", {"column": "contract_id"})),
        ("silver.contracts_silver", "contracts_silver", _silver_c, Rule("expect_column_values_to_be_unique", {"column": "client_name"})),
        ("bronze.budgets", "bronze_budgets", _bronze_b, Rule("expect_column_values_to_be_unique", {"column": "id"})),
    ],
    "rule_between": [
        ("silver.contracts_silver", "contracts_silver", _silver_c,
         Rule("expect_column_values_to_be_between", {"column": "contract_value", "min_value": 0})),
        ("silver.contracts_silver", "contracts_silver", _silver_c,
         Rule("expect_column_values_to_be_between", {"column": "contract_value", "min_value": 1000,
                                                     "max_value": 400000, "strict_min": True})),
    ],
    "rule_date_order": [
        ("silver.contracts_silver", "contracts_silver", _silver_c,
         Rule("expect_column_pair_values_A_to_be_greater_than_B",
              {"column_A": "end_date", "column_B": "start_date", "or_equal": True})),
        ("silver.contracts_silver", "contracts_silver", _silver_c,
         Rule("expect_column_pair_values_A_to_be_greater_than_B",
              {"column_A": "start_date", "column_B": "end_date", "or_equal": False})),
    ],
    "rule_columns": [
        ("bronze.contracts", "bronze_contracts", _bronze_c,
         Rule("expect_table_columns_to_match_ordered_list", {"column_list": _CONTRACTS})),
        ("bronze.budgets", "bronze_budgets", _bronze_b,
         Rule("expect_table_columns_to_match_ordered_list", {"column_list": list(reversed(_BUDGETS))})),
        ("silver.contracts_silver", "contracts_silver", _silver_c,
         Rule("expect_table_columns_to_match_set", {"column_set": ["contract_id", "processed_at"], "exact_match": False})),
        ("silver.contracts_silver", "contracts_silver", _silver_c,
         Rule("expect_table_columns_to_match_set", {"column_set": ["contract_id", "budget_id"], "exact_match": False})),
    ],
    "rule_type": [
        ("bronze.contracts", "bronze_contracts", _bronze_c, Rule("expect_column_values_to_be_of_type", {"column": "contract_value", "type_": "NUMERIC"})),
        ("bronze.contracts", "bronze_contracts", _bronze_c, Rule("expect_column_values_to_be_of_type", {"column": "contract_id", "type_": "NUMERIC"})),
        ("bronze.contracts", "bronze_contracts", _bronze_c, Rule("expect_column_values_to_be_of_type", {"column": "start_date", "type_": "DATE"})),
        ("bronze.budgets", "bronze_budgets", _bronze_b, Rule("expect_column_values_to_be_of_type", {"column": "plannedStartDate", "type_": "DATE"})),
        ("bronze.budgets", "bronze_budgets", _bronze_b, Rule("expect_column_values_to_be_of_type", {"column": "originalAmount", "type_": "STRING"})),
        ("bronze.budgets", "bronze_budgets", _bronze_b, Rule("expect_column_values_to_be_of_type", {"column": "id", "type_": "UUID"})),
    ],
}

for _name, _spec in _RULE_KEYS.items():
    _fn, _sql = _single_rule_query(_spec)
    register(_name, _sql)(_fn)


# ------------------------------------------------------- suites + report

_SUITES = [("bronze_contracts", "bronze_contracts", _bronze_c),
           ("bronze_budgets", "bronze_budgets", _bronze_b),
           ("silver_contracts", "contracts_silver", _silver_c)]


def _suite_report(spark, sf_dir):
    L = Layers(spark, sf_dir)
    frames = []
    for fname, _t, get in _SUITES:
        suite, rules = quality.builtin_suite(fname)
        frames.append(quality.evaluate_suite(get(L), rules, suite))
    return quality.union_all(frames)


def _all_suites_sql() -> str:
    parts = []
    for fname, table, _g in _SUITES:
        suite, rules = quality.builtin_suite(fname)
        parts.append(_suite_sql(suite, table, rules))
    return "\nUNION ALL\n".join(parts)


_SUITE_SQL = _all_suites_sql()

register("rule_suite_report", oracle.with_prelude(_SUITE_SQL))(_suite_report)


@register("quality_report", oracle.with_prelude(f"""
SELECT split_part(suite, '.', 1) AS layer,
       split_part(suite, '.', len(string_split(suite, '.'))) AS dataset,
       COUNT(*) AS rules,
       COUNT(*) FILTER (WHERE NOT passed) AS failed_rules,
       CASE WHEN COUNT(*) FILTER (WHERE NOT passed) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status
FROM _suite_rows GROUP BY 1, 2""", f"_suite_rows AS (\n{_SUITE_SQL}\n)"))
def q_quality_report(spark, sf_dir):
    return quality.layer_status(_suite_report(spark, sf_dir))


# ------------------------------------------------------ schema tests

_SPEC = quality.schema_tests_spec()


_NOT_NULL_SQL = "\nUNION ALL\n".join(
    f"SELECT {_lit(m)} AS model, {_lit(c)} AS column_name, 'not_null' AS test, "
    f"COUNT(*) FILTER (WHERE {_q(c)} IS NULL) AS failures, "
    f"COUNT(*) FILTER (WHERE {_q(c)} IS NULL) = 0 AS passed FROM {m}"
    for m, t in _SPEC.items() for c in t["not_null"])

_UNIQUE_SQL = "\nUNION ALL\n".join(
    f"SELECT {_lit(m)} AS model, {_lit(c)} AS column_name, 'unique' AS test, "
    f"COUNT(*) AS failures, COUNT(*) = 0 AS passed FROM "
    f"(SELECT {_q(c)} FROM {m} WHERE {_q(c)} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"
    for m, t in _SPEC.items() for c in t["unique"])


def schema_test_sql() -> str:
    """All declarative tests, over the models' CTEs."""
    return f"{_NOT_NULL_SQL}\nUNION ALL\n{_UNIQUE_SQL}"


def suite_rows_sql() -> str:
    """The rows of all built-in suites, as a statement of its own."""
    return oracle.with_prelude(_SUITE_SQL)


@register("schema_test_not_null", oracle.with_prelude(_NOT_NULL_SQL))
def q_schema_test_not_null(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return quality.union_all([quality.not_null_tests(L.model(m), m, t["not_null"])
                              for m, t in _SPEC.items() if t["not_null"]])


@register("schema_test_unique", oracle.with_prelude(_UNIQUE_SQL))
def q_schema_test_unique(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return quality.union_all([quality.unique_tests(L.model(m), m, t["unique"])
                              for m, t in _SPEC.items() if t["unique"]])


# ------------------------------------------------------ blocking checks

_CHECKS = {
    "check_silver_contracts": ("contracts_silver", ["contract_id"]),
    "check_silver_contracts_unchecked": ("contracts_silver_unchecked", ["contract_id"]),
    "check_silver_budgets": ("budgets_silver", ["budget_id"]),
    "check_silver_change_orders": ("change_orders_silver", ["change_order_id"]),
    "check_gold_project": ("project_analytics", ["contract_id"]),
    "check_gold_client": ("client_analytics", ["client_name"]),
    "check_gold_time": ("time_analytics", ["year", "month"]),
    "check_gold_summary": ("contract_summary", ["client_name"]),
}


_UNCHECKED = """contracts_silver_unchecked AS (
  SELECT CASE WHEN CAST(regexp_extract(contract_name, '\\d+$') AS BIGINT) % 251 <> 0 THEN contract_id END AS contract_id
  FROM contracts_silver)"""


def _check_query(name, model, cols):
    def q(spark, sf_dir):
        return quality.null_key_check(Layers(spark, sf_dir).model(model), name, *cols)
    cond = " OR ".join(f"{c} IS NULL" for c in cols)
    sql = oracle.with_prelude(
        f"SELECT {_lit(name)} AS check_name, COUNT(*) AS failing_rows, COUNT(*) = 0 AS passed "
        f"FROM {model} WHERE {cond}", _UNCHECKED)
    return q, sql


for _name, (_model, _cols) in _CHECKS.items():
    _fn, _sql = _check_query(_name, _model, _cols)
    register(_name, _sql)(_fn)


# ------------------------------------------------ cross-layer reconciliation

@register("layer_row_counts", oracle.with_prelude("""
SELECT b.n AS bronze_rows, s.n AS silver_rows, b.n <= s.n AS passed
FROM (SELECT COUNT(*) AS n FROM bronze_contracts) b, (SELECT COUNT(*) AS n FROM contracts_silver) s"""))
def q_layer_row_counts(spark, sf_dir):
    L = Layers(spark, sf_dir)
    counts = (L.bronze.contracts().select(F.lit("bronze").alias("layer"))
              .unionByName(L.model("contracts_silver").select(F.lit("silver").alias("layer")))
              .agg(F.count_if(F.col("layer") == "bronze").alias("bronze_rows"),
                   F.count_if(F.col("layer") == "silver").alias("silver_rows")))
    return counts.select("bronze_rows", "silver_rows",
                         (F.col("bronze_rows") <= F.col("silver_rows")).alias("passed"))


@register("bronze_silver_missing_ids", oracle.with_prelude("""
SELECT COUNT(DISTINCT b.contract_id) AS missing_ids, COUNT(DISTINCT b.contract_id) = 0 AS passed
FROM bronze_contracts b
WHERE b.contract_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM contracts_silver s WHERE s.contract_id = b.contract_id)"""))
def q_bronze_silver_missing_ids(spark, sf_dir):
    L = Layers(spark, sf_dir)
    b = L.bronze.contracts().select("contract_id").where(F.col("contract_id").isNotNull())
    return _missing_ids(b, L.model("contracts_silver"))


def _missing_ids(rows, contracts):
    missing = rows.join(contracts.select("contract_id"), "contract_id", "left_anti")
    return missing.agg(F.countDistinct("contract_id").alias("missing_ids")).select(
        "missing_ids", (F.col("missing_ids") == 0).alias("passed"))


@register("budget_orphan_contract_ids", oracle.with_prelude("""
SELECT COUNT(DISTINCT b.contract_id) AS missing_ids, COUNT(DISTINCT b.contract_id) = 0 AS passed
FROM budgets_silver b
WHERE b.contract_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM contracts_silver s WHERE s.contract_id = b.contract_id)"""))
def q_budget_orphan_contract_ids(spark, sf_dir):
    L = Layers(spark, sf_dir)
    ids = L.model("budgets_silver").select("contract_id").where(F.col("contract_id").isNotNull())
    return _missing_ids(ids, L.model("contracts_silver"))


# The layers of different loads: silver holds what an earlier run loaded (the
# contracts that began by a date, and their budgets), bronze what is there now.
_EARLIER = "1999-12-31"


@register("layer_reconciliation", oracle.with_prelude(f"""
SELECT 'contracts' AS dataset, COUNT(*) AS bronze_rows, COUNT(*) FILTER (start_date <= DATE '{_EARLIER}') AS silver_rows,
       COUNT(DISTINCT contract_id) - COUNT(DISTINCT contract_id) FILTER (start_date <= DATE '{_EARLIER}') AS missing_ids,
       COUNT(*) <= COUNT(*) FILTER (start_date <= DATE '{_EARLIER}') AS passed
FROM bronze_contracts
UNION ALL
SELECT 'budgets', n, m, missing, n <= m
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (early) AS m,
             COUNT(DISTINCT id) - COUNT(DISTINCT id) FILTER (early) AS missing
      FROM (SELECT id, contractId IN (SELECT contract_id FROM bronze_contracts WHERE start_date <= DATE '{_EARLIER}') AS early
            FROM bronze_budgets))"""))
def q_layer_reconciliation(spark, sf_dir):
    L = Layers(spark, sf_dir)
    contracts, budgets = L.model("bronze_contracts"), L.model("bronze_budgets")
    before = L.model("contracts_silver").where(F.col("start_date") <= F.lit(_EARLIER).cast("date"))
    before_b = L.model("budgets_silver").join(before.select("contract_id").distinct(), "contract_id", "left_semi")
    return quality.union_all([
        quality.reconcile(contracts.select(F.col("contract_id").alias("id")), before.select(F.col("contract_id").alias("id")), "contracts"),
        quality.reconcile(budgets.select("id"), before_b.select(F.col("budget_id").alias("id")), "budgets")])


# ------------------------------------------------------ small model checks

# One client's contracts by name (an equality filter on a stored table).
@register("client_lookup", oracle.with_prelude("""
SELECT contract_id, contract_name, contract_value FROM contracts_silver
WHERE client_name = (SELECT max(client_name) FROM contracts_silver)"""))
def q_client_lookup(spark, sf_dir):
    c = Layers(spark, sf_dir).model("contracts_silver")
    name = c.agg(F.max("client_name")).first()[0]
    return c.where(F.col("client_name") == F.lit(name)).select("contract_id", "contract_name", "contract_value")


@register("client_rollup", oracle.with_prelude("""
SELECT client_name, COUNT(contract_id) AS total_contracts,
       CAST(SUM(contract_value) AS DOUBLE) AS total_value
FROM contracts_silver GROUP BY client_name"""))
def q_client_rollup(spark, sf_dir):
    return (Layers(spark, sf_dir).contracts().groupBy("client_name")
            .agg(F.count("contract_id").alias("total_contracts"),
                 F.sum("contract_value").cast("double").alias("total_value")))


@register("budget_delays", oracle.with_prelude("""
SELECT budget_id, contract_id,
       date_diff('day', planned_start_date, planned_end_date) AS planned_duration_days,
       date_diff('day', actual_start_date, actual_end_date) AS actual_duration_days,
       date_diff('day', planned_start_date, actual_start_date) AS start_delay_days
FROM budgets_silver"""))
def q_budget_delays(spark, sf_dir):
    return Layers(spark, sf_dir).budgets().select(
        "budget_id", "contract_id",
        days_between("planned_end_date", "planned_start_date").alias("planned_duration_days"),
        days_between("actual_end_date", "actual_start_date").alias("actual_duration_days"),
        days_between("actual_start_date", "planned_start_date").alias("start_delay_days"))


# ------------------------------------------- offenders and run status (Q4, Q10)

@register("rule_in_set_offenders", oracle.with_prelude("""
SELECT DISTINCT scope FROM bronze_budgets
WHERE NOT COALESCE(scope IN ('budgetAndCost'), FALSE)"""))
def q_rule_in_set_offenders(spark, sf_dir):
    return quality.offending_values(Layers(spark, sf_dir).bronze.budgets(), "scope", ["budgetAndCost"])


@register("quality_layer_status", oracle.with_prelude(f"""
SELECT split_part(suite, '.', 1) AS layer,
       CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'FAILED' END AS status
FROM _suite_rows GROUP BY 1""", f"_suite_rows AS (\n{_SUITE_SQL}\n)"))
def q_quality_layer_status(spark, sf_dir):
    report = quality.layer_status(_suite_report(spark, sf_dir))
    return (report.groupBy("layer")
            .agg(F.every(F.col("status") == "PASSED").alias("ok"))
            .select("layer", F.when(F.col("ok"), "PASSED").otherwise("FAILED").alias("status")))
