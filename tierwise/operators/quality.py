"""Data-quality rules, suites, declarative schema tests and layer checks.

A rule suite is evaluated in **one pass** over its table: every row-level
rule becomes a ``count_if`` and schema rules (column lists, types) are read
from the DataFrame's metadata on the driver.  The single result row is turned
into one row per rule: ``(suite, rule, column, violations, passed, severity)``.
Only that one-row aggregate ever reaches the driver.

Uniqueness rules go through the same pass in long form: a row becomes one
(rule, value) pair per uniqueness rule, pairs are counted in two phases (a value
that holds a third of the rows is reduced to one pair in every task), and a
value that occurs n times is n - 1 violations.  However many uniqueness rules a
suite has, there is one exchange of pairs and no expansion beyond them; the
row-level counts ride on the first rule's pairs.  Values are compared as they
are, not by hash.

Rule types (expectation names as used by the reference's suite files):

=====================================================  =========================
expect_table_columns_to_match_ordered_list             column_list
expect_table_columns_to_match_set                      column_set, exact_match
expect_column_values_to_not_be_null                    column
expect_column_values_to_be_of_type                     column, type_ (NUMERIC/STRING/DATE)
expect_column_values_to_be_of_spark_type               column, type_ (e.g. ``date``)
expect_column_values_to_be_in_set                      column, value_set
expect_column_values_to_be_unique                      column
expect_column_values_to_be_between                     column, min_value, max_value, strict_*
expect_column_pair_values_A_to_be_greater_than_B       column_A, column_B, or_equal
=====================================================  =========================

Unknown rule types are skipped, as the reference's interpreter does.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.functions.casts import safe_date
from tierwise.sources import versions

SUITE_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "suites")

REPORT_SCHEMA = T.StructType([
    T.StructField("suite", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("violations", T.LongType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("severity", T.StringType()),
])


@dataclass(frozen=True)
class Rule:
    rule: str
    kwargs: dict = field(default_factory=dict)
    severity: str = "error"

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column") or self.kwargs.get("column_A")


# ------------------------------------------------------------------ suites

#: A suite file: its name and rules; arguments stay JSON text, as each rule
#: type has its own.
SUITE_JSON = ("expectation_suite_name string, expectations array<struct<expectation_type: string, "
              "kwargs: string, meta: struct<severity: string>>>, _corrupt_record string")


def _parse_suite(text: str, default_name: str) -> tuple[str, list[Rule]] | None:
    try:
        doc = json.loads(text)
        rules = [Rule(e["expectation_type"], dict(e.get("kwargs", {})),
                      e.get("meta", {}).get("severity", "error"))
                 for e in doc.get("expectations", [])]
    except (ValueError, AttributeError, KeyError, TypeError):
        return None
    return doc.get("expectation_suite_name", default_name), rules


def load_suite(path: str) -> tuple[str, list[Rule]] | None:
    """A suite file on the driver's disk; None if missing or invalid."""
    try:
        with open(path) as f:
            return _parse_suite(f.read(), os.path.basename(path))
    except OSError:
        return None


def read_suites(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Suite files on any Hadoop path as a rules table: ``path``, ``suite``,
    ``position``, ``rule``, ``kwargs`` (JSON text), ``severity``, ``error``.

    A file that is missing, no JSON or not of a suite's shape has one row with
    its ``error`` and no rule.
    """
    found = [p for p in paths if versions.exists(spark, p)]
    out = spark.createDataFrame([(p, None, None, None, None, None, "suite file missing") for p in paths if p not in found],
                                "path string, suite string, position int, rule string, kwargs string, severity string, error string")
    for p in found:
        doc = (spark.read.text(p, wholetext=True)
               .select(F.from_json("value", SUITE_JSON, {"mode": "PERMISSIVE"}).alias("s")))
        bad = (F.col("s").isNull() | F.col("s._corrupt_record").isNotNull() | F.col("s.expectations").isNull()
               | F.exists("s.expectations", lambda e: e.isNull() | e["expectation_type"].isNull()))
        doc = doc.select(F.coalesce("s.expectation_suite_name", F.lit(p.rsplit("/", 1)[-1])).alias("suite"),
                         F.when(~bad, F.col("s.expectations")).alias("rules"), bad.alias("bad"))
        rows = doc.select("suite", "bad", F.posexplode_outer("rules").alias("position", "r"))
        out = out.unionByName(rows.where("bad or r is not null").select(
            F.lit(p).alias("path"), "suite", "position", F.col("r.expectation_type").alias("rule"),
            F.coalesce("r.kwargs", F.lit("{}")).alias("kwargs"),
            F.coalesce("r.meta.severity", F.lit("error")).alias("severity"),
            F.when(F.col("bad"), "suite file invalid").alias("error")))
    return out


def load_suites(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, list[Rule]] | str]:
    """path -> (suite name, rules), or the error's text.  The rules table is a
    few rows per suite, as people write them."""
    out: dict[str, tuple[str, list[Rule]] | str] = {p: (p.rsplit("/", 1)[-1], []) for p in paths}
    for r in read_suites(spark, paths).orderBy("path", "position").collect():
        if r.error:
            out[r.path] = r.error
            continue
        rules = out[r.path][1]
        rules.append(Rule(r.rule, json.loads(r.kwargs), r.severity))
        out[r.path] = (r.suite, rules)
    return out


def builtin_suite(name: str) -> tuple[str, list[Rule]]:
    loaded = load_suite(os.path.join(SUITE_DIR, f"{name}.json"))
    if loaded is None:
        raise FileNotFoundError(name)
    return loaded


# ------------------------------------------------------------------ row rules

def _family_ok(dt: T.DataType, family: str) -> bool | None:
    """True/False from the schema, None when values must be inspected."""
    numeric = isinstance(dt, T.NumericType)
    text = isinstance(dt, (T.StringType, T.VarcharType, T.CharType))
    temporal = isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if family == "NUMERIC":
        return numeric
    if family == "STRING":
        return text
    if family == "DATE":
        if temporal or numeric:   # numbers parse as epoch offsets, as in the reference
            return True
        if text:
            return None
        return False
    return False                  # unknown family fails


#: Marks a uniqueness rule, counted by :func:`_counted`.
UNIQUE = object()


def _violation_expr(df: DataFrame, r: Rule, parse_dates: bool) -> Column | bool | object | None:
    """A row's violation (a condition), a metadata verdict, UNIQUE, or None to
    skip."""
    k = r.kwargs
    t = r.rule
    if t == "expect_table_columns_to_match_ordered_list":
        return list(df.columns) == list(k["column_list"])
    if t == "expect_table_columns_to_match_set":
        want, have = set(k["column_set"]), set(df.columns)
        return want == have if k.get("exact_match", True) else want <= have
    if t == "expect_column_values_to_be_of_spark_type":
        c = k["column"]
        return c in df.columns and df.schema[c].dataType.simpleString() == k["type_"]
    if any(k[n] not in df.columns for n in ("column", "column_A", "column_B") if n in k):
        return False
    c = F.col(k["column"]) if "column" in k else None
    if t == "expect_column_values_to_not_be_null":
        return c.isNull()
    if t == "expect_column_values_to_be_in_set":
        # NULL is not in the set: it counts as a violation.
        return ~F.coalesce(c.isin(list(k["value_set"])), F.lit(False))
    if t == "expect_column_values_to_be_between":
        lo, hi = k.get("min_value"), k.get("max_value")
        bad = F.lit(False)
        if lo is not None:
            bad = bad | ((c <= F.lit(lo)) if k.get("strict_min") else (c < F.lit(lo)))
        if hi is not None:
            bad = bad | ((c >= F.lit(hi)) if k.get("strict_max") else (c > F.lit(hi)))
        return F.coalesce(bad, F.lit(False))        # NULLs are skipped
    if t == "expect_column_values_to_be_unique":
        return UNIQUE
    if t == "expect_column_pair_values_A_to_be_greater_than_B":
        a, b = F.col(k["column_A"]), F.col(k["column_B"])
        bad = (a < b) if k.get("or_equal") else (a <= b)
        return F.coalesce(bad, F.lit(False))
    if t == "expect_column_values_to_be_of_type":
        verdict = _family_ok(df.schema[k["column"]].dataType, k["type_"])
        if verdict is not None or not parse_dates:
            return True if verdict is None else verdict
        return c.isNotNull() & safe_date(c).isNull()
    return None


def _as_text(df: DataFrame, column: str) -> Column:
    """A value as text that is equal for equal values only (-0.0 is 0.0)."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0)
    return c.cast("string")


def _counted(df: DataFrame, rows: dict[str, Column], unique: dict[str, str]) -> DataFrame:
    """One row: the number of rows with each violation of ``rows``, and the
    duplicates (rows less distinct values, NULL being a value) of each column of
    ``unique``."""
    if not unique:
        return df.agg(*[F.count_if(v).alias(n) for n, v in rows.items()])
    flags = {n: F.count_if(F.col(n)).alias(n) for n in rows}
    base = df.select(*[F.coalesce(v, F.lit(False)).alias(n) for n, v in rows.items()],
                     F.posexplode(F.array(*[_as_text(df, c) for c in unique.values()])).alias("_k", "_v"))
    first = F.col("_k") == 0          # row violations count once, with the first pair
    pairs = (base.select("_k", "_v", *[(F.col(n) & first).alias(n) for n in rows])
             .groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_n"), *flags.values()))
    return pairs.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in rows],
                     *[F.coalesce(F.sum(F.when(F.col("_k") == k, F.col("_n") - 1)), F.lit(0)).alias(n)
                       for k, n in enumerate(unique)])


def evaluate_suite(df: DataFrame, rules: list[Rule], suite: str,
                   parse_dates: bool = True, ignored_rules=()) -> DataFrame:
    """All rules of a suite in one pass; one output row per known rule.

    Rule types in ``ignored_rules`` are skipped like unknown ones (the
    reference's bronze-contracts runner, for one, has no uniqueness branch).
    """
    spark = df.sparkSession
    rows: dict[str, Column] = {}
    unique: dict[str, str] = {}
    entries: list[tuple[Rule, Column]] = []
    for i, r in enumerate(rules):
        if r.rule in ignored_rules:
            continue
        v = _violation_expr(df, r, parse_dates)
        if v is None:
            continue                                  # unknown rule type
        if isinstance(v, bool):
            entries.append((r, F.lit(0 if v else 1).cast("long")))
            continue
        name = f"_r{i}"
        if v is UNIQUE:
            unique[name] = r.kwargs["column"]
        else:
            rows[name] = v
        entries.append((r, F.col(name).cast("long")))
    if not entries:
        return spark.createDataFrame([], REPORT_SCHEMA)
    # Schema-only suites are decided by the table's metadata, without a scan.
    base = _counted(df, rows, unique) if rows or unique else spark.range(1)
    structs = [F.struct(F.lit(suite).alias("suite"), F.lit(r.rule).alias("rule"),
                        F.lit(r.column).cast("string").alias("column"),
                        v.alias("violations"), F.lit(r.severity).alias("severity"))
               for r, v in entries]
    return (base.select(F.explode(F.array(*structs)).alias("x"))
            .select("x.suite", "x.rule", "x.column", "x.violations",
                    (F.col("x.violations") == 0).alias("passed"), "x.severity"))


def offending_values(df: DataFrame, column: str, value_set) -> DataFrame:
    """Distinct values outside the set (NULL included), as a distributed frame."""
    c = F.col(column)
    return (df.where(~F.coalesce(c.isin(list(value_set)), F.lit(False)))
            .select(c).distinct())


# ----------------------------------------------- single rules (unit helpers)

def check_rule(df: DataFrame, rule: str, **kwargs) -> bool:
    """Evaluate one rule and return its verdict (one-row action)."""
    row = evaluate_suite(df, [Rule(rule, kwargs)], "adhoc").first()
    return bool(row["passed"]) if row is not None else True


# ------------------------------------------------ declarative schema tests

def schema_tests_spec() -> dict[str, dict[str, list[str]]]:
    with open(os.path.join(SUITE_DIR, "schema_tests.json")) as f:
        spec = json.load(f)
    spec.pop("_comment", None)
    return spec


def not_null_tests(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """One pass: NULL count per listed column -> (model, column_name, test, failures, passed)."""
    structs = [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                        F.lit("not_null").alias("test"),
                        F.count_if(F.col(c).isNull()).cast("long").alias("failures"))
               for c in columns]
    return (df.agg(F.array(*structs).alias("a"))
            .select(F.explode("a").alias("x"))
            .select("x.*", (F.col("x.failures") == 0).alias("passed")))


def unique_test(df: DataFrame, model: str, column: str) -> DataFrame:
    """Values (NULLs ignored) occurring more than once; failures = their number."""
    dup = (df.where(F.col(column).isNotNull()).groupBy(column).count()
           .where(F.col("count") > 1))
    return dup.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("test"), "failures", (F.col("failures") == 0).alias("passed"))


def unique_tests(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """:func:`unique_test` of several columns in one pass, in long form."""
    pairs = df.select(F.posexplode(F.array(*[_as_text(df, c) for c in columns])).alias("_k", "_v")).where("_v is not null")
    counted = (pairs.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_n"))
               .agg(*[F.count_if((F.col("_k") == k) & (F.col("_n") > 1)).alias(f"_c{k}") for k in range(len(columns))]))
    structs = [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit("unique").alias("test"),
                        F.col(f"_c{k}").cast("long").alias("failures")) for k, c in enumerate(columns)]
    return (counted.select(F.explode(F.array(*structs)).alias("x"))
            .select("x.*", (F.col("x.failures") == 0).alias("passed")))


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------ layer checks

def null_key_check(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Blocking check ``SELECT COUNT(*) = 0 FROM t WHERE c1 IS NULL [OR c2 IS NULL]``."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return (df.agg(F.count_if(cond).cast("long").alias("failing_rows"))
            .select(F.lit(name).alias("check_name"), "failing_rows",
                    (F.col("failing_rows") == 0).alias("passed")))


def reconcile(source: DataFrame, target: DataFrame, dataset: str) -> DataFrame:
    """Rows of two layers and the ids of ``source`` that ``target`` lacks (both
    with a column ``id``): one pass over each.  Ids are reduced to one row per
    layer and id before they meet, so a repeated id costs nothing."""
    both = (source.select("id", F.lit(1).alias("s"), F.lit(0).alias("t"))
            .unionByName(target.select("id", F.lit(0).alias("s"), F.lit(1).alias("t"))))
    ids = both.groupBy("id").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    lost = F.col("id").isNotNull() & (F.col("s") > 0) & (F.col("t") == 0)
    return (ids.agg(F.sum("s").alias("bronze_rows"), F.sum("t").alias("silver_rows"), F.count_if(lost).alias("missing_ids"))
            .select(F.lit(dataset).alias("dataset"), F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"),
                    F.coalesce("silver_rows", F.lit(0)).alias("silver_rows"), "missing_ids",
                    (F.coalesce("bronze_rows", F.lit(0)) <= F.coalesce("silver_rows", F.lit(0))).alias("passed")))


def raise_on_errors(report: DataFrame, passed_col: str = "passed") -> None:
    """Fail the run when an error-severity rule failed (warnings only log)."""
    sev = F.col("severity") if "severity" in report.columns else F.lit("error")
    bad = report.where(~F.col(passed_col) & (sev == "error")).collect()
    if bad:
        raise AssertionError(f"data-quality failures: {[r.asDict() for r in bad]}")


def layer_status(report: DataFrame) -> DataFrame:
    """Per suite: rules, failed rules, PASSED/FAILED (``every(passed)``)."""
    layer = F.split(F.col("suite"), r"\.").getItem(0)
    dataset = F.element_at(F.split(F.col("suite"), r"\."), -1)
    return (report.groupBy(layer.alias("layer"), dataset.alias("dataset"))
            .agg(F.count(F.lit(1)).alias("rules"),
                 F.count_if(~F.col("passed")).alias("failed_rules"))
            .select("layer", "dataset", "rules", "failed_rules",
                    F.when(F.col("failed_rules") == 0, "PASSED").otherwise("FAILED").alias("status")))


def missing_input_status(spark: SparkSession, layer: str, dataset: str) -> DataFrame:
    """A missing bronze input fails its layer; a missing silver one passes (with a note)."""
    status = "PASSED" if layer == "silver" else "FAILED"
    return spark.createDataFrame(
        [(layer, dataset, 0, 0 if status == "PASSED" else 1, status)],
        "layer string, dataset string, rules bigint, failed_rules bigint, status string")
