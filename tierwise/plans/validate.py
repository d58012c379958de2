"""File validation run: rule suites over bronze and silver files.

Bronze passes when both the contracts and the budgets file pass their
suites; a missing bronze file fails the layer.  A missing silver file
passes with a warning (there is nothing to validate yet).  The run's
status is PASSED only when every layer passed; the command-line entry
returns 0 / 1 accordingly.

Files are read with schema inference, as a validator that knows nothing
about the load schema does; each suite then runs as one pass.  Every file is
validated by a job of its own, whose few rows go to the shared folder: a file
that cannot be read (damaged, not there any more, failing halfway) is a FAILED
row with the error's text, and the others are validated all the same.  Suites
are read from any Hadoop path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.operators import quality
from tierwise.session import scratch_path
from tierwise.sources import bronze, versions


@dataclass(frozen=True)
class Target:
    layer: str          # "bronze" or "silver"
    dataset: str        # e.g. "contracts"
    path: str
    suite_file: str     # a built-in suite's name or a file on any Hadoop path
    ignored_rules: tuple = ()


ROW = "layer string, dataset string, rules bigint, failed_rules bigint, status string, note string"


def _suites(spark: SparkSession, names: list[str]) -> dict:
    """Suite file -> (name, rules), or an error's text."""
    paths = [n for n in names if "/" in n]
    out = quality.load_suites(spark, paths) if paths else {}
    for n in names:
        if "/" not in n:
            try:
                out[n] = quality.builtin_suite(n)
            except FileNotFoundError:
                out[n] = "suite file missing"
    return out


def _first_line(e: Exception) -> str:
    """What went wrong, in one line, without paths of task files."""
    text = getattr(e, "getCondition", lambda: None)() or str(e).strip().split("\n", 1)[0]
    return f"{type(e).__name__}: {text}"


def validate(spark: SparkSession, targets: list[Target]) -> DataFrame:
    """One row per target: layer, dataset, rules, failed_rules, status, note."""
    root = scratch_path(spark, "validation")
    suites = _suites(spark, sorted({t.suite_file for t in targets}))
    settled, parts = [], []
    for i, t in enumerate(targets):
        loaded = suites[t.suite_file]
        if not versions.exists(spark, t.path):
            if t.layer == "silver":
                settled.append((t.layer, t.dataset, 0, 0, "PASSED", "input missing: skipped"))
            else:
                settled.append((t.layer, t.dataset, 0, 1, "FAILED", "input missing"))
            continue
        if isinstance(loaded, str):           # a bad suite file fails the dataset
            settled.append((t.layer, t.dataset, 0, 1, "FAILED", loaded))
            continue
        name, rules = loaded
        try:
            df = bronze.read_csv_inferred(spark, t.path)
            report = quality.evaluate_suite(df, rules, name, ignored_rules=t.ignored_rules)
            (report.agg(F.count(F.lit(1)).alias("rules"), F.count_if(~F.col("passed")).alias("failed_rules"))
             .select(F.lit(t.layer).alias("layer"), F.lit(t.dataset).alias("dataset"), "rules", "failed_rules",
                     F.when(F.col("failed_rules") == 0, "PASSED").otherwise("FAILED").alias("status"),
                     F.lit(None).cast("string").alias("note"))
             .write.parquet(f"{root}/{i}"))
            parts.append(f"{root}/{i}")
        except Exception as e:  # noqa: BLE001 - any failure is this file's row
            settled.append((t.layer, t.dataset, 0, 1, "FAILED", f"unreadable: {_first_line(e)}"))
    out = spark.createDataFrame(settled, ROW)
    return out.unionByName(spark.read.schema(ROW).parquet(*parts)) if parts else out


def layer_summary(report: DataFrame) -> DataFrame:
    """PASSED for a layer only when all its datasets passed."""
    return (report.groupBy("layer")
            .agg(F.every(F.col("status") == "PASSED").alias("passed"))
            .select("layer", F.when(F.col("passed"), "PASSED").otherwise("FAILED").alias("status")))


def exit_status(report: DataFrame) -> int:
    """0 when every layer passed, else 1 (one-row aggregate on the driver)."""
    ok = layer_summary(report).agg(F.every(F.col("status") == "PASSED").alias("ok")).first()["ok"]
    return 0 if ok else 1


def main(argv=None) -> int:
    """``python -m tierwise.plans.validate BRONZE_DIR [SILVER_DIR]``"""
    import argparse

    from tierwise.session import build_session

    ap = argparse.ArgumentParser(description="validate bronze and silver files")
    ap.add_argument("bronze_dir")
    ap.add_argument("silver_dir", nargs="?")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(args.master, app_name="tierwise-validate")
    # The bronze contracts runner checks no uniqueness (as in the reference).
    targets = [Target("bronze", "contracts", f"{args.bronze_dir}/contracts.csv", "bronze_contracts",
                      ignored_rules=("expect_column_values_to_be_unique",)),
               Target("bronze", "budgets", f"{args.bronze_dir}/budgets.csv", "bronze_budgets")]
    if args.silver_dir:
        targets.append(Target("silver", "contracts_silver",
                              f"{args.silver_dir}/contracts_silver.csv", "silver_contracts"))
    report = validate(spark, targets)
    for r in report.collect():
        print(f"{r['layer']}.{r['dataset']}: {r['status']}"
              + (f" ({r['note']})" if r["note"] else ""))
    code = exit_status(report)
    print("All validations passed!" if code == 0 else "Some validations failed!")
    spark.stop()
    return code


if __name__ == "__main__":
    raise SystemExit(main())
