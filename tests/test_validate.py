"""File validation run (layers, missing inputs, exit status)."""

import os

from tierwise.plans import validate as V


def _csv(path, text):
    local = path.replace("file:", "")
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w") as f:
        f.write(text)
    return path


CONTRACTS = ("contract_id,contract_name,client_name,start_date,end_date,contract_value,contract_status\n"
             "CONT-001,Office Renovation,Acme Corp,2023-01-01,2023-12-31,150000,active\n"
             "CONT-002,IT Upgrade,TechSolutions Inc,2023-02-15,2023-08-15,75000,pending\n")
BUDGETS_HEADER = ("id,contractId,name,code,scope,plannedStartDate,plannedEndDate,actualStartDate,"
                  "actualEndDate,originalAmount,actualCost,createdAt,updatedAt\n")


def test_bronze_pass_and_missing_silver_passes(spark, tmp_out):
    c = _csv(f"{tmp_out}/b/contracts.csv", CONTRACTS)
    b = _csv(f"{tmp_out}/b/budgets.csv", BUDGETS_HEADER +
             "B1,CONT-001,Budget 1,BUD001,budgetAndCost,2024-01-01,2024-12-31,2024-01-15,,50000,25000,2023-12-15,2024-02-01\n")
    report = V.validate(spark, [
        V.Target("bronze", "contracts", c, "bronze_contracts"),
        V.Target("bronze", "budgets", b, "bronze_budgets"),
        V.Target("silver", "contracts_silver", f"{tmp_out}/s/contracts_silver.csv", "silver_contracts")])
    rows = {(r["layer"], r["dataset"]): r for r in report.collect()}
    assert rows[("bronze", "contracts")]["status"] == "PASSED"
    assert rows[("bronze", "budgets")]["status"] == "PASSED"
    assert rows[("silver", "contracts_silver")]["status"] == "PASSED"
    assert rows[("silver", "contracts_silver")]["note"]
    assert V.exit_status(report) == 0


def test_missing_bronze_file_and_bad_suite_fail(spark, tmp_out):
    c = _csv(f"{tmp_out}/b2/contracts.csv", CONTRACTS)
    report = V.validate(spark, [
        V.Target("bronze", "contracts", c, "/nonexistent/suite.json"),
        V.Target("bronze", "budgets", f"{tmp_out}/b2/budgets.csv", "bronze_budgets")])
    statuses = {r["dataset"]: r["status"] for r in report.collect()}
    assert statuses == {"contracts": "FAILED", "budgets": "FAILED"}
    assert V.exit_status(report) == 1


def test_rule_failure_fails_layer(spark, tmp_out):
    bad = CONTRACTS.replace("active", "unknown-status")
    c = _csv(f"{tmp_out}/b3/contracts.csv", bad)
    report = V.validate(spark, [V.Target("bronze", "contracts", c, "bronze_contracts")])
    r = report.first()
    assert (r["status"], r["failed_rules"]) == ("FAILED", 1)
    assert [x["status"] for x in V.layer_summary(report).collect()] == ["FAILED"]


def test_ignored_rule_types(spark, tmp_out):
    import json
    dup = CONTRACTS + "CONT-001,Copy,Acme Corp,2023-01-01,2023-12-31,1,active\n"
    c = _csv(f"{tmp_out}/b4/contracts.csv", dup)
    suite = _csv(f"{tmp_out}/b4/suite.json", json.dumps({
        "expectation_suite_name": "bronze.contracts",
        "expectations": [{"expectation_type": "expect_column_values_to_be_unique",
                          "kwargs": {"column": "contract_id"}}]}))
    strict = V.validate(spark, [V.Target("bronze", "contracts", c, suite.replace("file:", ""))])
    lenient = V.validate(spark, [V.Target("bronze", "contracts", c, suite.replace("file:", ""),
                                          ignored_rules=("expect_column_values_to_be_unique",))])
    assert strict.first()["status"] == "FAILED"
    assert lenient.first()["status"] == "PASSED"
