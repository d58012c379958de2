"""Registered source/sink queries: bronze CSV scans and table round trips.

Each query derives a bronze or silver frame from the test tables, writes it
with a tierwise sink under the shared checkpoint folder (a fresh path per
call) and returns the frame read back by the matching tierwise reader.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierwise.plans import oracle
from tierwise.plans.catalog import Layers, register
from tierwise.schemas import (
    BRONZE_CONTRACTS, BRONZE_CONTRACTS_REQUIRED, CONTRACTS_SILVER_COLUMNS, MONEY,
)
from tierwise.session import scratch_path
from tierwise.sources import bronze, sinks
from tierwise.sources.testdata import blank_ids
from pyspark.sql import types as T

_CONTRACTS_SILVER_SCHEMA = T.StructType([
    T.StructField("contract_id", T.StringType()),
    T.StructField("contract_name", T.StringType()),
    T.StructField("client_name", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("contract_value", MONEY),
    T.StructField("contract_status", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])
assert [f.name for f in _CONTRACTS_SILVER_SCHEMA.fields] == CONTRACTS_SILVER_COLUMNS


@register("bronze_contracts_csv", oracle.select_all("bronze_contracts"))
def q_bronze_contracts_csv(spark, sf_dir):
    path = sinks.write_csv(Layers(spark, sf_dir).bronze.contracts(),
                           scratch_path(spark, "bronze-contracts-csv"))
    return bronze.read_contracts_csv(spark, path)


@register("bronze_budgets_csv", oracle.select_all("bronze_budgets"))
def q_bronze_budgets_csv(spark, sf_dir):
    path = sinks.write_csv(Layers(spark, sf_dir).bronze.budgets(),
                           scratch_path(spark, "bronze-budgets-csv"))
    return bronze.read_budgets_csv(spark, path)


@register("bronze_change_orders_csv", oracle.with_prelude("""
SELECT id, "number", name, scope, "type", contractId, estimated, proposed, submitted,
       approved, "committed", createdAt, updatedAt, statusChangedAt
FROM bronze_co"""))
def q_bronze_change_orders_csv(spark, sf_dir):
    path = sinks.write_csv(Layers(spark, sf_dir).bronze.change_orders(),
                           scratch_path(spark, "bronze-co-csv"))
    return bronze.read_change_orders_csv(spark, path)


@register("bronze_required_check", oracle.with_prelude("""
SELECT COUNT(*) AS rows_loaded, COUNT(*) FILTER (WHERE contract_id IS NULL) AS required_nulls,
       COUNT(*) FILTER (WHERE contract_id IS NULL) = 0 AS passed
FROM bronze_contracts"""))
def q_bronze_required_check(spark, sf_dir):
    path = sinks.write_csv(Layers(spark, sf_dir).bronze.contracts(),
                           scratch_path(spark, "bronze-required"))
    df = bronze.read_contracts_csv(spark, path)          # raises on a NULL id
    key = BRONZE_CONTRACTS_REQUIRED[0]
    return (df.agg(F.count(F.lit(1)).alias("rows_loaded"),
                   F.count_if(F.col(key).isNull()).alias("required_nulls"))
            .select("rows_loaded", "required_nulls", (F.col("required_nulls") == 0).alias("passed")))


# A delivery in which some ids are blank: the report names them, and the load
# as such is refused.
@register("bronze_required_report", oracle.with_prelude("""
SELECT COUNT(*) AS rows_delivered, COUNT(*) FILTER (WHERE o_orderkey % 251 = 0) AS required_nulls,
       COUNT(*) FILTER (WHERE o_orderkey % 251 = 0) = 0 AS passed,
       COUNT(*) FILTER (WHERE o_orderkey % 251 = 0) > 0 AS load_refused
FROM orders"""))
def q_bronze_required_report(spark, sf_dir):
    path = sinks.write_csv(blank_ids(Layers(spark, sf_dir).bronze.contracts()),
                           scratch_path(spark, "bronze-blank-ids"))
    delivered = bronze.read_typed_csv(spark, path, BRONZE_CONTRACTS)
    try:
        bronze.read_contracts_csv(spark, path).write.format("noop").mode("overwrite").save()
        refused = False
    except Exception as e:  # noqa: BLE001 - the refusal is the finding
        if "REQUIRED" not in str(e):
            raise
        refused = True
    return (bronze.required_report(delivered, BRONZE_CONTRACTS_REQUIRED)
            .withColumn("load_refused", F.lit(refused)))


@register("csv_infer_scan", oracle.with_prelude("""
SELECT contract_id, contract_name, client_name, start_date, end_date,
       CAST(contract_value AS DOUBLE) AS contract_value, contract_status
FROM bronze_contracts"""))
def q_csv_infer_scan(spark, sf_dir):
    path = sinks.write_csv(Layers(spark, sf_dir).bronze.contracts(),
                           scratch_path(spark, "infer-csv"))
    return bronze.read_csv_inferred(spark, path)


@register("csv_roundtrip", oracle.select_all("contracts_silver"))
def q_csv_roundtrip(spark, sf_dir):
    path = sinks.write_csv(Layers(spark, sf_dir).contracts(), scratch_path(spark, "silver-csv"))
    return bronze.read_typed_csv(spark, path, _CONTRACTS_SILVER_SCHEMA)


@register("roundtrip_overwrite", oracle.select_all("contracts_silver"))
def q_roundtrip_overwrite(spark, sf_dir):
    L = Layers(spark, sf_dir)
    path = scratch_path(spark, "silver-parquet")
    sinks.write_table(L.contracts(), path)
    sinks.write_table(L.contracts(), path)               # truncate-and-load: replaces
    return sinks.read_table(spark, path)


# The same in a catalog: the view shows the first version until the second is
# complete, then the second.
@register("catalog_overwrite", oracle.select_all("contracts_silver"))
def q_catalog_overwrite(spark, sf_dir):
    silver = Layers(spark, sf_dir).model("contracts_silver")
    root = scratch_path(spark, "catalog")
    database = f"tierwise_{root.rsplit('-', 1)[-1]}"
    sinks.ensure_database(spark, database)
    name = f"`{database}`.`contracts_silver`"
    first = silver.where("contract_value > 0").select("contract_id", "contract_value")
    sinks.publish_view(spark, name, sinks.write_files(first, f"{root}/1"))
    sinks.publish_view(spark, name, sinks.write_files(silver, f"{root}/2"))
    return spark.table(name)
