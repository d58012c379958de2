"""Sinks: truncate-and-load tables and delimited files.

Every write is a full refresh: the reference never loads incrementally.
Parquet is the table format; writes go through Spark's commit protocol, so a
lost executor only re-runs its tasks.  A table is a set of one
(:mod:`tierwise.sources.versions`): a new version is written beside the old
one and becomes the table by one atomic pointer, so a reader always finds the
old table or the new one, and a failed job leaves the old one as it was.

In a catalog the pointer is a view over the version's files; replacing a
view's text is one update of the metastore, whatever the schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwise.sources import versions


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> str:
    """Write a table's next version and publish it."""
    path = path.rstrip("/")
    version = versions.fresh(path)
    write_files(df, version, fmt, partition_by)
    versions.publish(df.sparkSession, path, {"": version})
    return path


def write_files(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, compression: str | None = None) -> str:
    """Write the files of one version (the path must be new), with the format's
    own compression unless one is named."""
    w = df.write.format(fmt)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The published version of a table, or the files of a plain folder."""
    published = versions.current(spark, path)
    return spark.read.format(fmt).load(published[""] if published else path)


def publish_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Make ``name`` (`db`.`table`) show the files under ``path``.

    A table of that name from an earlier release is dropped once, after the
    new version is complete."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{path}`")


def write_csv(df: DataFrame, path: str, compression: str | None = None, rows_per_file: int | None = None) -> str:
    """Header row, no index column, values written exactly (no trimming).

    A gzip file is not split between the tasks that read it; ``rows_per_file``
    then bounds the rows of each."""
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    (w.option("header", True)
     .option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .option("dateFormat", "yyyy-MM-dd")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSS]")
     .csv(path))
    return path


def ensure_database(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for catalog-based layouts."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
