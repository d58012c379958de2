"""Token counts by source, language and tokenizer version, kept by deltas.

A batch of changes carries before and after images of a document's count: an
insert has no before, a delete no after, a recount both.  Each becomes one or
two signed rows; their sums by (source, lang, tokenizer) are the batch's
delta.  Totals are the sums of the deltas of all committed batches, so no
document is ever read again.

A batch is committed by a marker file, put in place by a rename that never
overwrites.  A batch that is already there is left as it is, so a batch that is
sent twice, by two committers at once, or again after its driver died, counts
once; half-written batches have no marker and are not read.

Defined cases: null and empty texts count 0, long ones whole; null sources and languages are groups of their own; a null
tokenizer or count is rejected by the filter of :func:`delta`; an empty batch
commits an empty delta; repeated rows of a batch are changes of their own; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm import common
from tierwise.sources import versions

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


def word_count(text: Column) -> Column:
    return F.size(common.words(text)).cast("long")


def delta(changes: DataFrame) -> DataFrame:
    """Changes with ``source``, ``lang``, ``tokenizer``, ``tokens`` and the
    same with ``old_`` -> signed sums by key."""
    gone = changes.select(*[F.col(f"old_{k}").alias(k) for k in KEYS], F.lit(-1).alias("sign"), F.col("old_tokens").alias("tokens"))
    come = changes.select(*KEYS, F.lit(1).alias("sign"), "tokens")
    signed = gone.unionByName(come).where("tokenizer is not null and tokens is not null")
    return (signed.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("documents"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"))
            .where("documents <> 0 or tokens <> 0"))


class Ledger:
    """The committed deltas under ``path`` (a folder that all executors share).

    A batch's deltas are written to a folder of their own; the batch is
    committed by a marker file of its name that tells the folder, put in place by
    a rename that never overwrites.  Of two committers of one batch exactly one
    wins, and folders without a marker do not count."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _marker(self, batch: str) -> str:
        return f"{self.path}/_commits/{batch}"

    def has(self, batch: str) -> bool:
        return versions.exists(self.spark, self._marker(batch))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was there already."""
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch):
            raise ValueError("a batch id has letters, digits and hyphens")
        if self.has(batch):
            return False
        folder, draft = f"{self.path}/{batch}-{uuid.uuid4().hex}", f"{self.path}/_commits/_{uuid.uuid4().hex}"
        delta(changes).coalesce(1).write.parquet(folder)
        versions.write_file(self.spark, draft, folder)
        if versions.rename_new(self.spark, draft, self._marker(batch)):
            return True
        versions.delete(self.spark, draft)
        versions.delete(self.spark, folder)
        return False

    def totals(self) -> DataFrame:
        """Documents and tokens by key; keys without documents are left out."""
        fs, commits = versions.filesystem(self.spark, f"{self.path}/_commits")
        names = [s.getPath().getName() for s in fs.listStatus(commits)] if fs.exists(commits) else []
        folders = [versions.read_file(self.spark, self._marker(n)) for n in names if not n.startswith((".", "_"))]
        if not folders:
            return self.spark.createDataFrame([], DELTA)
        rows = self.spark.read.schema(DELTA).parquet(*folders).select(*KEYS, "documents", "tokens")
        return (rows.groupBy(*KEYS).agg(F.sum("documents").cast("long").alias("documents"), F.sum("tokens").cast("long").alias("tokens"))
                .where("documents <> 0 or tokens <> 0"))


def change(rows: DataFrame, old: tuple[str, Column] | None, new: tuple[str, Column] | None) -> DataFrame:
    """A change row per document: ``old`` and ``new`` are (tokenizer version,
    count), either may be missing."""
    def image(version, prefix):
        if version is None:
            return [F.lit(None).cast("string").alias(prefix + k) for k in KEYS] + [F.lit(None).cast("long").alias(prefix + "tokens")]
        return [F.col("source").cast("string").alias(prefix + "source"), F.col("lang").cast("string").alias(prefix + "lang"),
                F.lit(version[0]).alias(prefix + "tokenizer"), version[1].alias(prefix + "tokens")]
    return rows.select(*image(old, "old_"), *image(new, ""))
