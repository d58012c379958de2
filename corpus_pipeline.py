"""Corpus pipeline: documents -> quality rules -> line dedup -> near-duplicate
removal -> benchmark decontamination -> mixing.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps
(the last one: the mix).  :func:`run` writes each stage's result as Parquet to
the shared folder and reads it back as the next one's input.  A stage first
removes the tables that the stages before it stored on their way, but for any
that its input still reads, so that the disk holds one stage's tables at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import decontaminate, line_dedup, near_dup, quality_rules, source_mix
from tierwise.llm.common import drop_paths, drop_stored, recording, stored, table


#: Paths of the tables that the stages so far have stored.
_stored: list[str] = []


def stage(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @functools.wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_paths(spark, _stored, docs)
        with recording(_stored):
            return step(spark, docs, sf_dir)
    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality_rules.good(docs)


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages that occur earlier in the corpus."""
    return line_dedup.clean(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dup.deduplicate(docs)


@stage
def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that contain no benchmark item."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents in order of virtual finish time, with how many
    copies of each are taken."""
    return source_mix.mixture(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmarks),
    ("source_mix", mixing),
]

#: Quality rules (expectation-maximisation) and near-duplicate groups are not
#: expressible as one SQL statement; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        out = stored(step(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_stored(before)
        docs = before = out
    return docs
