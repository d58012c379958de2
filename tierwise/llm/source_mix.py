"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow; its documents queue in a shuffled order (by a hash of
``doc_id`` and text), up to ``repeats`` times over.  A document copy's virtual
finish time is the source's cumulative words up to and including it, divided
by the source's target.  The copies of all sources, sorted by finish time, are
taken while their total stays within the budget.

Cumulative sums never put a source, or the whole mix, into one task: rows are
dealt into slots of about :data:`SLOT_ROWS` rows, summed inside slots, and
shifted by the running sums over the slots' totals.  Within a source the slots
are ranges of the shuffle hash; the mix as a whole is range-sorted by finish time
(Spark samples the boundaries, so lots are of even size whatever the finish
times), and the sorted ranges, once stored, are the lots.

Targets fill up by weight ("water filling") under a cap of ``repeats`` times
a source's size.  Defined cases: null, blank and empty texts have size 0 and
are never taken; a null source is a source of its own, ordered last; repeated
rows are documents of their own; empty input gives empty output.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm import common

WEIGHTS = (3, 1, 2)
SHARE_NUM, SHARE_DEN = 3, 2
REPEATS = 2
SLOT_ROWS = 20_000


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``size`` -> ``source``, ``source_size``, ``target``.

    One row per source; the windows below run over sources, not documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cap = F.col("source_size") * REPEATS
    ranked = (per.withColumn("rank", F.row_number().over(by_name) - 1)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))))
    # Sources in the order in which they reach their cap: those before a
    # source are full, the rest share what is left by weight.
    fill = Window.orderBy(cap / F.col("weight"), "rank")
    before, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * SHARE_NUM / F.lit(SHARE_DEN)
             - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("weight").over(rest)
    found = (ranked.withColumn("level", level)
             .withColumn("level", F.when(F.col("level") * F.col("weight") <= cap, F.col("level")))
             .withColumn("level", F.max("level").over(everything)))
    return found.select("source", "source_size", F.when(
        F.col("level").isNull() | (F.col("level") * F.col("weight") > cap), cap.cast("double")).otherwise(
        F.col("level") * F.col("weight")).alias("target"))


def _running(df: DataFrame, slot: str, order: list, value: str, out: str, keys: list[str]) -> DataFrame:
    """Inclusive running sum of ``value`` within ``keys``, in the order of
    (``slot``, ``order``): sums inside slots plus the slots before."""
    inner = Window.partitionBy(*keys, slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = df.groupBy(*keys, slot).agg(F.sum(value).alias("_total"))
    ahead = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(slot).alias("_slot"),
                           F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_shift"))
    on = F.col(slot) == F.col("_slot")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return (df.withColumn(out, F.sum(value).over(inner)).join(shifts, on)
            .withColumn(out, F.col(out) + F.col("_shift")).drop("_slot", "_shift", *[f"_{k}" for k in keys]))


def mix(docs: DataFrame, row: str | None = None) -> DataFrame:
    """One row per document: ``row`` (the column of that name, else numbered),
    ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``
    (words, repeats counted) and ``finish`` (virtual finish time of its first
    copy)."""
    text = F.xxhash64("text").alias("_text")
    sized = common.stored(docs.select(
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        "doc_id", F.col("source").cast("string").alias("source"),
        F.size(common.words(F.col("text"))).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))).alias("_draw"), text), "sizes")
    goal = targets(sized.select("source", "size"))
    most = sized.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    slots = max(1, -(-most // SLOT_ROWS))
    # The slot is the draw's leading 32 bits scaled to the number of slots.
    slot = F.floor(F.conv(F.substring("_draw", 1, 8), 16, 10).cast("double") * slots / 4294967296.0)
    line = _running(sized.withColumn("_at", slot), "_at", ["_draw", "_text", "row"], "size", "_sum", ["source"])
    goal = goal.select(F.col("source").alias("_s"), "source_size", "target")
    flow = line.join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    copies = flow.where("size > 0").withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))))
    copies = copies.select("row", "doc_id", "size", "_copy", F.try_divide(
        F.col("_sum") + F.col("_copy") * F.col("source_size"), F.col("target")).alias("finish"))
    n = REPEATS * sized.where("size > 0").count()
    order = ["finish", F.col("doc_id").asc_nulls_last(), "_copy", "row"]
    copies = common.stored(copies.repartitionByRange(max(1, -(-n // SLOT_ROWS)), *order)
                           .withColumn("_lot", F.spark_partition_id()), "queue")
    total = sized.agg(F.sum("size")).first()[0] or 0
    budget = total * SHARE_NUM // SHARE_DEN
    queue = _running(copies, "_lot", order, "size", "_used", [])
    taken = (queue.where(F.col("_used") <= budget).groupBy("row")
             .agg(F.sum("size").alias("taken"), F.min("finish").alias("finish")))
    return (flow.select("row", "doc_id", "source", "size", "source_size", "target")
            .join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")))


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with an id per row in the column ``name``, the same whenever it
    is read: the place in its file, or, of rows that come from no single scan, a
    number in a stored copy."""
    if "_metadata" not in (c.lower() for c in docs.columns):
        try:
            return docs.select("*", F.struct(F.xxhash64("_metadata.file_path"), F.col("_metadata.file_size"),
                                             F.col("_metadata.row_index")).alias(name))
        except AnalysisException:
            pass  # no scan to ask
    return common.stored(docs.withColumn(name, F.monotonically_increasing_id()), "mix-documents")


def mixture(docs: DataFrame) -> DataFrame:
    """The documents of the mix in order of virtual finish time, with the
    columns of ``docs`` and ``mix_copies``, ``mix_finish``."""
    own, copies, finish = (common.fresh(docs, c) for c in ("mix_row", "mix_copies", "mix_finish"))
    kept = _numbered(docs, own)
    plan = mix(kept, own)
    plan = plan.where("taken > 0").select(
        F.col("row").alias(own), (F.col("taken") / F.col("size")).cast("int").alias(copies), F.col("finish").alias(finish))
    out = kept.join(plan, own)
    return out.repartitionByRange(F.col(finish)).sortWithinPartitions(finish, own).drop(own)
