"""Aggregates over a parent LEFT JOIN child fan-out, without the fan-out.

Several gold models group ``parent LEFT JOIN child ON key`` by a parent
attribute and aggregate *after* the join, so a parent row with n children
counts n times (and once when it has none).  Doing that join literally
sends every child row through a shuffle keyed by the join key; a hot key
(one contract holding a third of all change orders) lands in one task.

The same numbers come out of two skew-free pieces:

1. :func:`child_rollup` - the children pre-aggregated per key (partial
   aggregation absorbs any hot key map-side), giving one row per key with
   the child count ``_n`` and the child sums.  Joined 1:1 onto the parents,
   a parent measure summed over the fan-out is ``measure * max(_n, 1)``
   (:func:`fanout_weight`) and a child sum over the fan-out is the sum of
   the per-key sums.
2. :func:`distinct_children_per_group` - ``COUNT(DISTINCT child_id)`` per
   group needs the child ids themselves; it is an *inner* join with the
   child rows on the probe side, which adaptive execution may split when a
   key is hot, followed by a two-phase distinct aggregation.

Several models use the same two pieces of the same children; a
:class:`Rollup` holds them for all (:func:`rollup`), so the children are
scanned once.

The gold oracle SQL is the literal fan-out join, so each model's parity
check also proves the rewrite exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT_N = "_n"


@dataclass(frozen=True)
class Rollup:
    """Children summed up per key.

    ``per_key``: key, ``_n`` (rows), ``sum_<column>`` of every summed column
    and ``_ids`` (rows with an id).
    ``shared``: (key, id, ``_n``) of the ids that occur more than once; an id is
    one row as a rule, so this is a small rest.  It is made when a model first
    counts ids.
    """

    key: str
    child_id: str
    per_key: DataFrame
    find_shared: Callable[[], DataFrame]

    @cached_property
    def shared(self) -> DataFrame:
        return self.find_shared()


def rollup(child: DataFrame, key: str, child_id: str, sums: list[str],
           store: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> Rollup:
    """Sums in one scan of the children; counting ids reads the (key, id) pairs.

    Map-side aggregation absorbs a hot key.  ``store`` writes a frame under a
    name and reads it back (by default nothing is stored).
    """
    per_key = store(child.groupBy(key).agg(
        F.count(F.lit(1)).alias(FANOUT_N), *[F.sum(c).alias(f"sum_{c}") for c in sums],
        F.count(child_id).alias("_ids")), "per_key")

    def find_shared() -> DataFrame:
        found = child.select(key, child_id).where(F.col(key).isNotNull() & F.col(child_id).isNotNull())
        several = store(found.groupBy(child_id).count().where("count > 1").select(child_id), "several")
        return store(found.join(several, child_id, "left_semi")
                     .groupBy(key, child_id).agg(F.count(F.lit(1)).alias(FANOUT_N)), "shared")

    return Rollup(key, child_id, per_key, find_shared)


def child_rollup(child: DataFrame | Rollup, key: str, *aggs: Column, **sums: str) -> DataFrame:
    """One row per join key: ``_n`` = number of child rows, the sum of each
    named column, e.g. ``_orig="original_amount"``, and (not of a
    :class:`Rollup`) other ``aggs``."""
    if isinstance(child, Rollup):
        return child.per_key.select(key, FANOUT_N, *[F.col(f"sum_{c}").alias(a) for a, c in sums.items()])
    return child.groupBy(key).agg(F.count(F.lit(1)).alias(FANOUT_N),
                                  *aggs, *[F.sum(c).alias(a) for a, c in sums.items()])


def fanout_weight() -> Column:
    """How many joined rows a parent row turns into: max(_n, 1)."""
    return F.greatest(F.coalesce(F.col(FANOUT_N), F.lit(1)), F.lit(1))


def weighted_count(measure: Column) -> Column:
    """Number of joined rows whose ``measure`` is not NULL."""
    return F.when(measure.isNotNull(), fanout_weight())


# Null-safe surrogate group keys.  A NULL group key is one real group; a
# null-safe join would hash by (coalesce(k, ''), isnull(k)) and re-shuffle
# both sides.  Grouping by those two columns in the first place leaves every
# per-group result hash-partitioned the same way, so re-attaching the pieces
# is a join of co-partitioned sides with no further exchange.
GK, GN = "_gk", "_gn"


def group_keys(group: str) -> list[Column]:
    c = F.col(group)
    return [F.coalesce(c.cast("string"), F.lit("")).alias(GK), c.isNull().alias(GN)]


def group_value(of: DataFrame, group: str) -> Column:
    """The original group value (of the type in ``of``) after a surrogate-keyed
    aggregate, from the keys.  Carried through the aggregate as a text it would
    make Spark sort, and maybe spill, all rows."""
    return F.when(~F.col(GN), F.col(GK)).cast(of.schema[group].dataType).alias(group)


def distinct_children_per_group(
    parent: DataFrame, child: DataFrame | Rollup, key: str, group: str, child_id: str,
    alias: str,
) -> DataFrame:
    """``COUNT(DISTINCT child.child_id)`` per ``parent.group`` over the join.

    Keyed by the surrogate group keys; only groups with at least one
    matching child appear, so callers attach the result with
    :func:`attach_by_group` and default to 0.  Of a :class:`Rollup`, the ids
    that occur once are added up, each key of a group counting once; the shared
    ids alone are counted as rows.
    """
    if isinstance(child, Rollup):
        owners = parent.select(key, group).where(F.col(key).isNotNull())
        repeated = child.shared.groupBy(key).agg(F.sum(FANOUT_N).alias("_repeated"))
        once = (child.per_key.join(repeated, key, "left")
                .select(key, (F.col("_ids") - F.coalesce("_repeated", F.lit(0))).alias("_own")))
        own = (owners.join(once, key)
               .groupBy(key, *group_keys(group)).agg(F.max("_own").alias("_own"))
               .select(GK, GN, F.col("_own").alias("_k"), F.lit(None).cast("string").alias("_id")))
        rest = (child.shared.join(owners, key)
                .select(*group_keys(group), F.lit(0).cast("long").alias("_k"), F.col(child_id).cast("string").alias("_id")))
        return (own.unionByName(rest).groupBy(GK, GN, "_id").agg(F.sum("_k").alias("_k"))
                .groupBy(GK, GN).agg((F.sum("_k") + F.count("_id")).alias(alias))
                .where(F.col(alias) > 0))
    kids = child.select(key, child_id).where(
        F.col(key).isNotNull() & F.col(child_id).isNotNull())
    owners = parent.select(key, group).where(F.col(key).isNotNull())
    return (kids.join(owners, key, "inner")
            .groupBy(*group_keys(group))
            .agg(F.countDistinct(child_id).alias(alias)))


def attach_by_group(base: DataFrame, extra: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Left-join per-group results onto ``base``; both are keyed by the
    surrogate group keys, so a NULL group matches itself."""
    out = base.join(extra, [GK, GN], "left")
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out
