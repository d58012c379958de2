"""Near-duplicate groups by min-max hashing.

Each of 32 permutations of the shingle hashes yields two signature values,
its minimum and its maximum, so 64 values cost 32 hash evaluations per
shingle.  Four values make a band; 16 bands leave a pair at the threshold
(Jaccard 0.85) unseen with probability (1 - 0.85**4)**16 < 1e-5.

Copies are never paired off with each other:

1. Texts with the same shingle set form one class (map-side aggregation), so
   exact copies cost nothing more.
2. In each band bucket only the links to its hub are tried: the member whose
   buckets are largest in sum, which in a family of edited copies is the
   text they were edited from.  Links are confirmed on the full shingle sets.
3. What a hub leaves unlinked may still link with another member.  Members
   near the hub (Jaccard 0.5 on) are compared by what sets them apart from it:
   if a and b link but a does not link to the hub, their differences from the
   hub must overlap by a bound that follows from the sizes, so an index on the
   rarest differences (a prefix filter) puts every such pair into a bucket, and
   the edits that a text alone has, most of them, meet nothing.  Members far
   from the hub (below 0.65) meet under a finer banding within the hub's family
   (72 bands of 12 values from 432 permutations; a pair at the threshold is
   missed with probability 2e-5).  By the triangle inequality every pair falls
   under one of the two.
4. In these buckets only members of different components matter.  A bucket
   whose members are all of one component is done.  In each other bucket one
   member, of the component that has the fewest there, is compared with the
   members of the other components, and is done with that bucket; components
   that link are merged, and the next round takes the next member.  Copies of a
   variant far from the hub so become one component in the first round.  After
   :data:`PIVOTS` rounds, or before if the buckets hold no more pairs than they
   held members at first, the pairs across components that are still open are
   compared outright.  Members that merely share a difference are told apart
   before: each carries a sketch of its differences, and two sketches differ in
   at most as many bits as the texts differ in shingles.  All links are confirmed
   on full sets, and none is lost: every pair of a bucket is compared, is in one
   component already or differs by more than a link may.

Components come from alternating large-star / small-star rounds on stored
edge tables.

Defined cases: null, blank and empty texts have no shingles, link with
nothing and stay; one to four words are one shingle; repeated rows are one
class, of which ``deduplicate`` keeps one row; a null ``doc_id`` orders last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.llm import common

PERMUTATIONS, ROWS = 32, 4
FINE_PERMUTATIONS, FINE_ROWS = 432, 12
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Members are indexed by their differences from this similarity to the hub
#: on, and by the finer banding below that one (15 points are the distance of a link).
NEAR_PERCENT, FAR_PERCENT = 50, 65
#: Rounds in which a bucket's members are compared with one of them.
PIVOTS = 3
#: Shingle hashes that a task keeps while it confirms links (32 MB).
HELD = 4_000_000
#: Rows of a plain join whose work a compared pair of texts is worth.
PAIR_ROWS = 10
#: Tasks that write the bits of picked rows.
PICK_TASKS = 8
#: Words of 64 bits in a sketch of a member's differences from its hub.
SKETCH = 8


def _seeds(count: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.arange(1, count + 1, dtype=np.uint64) + np.uint64(salt << 20)
    return common.mix(ids * np.uint64(0x9E3779B97F4A7C15)), common.mix(ids * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def band_keys(shingles: np.ndarray, bounds: np.ndarray, permutations: int, rows: int, salt: int) -> np.ndarray:
    """One key per band and text, of shape (texts, bands); every text must
    have a shingle."""
    xor, times = _seeds(permutations, salt)
    at = bounds[:-1]
    low = np.empty((permutations, len(at)), np.uint64)
    high = np.empty_like(low)
    step = max(1, common.PIECE // max(1, len(shingles)))
    for p in range(0, permutations, step):
        seen = (shingles ^ xor[p:p + step, None]) * times[p:p + step, None]
        low[p:p + step] = np.minimum.reduceat(seen, at, axis=1)
        high[p:p + step] = np.maximum.reduceat(seen, at, axis=1)
    bands = np.arange(2 * permutations // rows)
    keys = np.repeat((bands + 1 + (salt << 12)).astype(np.uint64)[:, None], len(at), axis=1)
    for r in range(rows // 2):
        # The minima of some permutations with the maxima of others.
        keys = common.mix(keys * np.uint64(0x9E3779B97F4A7C15) + low[(bands + r * len(bands)) % permutations])
        keys = common.mix(keys * np.uint64(0x9E3779B97F4A7C15)
                          + high[(bands + r * len(bands) + len(bands) // 2 + 1) % permutations])
    return np.ascontiguousarray(keys.T)


def _signatures(batches):
    """Append set size, class and band keys to rows, in place of their ``text``."""
    for batch in batches:
        text = batch.column("text")
        kept = [c for c in batch.schema.names if c != "text"]
        sizes = np.zeros(len(text), np.int64)
        classes: list[bytes | None] = [None] * len(text)
        bands: list[np.ndarray | None] = [None] * len(text)
        for first, last, hashes, bounds in common.hash_words(text):
            sh, sb = common.shingle_hashes(hashes, bounds)
            has = np.flatnonzero(np.diff(sb))
            if not len(has):
                continue
            keys = band_keys(sh, np.append(sb[has], sb[-1]), PERMUTATIONS, ROWS, 1)
            for k, d in enumerate(has):
                own = np.unique(sh[sb[d]:sb[d + 1]])
                sizes[first + d] = len(own)
                classes[first + d] = np.array(
                    [common.mix(own + np.uint64(7)).sum(dtype=np.uint64), (own * own + own).sum(dtype=np.uint64)]).tobytes()
                bands[first + d] = keys[k].view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(sizes), pa.array(classes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=[*kept, "n_shingles", "cls", "bands"])


def _fine_bands(batches):
    for batch in batches:
        keys = []
        for text in batch.column("text"):
            own = common.shingle_set(text.as_py())
            keys.append(band_keys(own, np.array([0, len(own)]), FINE_PERMUTATIONS, FINE_ROWS, 2)[0].view(np.int64))
        if keys:
            at = pa.array(np.repeat(np.arange(len(keys)), len(keys[0])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(at) for c in ("row", "n_shingles")] + [pa.array(np.concatenate(keys))],
                names=["row", "n_shingles", "key"])


def _sketch(apart: np.ndarray) -> np.ndarray:
    """The parity, bit by bit, of the hashes that fall on it: what two sets have
    in common cancels out, so their sketches differ in at most as many bits as
    the sets in elements."""
    out = np.zeros(SKETCH, np.uint64)
    bit = common.mix(apart) >> np.uint64(7)
    np.bitwise_xor.at(out, (bit >> np.uint64(6)).astype(np.int64) % SKETCH, np.uint64(1) << (bit & np.uint64(63)))
    return out


def _compare(batches):
    """(a, b, ..., text_a, text_b) -> (a, b, ..., sizes, intersection, differences,
    their sketch): the signed hashes by which b differs from a, if they are near."""
    sets: dict[int, np.ndarray] = {}
    held = 0

    def of(row: int, text: str) -> np.ndarray:
        # Recent sets are kept, up to HELD hashes of them (the oldest go).
        nonlocal held
        own = sets.get(row)
        if own is None:
            own = sets[row] = common.shingle_set(text)
            held += len(own)
            while held > HELD and len(sets) > 2:
                held -= len(sets.pop(next(iter(sets))))
        return own

    for batch in batches:
        sizes_a, sizes_b, both, apart, sketches = [], [], [], [], []
        for a, b, ta, tb in zip(*(batch.column(c) for c in ("a", "b", "text_a", "text_b"))):
            left, right = of(a.as_py(), ta.as_py()), of(b.as_py(), tb.as_py())
            at = np.searchsorted(left, right)
            inside = left[np.minimum(at, len(left) - 1)] == right
            n = int(inside.sum())
            sizes_a.append(len(left))
            sizes_b.append(len(right))
            both.append(n)
            if 100 * n >= NEAR_PERCENT * (len(left) + len(right) - n):
                gone = np.ones(len(left), bool)
                gone[at[inside]] = False
                own = np.concatenate([left[gone], common.mix(right[~inside])])
                apart.append(own.view(np.int64))
                sketches.append(_sketch(own).view(np.int64))
            else:
                apart.append(np.empty(0, np.int64))
                sketches.append(None)
        kept = [c for c in batch.schema.names if c not in ("text_a", "text_b")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), *(pa.array(x, pa.int64()) for x in (sizes_a, sizes_b, both)),
             pa.array(apart, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
            names=[*kept, "na", "nb", "n", "apart", "sketch"])


def _links(batches):
    """The components ``(ca, cb)`` of the members of linked pairs."""
    for batch in _compare(batches):
        na, nb, n = (batch.column(c).to_numpy() for c in ("na", "nb", "n"))
        yield batch.select(["ca", "cb"]).filter(pa.array(100 * n >= PERCENT * (na + nb - n)))


def _compared(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs ``(a, b)`` of classes with the sizes of their full shingle
    sets, the intersection and the differences."""
    return common.stored(_with_texts(pairs, texts).mapInArrow(
        _compare, "a long, b long, na long, nb long, n long, apart array<bigint>, sketch array<bigint>"), name)


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a = texts.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(b, "b").join(a, "a").select(*pairs.columns, "text_a", "text_b")


def _similar(percent: int) -> Column:
    return 100 * F.col("n") >= percent * (F.col("na") + F.col("nb") - F.col("n"))


def _by_difference(seen: DataFrame, hubs: int) -> DataFrame:
    """Buckets (``key`` and :data:`MEMBER`) of members near a common hub that may
    link though one of them does not link to the hub.

    With sizes x, y, h and differences from the hub dx, dy, a link of x and y
    needs an overlap of at least (dx + dy - S) / 2 of the differences, where
    S = 15 (x + y) / 185; not linking to the hub means dx > 15 (x + h) / 185.
    As dy is at least dx - S, the overlap is at least dx - S too.  So x, not
    linked to the hub, and y meet in a bucket in which y is ``half``.
    ``hubs``: their number, or more.
    """
    gap = 100 - PERCENT
    whole = 100 + PERCENT
    near = seen.where(_similar(NEAR_PERCENT)).select(
        "a", "b", "na", "nb", (F.col("na") + F.col("nb") - 2 * F.col("n")).alias("d"), _similar(PERCENT).alias("linked"), "apart", "sketch")
    open_ = common.stored(common.few(near.where("not linked").select("a").distinct(), hubs), "open-hubs")
    near = near.join(common.fit_to_broadcast(open_, common.DROP_ROWS), "a", "left_semi")
    each = near.select("a", "b", F.explode("apart").alias("e"))
    shared = each.groupBy("a", "e").agg(F.count("*").alias("f")).where("f > 1")
    member = Window.partitionBy("a", "b")
    # Differences that no other member has come first and need no rows.
    placed = (each.join(shared, ["a", "e"])
              .select("a", "b", "e", (F.row_number().over(member.orderBy("f", "e")) - F.count("*").over(member)).alias("from_end"))
              .join(near.drop("apart"), ["a", "b"]).withColumn("place", F.col("from_end") + F.col("d")))
    limit = F.floor(gap * (F.col("nb") + F.col("nb") * 100 / PERCENT) / whole) + 1
    least = F.greatest(F.lit(1), F.ceil((F.col("d") + gap * (F.col("na") - F.col("nb")) / whole) / 2 - 1e-9))
    half = F.col("place") <= F.col("d") - least + 1
    kept = placed.where((F.col("place") <= limit) & (half | ~F.col("linked")))
    return kept.select(F.xxhash64("a", "e").alias("key"), "b", "nb", "d", "linked", half.alias("half"), "sketch")


def _by_fine_bands(seen: DataFrame, texts: DataFrame) -> DataFrame:
    """Buckets, as above, of members far from a common hub that share a fine
    band."""
    far = seen.where(~_similar(FAR_PERCENT)).select("a", "b")
    several = far.groupBy("a").count().where("count > 1").select("a")
    far = far.join(several, "a", "left_semi")
    mine = (common.spread(_picked(texts, far.select(F.col("b").alias("row"))).select("row", "n_shingles", "text"), "row")
            .mapInArrow(_fine_bands, "row long, n_shingles long, key long"))
    return far.withColumnRenamed("b", "row").join(mine, "row").select(
        F.xxhash64("a", "key").alias("key"), F.col("row").alias("b"), F.col("n_shingles").alias("nb"),
        F.lit(None).cast("long").alias("d"), F.lit(False).alias("linked"), F.lit(True).alias("half"),
        F.lit(None).cast("array<bigint>").alias("sketch"))


#: What a bucket holds of a member: class, size, distance from the hub, whether
#: it links to the hub, on which side of a pair it may be, and its sketch.
MEMBER = ("b", "nb", "d", "linked", "half", "sketch")


def _may_link(x: str, y: str) -> Column:
    """Whether two members of a bucket may link, by its rule, their sizes and
    their sketches."""
    meet = lambda u, v: ~F.col(f"{u}.linked") & F.col(f"{v}.half")
    # Two texts differ by at least what their distances from the hub differ by.
    apart = F.coalesce(F.abs(F.col(f"{x}.d") - F.col(f"{y}.d")), F.lit(0))
    bits = [F.bit_count(F.col(f"{x}.sketch")[i].bitwiseXOR(F.col(f"{y}.sketch")[i])) for i in range(SKETCH)]
    apart = F.greatest(apart, F.coalesce(sum(bits[1:], bits[0]), F.lit(0)))
    return ((meet(x, y) | meet(y, x))
            & ((100 + PERCENT) * apart <= (100 - PERCENT) * (F.col(f"{x}.nb") + F.col(f"{y}.nb")))
            & (100 * F.least(f"{x}.nb", f"{y}.nb") >= PERCENT * F.greatest(f"{x}.nb", f"{y}.nb")))


def _resolve(buckets: DataFrame, texts: DataFrame, comp: DataFrame) -> list[DataFrame]:
    """The components (``comp``) that components (``node``) of a bucket's members
    become by links, round by round (see 4. above)."""
    found, most = [], None
    now = common.stored(buckets.join(comp, F.col("b") == F.col("node"), "left")
                        .select("key", *MEMBER, F.coalesce("comp", "b").alias("comp")), "buckets")
    size = now.count()
    for turn in range(PIVOTS + 1):
        # A pair needs one that is not linked to the hub and one that is half.
        u, h = F.when(~F.col("linked"), F.col("comp")), F.when(F.col("half"), F.col("comp"))
        split = (now.groupBy("key").agg(F.min(u).alias("u0"), F.max(u).alias("u1"), F.min(h).alias("h0"), F.max(h).alias("h1"),
                                        F.count("*").alias("in_all"))
                 .where("u0 <> h1 or u1 <> h0").select("key", "in_all"))
        members = common.stored(common.few(now.join(split, "key"), size), "open-buckets")
        rows, open_pairs = members.agg(F.count("*"), F.sum((F.col("in_all") - 1) / 2)).first()
        if not rows:
            break
        last = turn == PIVOTS or most is not None and open_pairs <= most
        most = most or rows
        x = members.alias("x")
        if not last:
            seen = members.groupBy("key", "comp").agg(F.count("*").alias("n"), F.min(F.struct(*MEMBER)).alias("p"))
            pivot = common.stored(common.few(common.few(seen, rows).groupBy("key").agg(F.min(F.struct("n", "comp", "p")).alias("q"))
                                             .select("key", "q.comp", "q.p.*"), rows), "pivots")
            y = pivot.alias("y")
            pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp")) & _may_link("x", "y"))
        else:
            y = members.alias("y")
            pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") < F.col("y.comp")) & _may_link("x", "y"))
        # Links are told by the components that they join.
        pairs = pairs.select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b"),
                             F.least("x.comp", "y.comp").alias("ca"), F.greatest("x.comp", "y.comp").alias("cb"))
        pairs = common.stored(common.few(common.few(pairs, rows).distinct(), rows), "open-pairs")
        linked, compared = False, pairs.count()
        if compared:
            # Of all texts, only those of open pairs are shuffled to them.
            some = _picked(texts, pairs.select(F.explode(F.array("a", "b")).alias("row")))
            texts_of = common.few(_with_texts(pairs, some), PAIR_ROWS * compared)
            links = common.stored(texts_of.mapInArrow(_links, "ca long, cb long"), "more_links")
            linked = links.count() > 0
        if linked:
            found.append(components(links.toDF("a", "b")))
        if last:
            break
        now = members.join(pivot.select("key", "b"), ["key", "b"], "left_anti")
        if linked:
            now = _merged(now, found[-1])
        now, size = common.stored(common.few(now.select("key", *MEMBER, "comp"), rows), "buckets"), rows
        common.drop_stored(members, pivot, pairs)
    return found


def _merged(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` with the component that their ``comp`` has become."""
    into = comp.select(F.col("node").alias("comp"), F.col("comp").alias("into"))
    return rows.join(into, "comp", "left").withColumn("comp", F.coalesce("into", "comp")).drop("into")


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of undirected edges ``(a, b)``: comp is
    the smallest node of its component.  Alternates large-star and small-star
    rounds until all are stars: no node has two centres or is one as well.
    Joins are merges: small tables would each be a broadcast through the driver
    in every round.  Small tables go through few tasks (see :func:`common.few`)."""
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rows = edges.count()
    edges = common.few(edges.distinct(), rows)
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")).toDF("a", "b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = common.few(common.few(large, rows).distinct(), rows)
        # large: (a, b) with b < a; every node points at smaller ones.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low.hint("merge"), "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                                           F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e"))
                 .select(F.col("e.y").alias("a"), F.col("e.x").alias("b")).where("a <> b"))
        edges = common.stored(common.few(common.few(small, rows).distinct(), rows), "stars")
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("end")),
                                              F.struct(F.col("b").alias("node"), F.lit(1).alias("end")))).alias("e"))
        both_ways = (F.sum("e.end") > 1) | (F.max("e.end") > F.min("e.end"))
        nodes = common.few(ends.groupBy("e.node").agg(both_ways.alias("more"), F.sum("e.end").alias("edges")), rows)
        more, rows = nodes.agg(F.max("more"), F.sum("edges")).first()
        if not more:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("comp")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct())


def _signed(docs: DataFrame) -> DataFrame:
    """Stored rows: the columns of ``docs`` as c0, c1, ..., the ``doc_id`` and
    ``text`` among them, a unique ``row``, and what :func:`_signatures` appends."""
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)],
                        F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    schema = T.StructType([*plain.drop("text").schema.fields, T.StructField("n_shingles", T.LongType()),
                           T.StructField("cls", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    rows = common.stored(plain.mapInArrow(_signatures, schema), "signatures")
    of = docs.columns if {"doc_id", "text"} <= set(docs.columns) else [c.lower() for c in docs.columns]
    return rows.withColumns({"doc_id": F.col(f"c{of.index('doc_id')}").cast("long"),
                             "text": F.col(f"c{of.index('text')}").cast("string")})


def _picked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The stored signature rows whose ``row`` is one of ``ids``.  Rows are
    numbered on end within a task, so 64 of them are one number with a bit for
    each: as long as these are few enough to broadcast (32 million documents),
    no text is shuffled."""
    at = F.col("row").bitwiseAND(63).cast("int")
    some = common.stored(ids.groupBy(F.shiftright("row", 6).alias("_w"))
                         .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at)).alias("_bits")).coalesce(PICK_TASKS), "picked")
    some = common.fit_to_broadcast(some, common.DROP_ROWS)
    return rows.join(some, (F.shiftright("row", 6) == F.col("_w")) & (F.getbit("_bits", at) == 1), "left_semi")


def _groups(rows: DataFrame) -> DataFrame:
    """``(cls, first)`` for all classes of the stored signature rows: first is
    the struct (doc_id is null, doc_id, row) of the group's first document."""
    classes = common.stored(
        rows.where("n_shingles > 0").groupBy("cls")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("label"),
             F.max("bands").alias("bands"))
        .withColumn("row", F.col("label.row")),
        "classes")
    # From here on a class is told by the row of its first document.
    keyed = classes.select("row", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = common.stored(keyed.join(shared, "key"), "buckets")
    weight = members.groupBy("row").agg(F.sum("n").alias("w"))
    hubs = (members.select("key", "row").join(weight, "row").groupBy("key")
            .agg(F.max(F.struct("w", "row")).alias("h")).select("key", F.col("h.row").alias("a")))
    pairs = common.stored(members.join(hubs, "key").where("a <> row").select("a", F.col("row").alias("b")).distinct(), "pairs")
    texts = common.stored(_picked(rows, members.select("row")).select("row", "n_shingles", "text"), "texts")
    seen = _compared(pairs, texts, "links")
    edges = seen.where(_similar(PERCENT)).select("a", "b")
    first = common.stored(components(edges), "components")
    of = classes.select("cls", "label", "row").join(first, F.col("row") == F.col("node"), "left").select(
        "cls", "label", F.coalesce("comp", "row").alias("comp"))
    for comp in _resolve(_by_difference(seen, pairs.count()).unionByName(_by_fine_bands(seen, texts)), texts, first):
        of = _merged(of, comp)
    least = of.groupBy("comp").agg(F.min("label").alias("first"))
    groups = common.stored(of.join(least, "comp").select("cls", "first"), "groups")
    common.drop_stored(classes, members, pairs, texts, seen)
    return groups


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` (distinct), the
    smallest ``doc_id`` of its group as ``component_id``, and ``kept``: whether
    it is that document."""
    rows = _signed(docs.select("doc_id", "text"))
    out = rows.select("doc_id", "n_shingles", "cls").join(_groups(rows), "cls", "left")
    comp = F.when(F.col("n_shingles") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents with one of each group: the row with the smallest
    ``doc_id`` (one of them, if rows repeat).  Documents without words stay.
    Columns are those of ``docs``."""
    rows = _signed(docs)
    firsts = _groups(rows).select(F.col("first.row").alias("row"))
    kept = _picked(rows.where("n_shingles > 0"), firsts).unionByName(rows.where("n_shingles = 0"))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
