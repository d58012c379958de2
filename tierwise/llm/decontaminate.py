"""Benchmark items inside documents, by size-partitioned containment MinHash.

A document contains an item when at least :data:`CONTAINMENT` of the item's
distinct shingles (lower-cased) occur in the document.  A shingle is five
words; an item of one to four words is one shingle of all its words, looked for
among the documents' windows of that many words, so that short items are found
inside long texts, too.

Items are partitioned by size: a class is the words of a shingle and the power
of two below the number of shingles.  An item is represented by a bottom-k
MinHash sketch, its smallest shingle hashes.  A document that contains the item
lacks at most a fifth of its shingles, so a sketch of a fifth and one more must
be hit at least once: that is the sketch, and no item is missed.  Items so large
that this would be more than :data:`SKETCH` hashes have SKETCH of them, of which
:data:`LEAST_HITS` must be hit (4 standard deviations below the expectation at
the threshold).  Each class has its own bound, the largest hash in its sketches:
a document's shingle is looked up in a class only below that bound, which falls
with the size of the items, and the share of the sketch that is found estimates
containment at any length of the document.  A single short item so costs
look-ups in its own small class only.  Candidates are then verified: the whole
shingle sets of document and item are intersected.

Classes are broadcast, smallest first, while together they have at most
:data:`BROADCAST_ROWS` sketch rows (counted); the others are shuffle joins on
(class, shingle).

Defined cases: null, blank and empty texts contain nothing and are contained in
nothing; long texts count whole; items
with a null ``item_id`` are searched for like all others, and :func:`remove`
drops what holds them, but :func:`contaminated`, which names the items, lists
none of them; repeated items and documents count once per (id, text); rows with
equal ``doc_id`` and text yield one result; empty tables give empty results;
columns beside ``doc_id``, ``item_id`` and ``text`` are not looked at, and
:func:`remove` keeps them whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm import common

CONTAINMENT = 0.8
SKETCH = 16
LEAST_HITS = 6
BROADCAST_ROWS = 1_000_000
#: Words of a shingle.
WIDTH = 5
#: :func:`remove` drops a document for an item of at least so many words
#: anywhere in it; shorter items (an "is it", a "yes") are in too many clean
#: texts and count there only as the whole text.
LEAST_WORDS_INSIDE = 3


def _windows(words: str, width: int) -> Column:
    """Hashes of the runs of ``width`` words (the column holds word hashes)."""
    run = lambda i: F.xxhash64(F.lit(width), *[F.get(words, i + k) for k in range(width)])
    return (F.when(F.size(words) >= width, F.transform(F.sequence(F.lit(0), F.size(words) - width), run))
            .otherwise(F.array().cast("array<bigint>")))


def _hashes(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` and ``w``, the hashes of the text's words."""
    step = docs.select(*keep, common.words(F.lower(F.col("text").cast("string"))).alias("_words"))
    return step.select(*step.columns[:-1], F.transform("_words", lambda w: F.xxhash64(w)).alias("w"))


def _key() -> list[Column]:
    return [F.col("doc_id"), F.xxhash64("text").alias("text_key")]


def _items(items: DataFrame) -> DataFrame:
    """Stored: ``item_id``, ``version`` (hash of the shingles), ``width``,
    ``cls`` (class), ``n`` (shingles), ``k`` (sketch size), ``need`` (hits), ``s``
    (sorted shingles)."""
    w = F.size("w")
    shingles = F.when(w >= WIDTH, _windows("w", WIDTH))
    for short in range(1, WIDTH):
        shingles = shingles.when(w == short, _windows("w", short))
    step = _hashes(items, [F.col("item_id")]).where(w > 0).select(
        "item_id", F.least(w, F.lit(WIDTH)).alias("width"), F.sort_array(F.array_distinct(shingles)).alias("s"))
    step = step.distinct().select("item_id", F.xxhash64("width", "s").alias("version"), "width", F.size("s").alias("n"), "s")
    enough = F.floor(F.col("n") * (100 - int(100 * CONTAINMENT)) / 100).cast("int") + 1
    step = step.select("*", F.least(enough, F.lit(SKETCH)).alias("k"), F.when(enough <= SKETCH, 1).otherwise(LEAST_HITS).alias("need"),
                       (F.col("width") * 100 + F.floor(F.log2("n")).cast("int")).alias("cls"))
    return common.stored(step, "items")


def _classes(items: DataFrame) -> list:
    """One row per class, at most some hundred: ``cls``, ``width``, ``rows``
    (sketch rows), ``bound``; fewest rows first."""
    return (items.groupBy("cls", "width").agg(F.sum("k").alias("rows"), F.max(F.get("s", F.col("k") - 1)).alias("bound"))
            .orderBy("rows", "cls").collect())


def _probes(docs: DataFrame, classes: list) -> DataFrame:
    """``doc_id``, ``text_key``, ``cls``, ``h``: the documents' shingles below
    the bounds of the classes."""
    step = _hashes(docs, _key())

    def below(column: Column, bound: int) -> Column:
        return F.filter(column, lambda h: h <= bound)

    def looked_up(c) -> Column:
        return F.transform(below(F.col(f"_w{c.width}"), c.bound), lambda h: F.struct(F.lit(c.cls).alias("cls"), h.alias("h")))

    bounds = {n: max(c.bound for c in classes if c.width == n) for n in sorted({c.width for c in classes})}
    step = step.select("doc_id", "text_key", *[below(_windows("w", n), bound).alias(f"_w{n}") for n, bound in bounds.items()])
    # The outer form: else Spark infers a filter that hashes every text again.
    return (step.select("doc_id", "text_key", F.explode_outer(F.concat(*map(looked_up, classes))).alias("p"))
            .where(F.col("p.h").isNotNull()).select("doc_id", "text_key", "p.cls", "p.h"))


def _found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """As :func:`contaminated`, items with a null ``item_id`` included, and
    ``width``."""
    of_item = _items(items)
    classes, held, few, many = _classes(of_item), 0, [], []
    for c in classes:
        held += c.rows
        (few if held <= BROADCAST_ROWS else many).append(c)
    sketch = of_item.select("item_id", "version", "width", "n", "need", "cls", F.explode(F.slice("s", 1, F.col("k"))).alias("h"))
    found = [_probes(docs, group).join(fit(sketch.where(F.col("cls").isin([c.cls for c in group]))), ["cls", "h"])
             for group, fit in ((few, F.broadcast), (many, lambda df: df)) if group]
    if not found:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, text_key long, item_id long, width int, n_item_shingles long, n_common long, containment double")
    hits = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    hits = (hits.groupBy("doc_id", "text_key", "item_id", "version", "width", "n", "need")
            .agg(F.count_distinct("h").alias("hits")).where(F.col("hits") >= F.col("need")))
    candidates = common.stored(hits.select("doc_id", "text_key", "item_id", "version", "width", "n"), "candidates")

    # Verification on whole shingle sets, for candidate documents only.  A
    # short item's one shingle is verified by its hit.
    short = candidates.where(F.col("width") < WIDTH).select(
        "doc_id", "text_key", "item_id", "width", F.lit(1).cast("long").alias("n_item_shingles"), F.lit(1).cast("long").alias("n_common"))
    rest = candidates.where(F.col("width") == WIDTH)
    wanted = rest.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")).distinct()
    chosen = (docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
              .join(wanted, (F.col("text_key") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi"))
    sets = _hashes(chosen, _key()).select("doc_id", "text_key", F.array_distinct(_windows("w", WIDTH)).alias("s")).distinct()
    full = of_item.where(F.col("width") == WIDTH).select("item_id", "version", F.col("s").alias("item"))
    full = common.fit_to_broadcast(full, BROADCAST_ROWS)
    pairs = (rest.alias("c")
             .join(full.alias("f"), (F.col("c.version") == F.col("f.version")) & F.col("c.item_id").eqNullSafe(F.col("f.item_id")))
             .join(sets.alias("d"), (F.col("c.text_key") == F.col("d.text_key")) & F.col("c.doc_id").eqNullSafe(F.col("d.doc_id"))))
    common_ = F.size(F.array_intersect("item", "s")).cast("long")
    whole = (pairs.select("c.doc_id", "c.text_key", "c.item_id", "c.width", F.col("n").cast("long").alias("n_item_shingles"), common_.alias("n_common"))
             .where(F.col("n_common") * 10 >= F.col("n_item_shingles") * int(CONTAINMENT * 10)))
    return whole.unionByName(short).withColumn("containment", F.col("n_common") / F.col("n_item_shingles"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text), ``item_id``,
    ``n_item_shingles``, ``n_common`` and ``containment`` of every document
    and item with containment of at least CONTAINMENT."""
    return _found(docs, items.where("item_id is not null")).drop("width")


def remove(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item (see LEAST_WORDS_INSIDE for items of
    one or two words).  Columns are those of ``docs``."""
    found = _found(docs, items).select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), "width")
    bad = found.where(F.col("width") >= LEAST_WORDS_INSIDE).select("_d", "_t")
    if found.where(F.col("width") < LEAST_WORDS_INSIDE).take(1):
        size = F.size(common.words(F.col("text").cast("string")))
        brief = docs.where(size < LEAST_WORDS_INSIDE).select(F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_t"), size.alias("size"))
        tiny = found.alias("f").join(brief.alias("b"), (F.col("f._t") == F.col("b._t")) & F.col("f._d").eqNullSafe(F.col("b._d"))
                                     & (F.col("f.width") == F.col("b.size"))).select("f._d", "f._t")
        bad = bad.unionByName(tiny)
    return common.without(docs, common.stored(bad.distinct(), "contaminated"))
