"""Repeated passages: content-defined chunks of lines, each kept once.

A text is cut into chunks of whole lines.  A chunk ends after a line where a
rolling hash over the hashes of that line and the one before is 0 modulo
:data:`DIVISOR`, so edits elsewhere do not move the boundaries of an equal
passage.  A line of :data:`LONG_WORDS` words or more is a passage by itself:
chunks also end before and after it.  Chunks of several lines, and long
lines, that occur more than once in the corpus are removed everywhere but at
their first place (smallest ``doc_id``, then position).

Only (hash, length) pairs are shuffled to find repeats; the text of repeats
is then compared byte for byte (it alone is shuffled while the repeated
hashes are few enough to broadcast).  A chunk that holds a third of all rows
is reduced map-side.

Chunks lose the head of a passage and passages that make no chunk, so
:func:`remove_runs`, which the pipeline applies first, removes every run of
whole lines of more than :data:`RUN_WORDS` words that occurs earlier, whatever
chunks it falls into.  A run has more words than that exactly if it is made up of the
shortest such runs beginning and ending at its lines; these are at most two a
line, and equal ones are found by one grouping on a 128-bit hash (two
differently seeded xxhash64; texts are not compared).  Lines without words do
not count; those inside a removed run go with it.  A run that overlaps its own
first occurrence in the same document stays.  Lines that come together only by
a removal are not looked at again.

Defined cases: a null text stays null; blank chunks and short single lines
are never removed; a text whose every chunk is removed becomes empty (``clean``
then drops its document); rows with equal ``doc_id`` and text are one document and share one
decision; a null ``doc_id`` orders last; extra columns of any name come back as
they were, and a result column whose name is taken gets a ``_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm import common

DIVISOR = 3
MIN_LINES = 2
LONG_WORDS = 50
#: Runs of lines with more words than this are passages, chunks or not.
RUN_WORDS = 50
#: Repeated hashes, and documents that lose passages, are broadcast up to so
#: many rows (some 50 MB), else joined by shuffles.
BROADCAST_ROWS = 500_000


def _key() -> Column:
    """What tells documents apart, in the order in which the first is kept."""
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text"))


def _is_long(line: Column) -> Column:
    """At least LONG_WORDS words; the cheap count of blanks decides most."""
    blanks = F.length(line) >= 2 * LONG_WORDS - 1
    return blanks & (F.size(common.words(line)) >= LONG_WORDS)


def _chunked(docs: DataFrame) -> DataFrame:
    """``key`` and ``chunks`` (array of text, lines, long) next to the columns
    (which are the caller's own choice: _passages, dedup_lines)."""
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    step = docs.select("*", lines.alias("_lines"))
    step = step.select("*", F.transform("_lines", lambda l: F.struct(F.md5(l).alias("h"), _is_long(l).alias("long"))).alias("_marks"))
    rolled = lambda i: F.conv(F.substring(F.md5(F.concat(F.get("_marks", i - 1)["h"], F.get("_marks", i)["h"])), 1, 8), 16, 10).cast("long")

    def begins(i: Column) -> Column:
        return ((i == 0) | F.get("_marks", i)["long"] | F.get("_marks", i - 1)["long"]
                | F.coalesce(rolled(i - 1) % DIVISOR == 0, F.lit(False)))

    step = step.select("*", F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), begins).alias("_starts"))

    def chunk(start: Column, k: Column) -> Column:
        count = F.coalesce(F.get("_starts", k + 1), F.size("_lines")) - start
        text = F.array_join(F.slice("_lines", start + 1, count), "\n")
        return F.struct(text.alias("text"), count.alias("lines"), F.get("_marks", start)["long"].alias("long"))

    return step.select(_key().alias("key"), *docs.columns, F.size("_lines").alias("n_lines"),
                       F.transform("_starts", chunk).alias("chunks"))


def _passages(docs: DataFrame) -> DataFrame:
    """The chunks that may be removed: ``key``, ``at``, ``text``, ``lines``."""
    # The outer form: else Spark infers a filter that cuts every text again.
    out = _chunked(docs.select("doc_id", "text")).select("key", F.posexplode_outer("chunks").alias("at", "c"))
    return (out.select("key", "at", "c.text", "c.lines", "c.long")
            .where(((F.col("lines") >= MIN_LINES) | F.col("long")) & (F.btrim("text", F.lit(common.BLANKS)) != ""))
            .select("key", "at", "text", "lines"))


def repeats(docs: DataFrame) -> DataFrame:
    """The places to remove, one row per document: ``key``, ``drop`` (places)."""
    marked = _passages(docs).select("key", "at", "text", "lines", F.xxhash64("text").alias("h"), F.octet_length("text").alias("len"))
    found = common.stored(
        marked.groupBy("h", "len").agg(F.min(F.struct("key", "at")).alias("lo"), F.max(F.struct("key", "at")).alias("hi"))
        .where("lo <> hi").select("h", "len"), "repeats")
    again = common.stored(marked.join(common.fit_to_broadcast(found, BROADCAST_ROWS), ["h", "len"]), "passages")
    # Byte comparison: the text itself is the grouping key.
    first = again.groupBy("h", "len", "text").agg(F.min(F.struct("key", "at")).alias("first"))
    later = (again.alias("a").join(first.alias("f"), (F.col("a.h") == F.col("f.h")) & (F.col("a.len") == F.col("f.len"))
                                   & (F.col("a.text") == F.col("f.text")))
             .where(F.struct("a.key", "a.at") != F.col("f.first")).select("a.key", "a.at"))
    return later.groupBy("key").agg(F.collect_set("at").alias("drop"))


def _with_places(docs: DataFrame, places: DataFrame) -> DataFrame:
    """One struct ``_row`` of the columns of ``docs`` but the text (so that none
    can clash), ``doc_id``, ``text`` and ``_drop``, what ``places`` (stored: key, drop) holds
    for the document."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row"),
                        F.col("doc_id"), F.col("text").cast("string").alias("text"))
    on = F.xxhash64("_key")
    places = common.fit_to_broadcast(places.select(F.col("key").alias("_key"), "drop"), BROADCAST_ROWS)
    return (whole.withColumn("_key", _key()).withColumn("_on", on).alias("w")
            .join(places.withColumn("_on", on).alias("p"),
                  (F.col("w._on") == F.col("p._on")) & F.col("w._key").eqNullSafe(F.col("p._key")), "left")
            .select("w._row", "w.doc_id", "w.text", F.col("p.drop").alias("_drop")))


def _columns(docs: DataFrame, cut: DataFrame, text: Column, lines: Column, removed: Column) -> DataFrame:
    """The columns of ``docs`` with another text, and the two counts.  Two
    steps: within one, a caller's column could stand in for ours."""
    step = cut.select("_row", text.alias("_text"), lines.alias("_n_lines"), removed.alias("_n_removed"))
    names = [F.col("_text").alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns]
    return step.select(*names, F.col("_n_lines").alias(common.fresh(docs, "n_lines")),
                       F.col("_n_removed").alias(common.fresh(docs, "n_removed")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text``, plus
    ``n_lines`` (before) and ``n_removed`` (lines)."""
    places = common.stored(repeats(docs).select("key", F.sort_array("drop").alias("drop")), "places")
    joined = _with_places(docs, places)
    # Only documents that lose something are cut again.
    cut = _chunked(joined.select("_row", "_drop", "doc_id", F.when(F.col("_drop").isNotNull(), F.col("text")).alias("text"),
                                 F.col("text").alias("_text")))
    left = F.filter("chunks", lambda c, i: ~F.array_contains("_drop", i))
    gone = F.aggregate(F.filter("chunks", lambda c, i: F.array_contains("_drop", i)), F.lit(0), lambda s, c: s + c["lines"])
    text = F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(left, lambda c: c["text"]), "\n"))
    lines = F.when(F.col("_text").isNull(), 0).otherwise(F.size(F.split(F.col("_text"), "\n")))
    return _columns(docs, cut, text, lines, F.when(F.col("_drop").isNull(), 0).otherwise(gone))


def _run_places(docs: DataFrame) -> DataFrame:
    """``key`` and ``runs`` of every document: the shortest runs of whole lines
    with more than RUN_WORDS words that begin, and that end, at each line, as
    (first, last, a, b): line numbers and a 128-bit hash of the lines."""
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    line = lambda l, i: F.struct(i.alias("at"), F.size(common.words(l)).alias("c"), F.xxhash64(l).alias("a"),
                                 F.xxhash64(F.lit(1), l).alias("b"))
    step = docs.select(_key().alias("key"), F.filter(F.transform(lines, line), lambda x: x["c"] > 0).alias("_lines"))

    def reach(near: Column) -> Column:
        """How many of these lines have more than RUN_WORDS words; 0: all have not."""
        zero = F.struct(F.lit(0).alias("s"), F.lit(0).alias("n"))
        more = lambda m, x: F.when(m["s"] > RUN_WORDS, m).otherwise(
            F.struct((m["s"] + x["c"]).alias("s"), (m["n"] + 1).alias("n")))
        return F.aggregate(near, zero, more, lambda m: F.when(m["s"] > RUN_WORDS, m["n"]).otherwise(0))

    # Every line counted has a word, so that a run has at most RUN_WORDS + 1.
    begins = F.transform("_lines", lambda x, k: F.struct(k.alias("k"), reach(F.slice("_lines", k + 1, RUN_WORDS + 1)).alias("n")))
    back = lambda k: F.reverse(F.slice("_lines", F.greatest(k - RUN_WORDS, F.lit(0)) + 1, F.least(k, F.lit(RUN_WORDS)) + 1))
    ends = F.transform(F.transform("_lines", lambda x, k: F.struct(k.alias("k"), reach(back(k)).alias("n"))),
                       lambda e: F.struct((e["k"] - e["n"] + 1).alias("k"), e["n"].alias("n")))
    step = step.select("key", "_lines", F.array_distinct(F.filter(F.concat(begins, ends), lambda r: r["n"] > 0)).alias("_spans"))

    def run(r: Column) -> Column:
        own = F.slice("_lines", r["k"] + 1, r["n"])
        return F.struct(F.get("_lines", r["k"])["at"].alias("first"), F.get("_lines", r["k"] + r["n"] - 1)["at"].alias("last"),
                        F.xxhash64(F.transform(own, lambda x: x["a"])).alias("a"),
                        F.xxhash64(F.lit(1), F.transform(own, lambda x: x["b"])).alias("b"))

    return step.select("key", F.transform("_spans", run).alias("runs"))


def repeated_runs(docs: DataFrame) -> DataFrame:
    """The lines to remove, one row per document: ``key``, ``drop``."""
    places = common.stored(_run_places(docs.select("doc_id", "text")), "runs")
    rows = places.select("key", F.explode("runs").alias("r")).select("key", "r.*")
    place = F.xxhash64("key", "first")
    found = common.stored(rows.groupBy("a", "b").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
                          .where("lo <> hi").select("a", "b"), "repeated-runs")
    again = rows.join(common.fit_to_broadcast(found, BROADCAST_ROWS), ["a", "b"])
    first = common.stored(again.groupBy("a", "b").agg(F.min(F.struct("key", "first", "last")).alias("kept")), "first-runs")
    later = (again.join(common.fit_to_broadcast(first, BROADCAST_ROWS), ["a", "b"])
             .where(~F.col("key").eqNullSafe(F.col("kept.key")) | (F.col("first") > F.col("kept.last"))))
    return (later.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
            .select("key", F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"])))).alias("drop")))


def remove_runs(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines of every run of more than RUN_WORDS words
    that occurs earlier, plus ``n_lines`` (before) and ``n_removed``."""
    places = common.stored(repeated_runs(docs).select("key", "drop"), "run-lines")
    cut = _with_places(docs, places).select("*", F.split("text", "\n").alias("_lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    text = F.when(F.col("_drop").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n"))
    return _columns(docs, cut, text, F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")),
                    F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")))


def clean(docs: DataFrame) -> DataFrame:
    """The documents without their repeated runs, then without the repeated
    chunks of what is left; documents of which nothing but blanks is left go.
    Columns are those of ``docs``."""
    whole = remove_runs(docs)
    out = dedup_lines(whole)
    removed, row = F.col(whole.columns[-1]) + F.col(out.columns[-1]), common.fresh(out, "row")
    # The row number keeps Spark from moving the filter, and with it copies of
    # all that it is computed from, below the cutting.
    return (out.withColumn(row, F.monotonically_increasing_id())
            .where((F.col(row) >= 0) & ((removed == 0) | (F.btrim("text", F.lit(common.BLANKS)) != "")))
            .select(*docs.columns))
