"""Language identification: multinomial naive Bayes over hashed character
n-grams.

A text is lower-cased and every run of characters that are not letters becomes
one blank; its features are the character n-grams of 1 to :data:`LONGEST`
characters of the words with a blank on both sides, hashed into
:data:`BUCKETS` buckets.  Learning counts (language, bucket) over all labelled
rows: each task sums dense counts, Spark adds them up.  The log probabilities
(add-one smoothing; class priors from document counts) form one matrix of
buckets by languages.  It is broadcast in blocks of :data:`BLOCK` languages,
so a broadcast has at most BUCKETS x BLOCK numbers whatever the number of
languages or rows.  Scoring gathers the matrix rows of a batch's n-grams and
sums them per document in numpy.

Defined cases: a text that is null, empty or without a letter is ``und`` with
score 0 and teaches nothing; a null language teaches nothing; ties go to the
language first by code point; without any labelled letter every row is
``und``; long texts are read in pieces of :data:`PIECE` characters and count
whole; repeated rows count each time.  Extra columns, whatever their names,
come back as they were; a result column whose name is taken gets a ``_``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.llm import common

LONGEST = 4
BUCKETS = 1 << 16
BLOCK = 16
PIECE = 1 << 17
UNDETERMINED = "und"

_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters (made once in a worker)."""
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letter


def _pieces(texts: pa.Array):
    """``(rows, parts)``: consecutive texts, or parts of a long one.  A row is
    (row number, characters of context at its begin, characters at its end in
    which no n-gram begins, whether the text ends here)."""
    texts = pc.utf8_lower(texts.fill_null("").cast(pa.large_string()))
    rows, parts, held = [], [], 0
    for row, text in enumerate(texts):
        text = text.as_py()
        for at in range(0, max(len(text), 1), PIECE):
            part = text[max(at - 1, 0):at + PIECE + LONGEST]
            rest = max(len(text) - at - PIECE, 0)
            rows.append((row, int(at > 0), min(rest, LONGEST), rest <= LONGEST))
            parts.append(part)
            held += len(part)
            if held >= PIECE:
                yield rows, parts
                rows, parts, held = [], [], 0
    if rows:
        yield rows, parts


def grams(texts: pa.Array):
    """Yield ``(rows, buckets, bounds)``: part k of a run of texts belongs to
    row ``rows[k]`` and has the n-gram buckets
    ``buckets[bounds[k]:bounds[k + 1]]``."""
    letters = _letters()
    for parts, strings in _pieces(texts):
        # A blank before a text and one after it.
        framed = [("" if head else " ") + s + (" " if last else "") for s, (_, head, _, last) in zip(strings, parts)]
        sizes = np.array([len(s) for s in framed])
        raw = "".join(framed)
        codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        part = np.repeat(np.arange(len(sizes)), sizes)
        solid = letters[np.minimum(codes, 0x10FFFF)]
        codes = np.where(solid, codes, 0).astype(np.uint64)
        # Where n-grams of this part begin: not in the context of a cut.
        own = np.ones(len(codes), bool)
        for k, (_, head, tail, last) in enumerate(parts):
            own[begins[k]:begins[k] + head] = False
            if tail:
                own[begins[k + 1] - tail - last:begins[k + 1]] = False
        keep = own & solid
        found = [np.flatnonzero(keep)]
        # code + 1, so that a blank is a character of its own.
        key = codes + np.uint64(1)
        hashed = key * np.uint64(0x9E3779B97F4A7C15)
        values = [hashed[keep]]
        inner = np.ones(len(codes), bool)  # no blank strictly inside so far
        for n in range(2, LONGEST + 1):
            m = len(codes) - n + 1
            if m <= 0:
                break
            hashed = common.mix(hashed[:m]) + key[n - 1:] * np.uint64(0xC2B2AE3D27D4EB4F)
            if n > 2:
                inner = inner[:m] & solid[n - 2:n - 2 + m]
            # Single blanks do not make an n-gram: one character is a letter.
            some = solid[:m] | solid[n - 1:n - 1 + m] if n == 2 else inner[:m]
            ok = own[:m] & some & (part[:m] == part[n - 1:])
            found.append(np.flatnonzero(ok))
            values.append(hashed[ok])
        at = np.concatenate(found)
        buckets = (common.mix(np.concatenate(values)) >> np.uint64(48)).astype(np.int64) % BUCKETS
        owner = part[at]
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(sizes) + 1))
        yield np.array([p[0] for p in parts]), buckets[order], bounds


def _count(batches):
    """(lang, text) -> (lang, bucket, n); bucket -1 counts documents."""
    held: dict[str, np.ndarray] = {}

    def emitted(names):
        for name in names:
            counts = held.pop(name)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at - 1), pa.array(counts[at])],
                                             names=["lang", "bucket", "n"])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        taught = np.zeros(len(langs), bool)
        for rows, buckets, bounds in grams(batch.column("text")):
            for k, row in enumerate(rows):
                own = buckets[bounds[k]:bounds[k + 1]]
                if not len(own):
                    continue
                counts = held.get(langs[row])
                if counts is None:
                    counts = held[langs[row]] = np.zeros(BUCKETS + 1, np.int64)
                np.add.at(counts, own + 1, 1)
                counts[0] += not taught[row]
                taught[row] = True
        if len(held) > 4 * BLOCK:  # many languages: hand on what is held
            yield from emitted(list(held))
    yield from emitted(list(held))


class Model:
    """Learned counts, stored: ``lang``, ``bucket`` (-1: documents), ``n``."""

    def __init__(self, counts: DataFrame):
        self.counts = counts
        per = counts.groupBy("lang").agg(
            F.sum(F.when(F.col("bucket") < 0, F.col("n")).otherwise(0)).alias("docs"),
            F.sum(F.when(F.col("bucket") >= 0, F.col("n")).otherwise(0)).alias("grams"))
        #: One (language, documents, n-grams) per language, by code point.
        self.langs = sorted((r.lang, r.docs, r.grams) for r in per.collect())

    def blocks(self):
        """``(languages, matrix)``: log probabilities per bucket, and the log
        prior in the last row, for up to BLOCK languages at a time."""
        total = sum(d for _, d, _ in self.langs)
        for first in range(0, len(self.langs), BLOCK):
            block = self.langs[first:first + BLOCK]
            names = [n for n, _, _ in block]
            matrix = np.zeros((BUCKETS + 1, len(block)))
            rows = self.counts.where(F.col("lang").isin(names) & (F.col("bucket") >= 0)).toArrow()
            column = {n: k for k, n in enumerate(names)}
            place = np.array([column[x] for x in rows.column("lang").to_pylist()], np.int64)
            matrix[rows.column("bucket").to_numpy(), place] = rows.column("n").to_numpy()
            sums = np.array([g for _, _, g in block], float)
            matrix[:BUCKETS] = np.log(matrix[:BUCKETS] + 1.0) - np.log(sums + BUCKETS)
            matrix[BUCKETS] = np.log(np.array([d for _, d, _ in block], float) / total)
            yield names, matrix


def learn(labelled: DataFrame) -> Model:
    """A model from the columns ``text`` and ``lang`` of all rows."""
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = (rows.where("lang is not null and text is not null")
              .mapInArrow(_count, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    return Model(common.stored(counts, "language-counts"))


def _scorer(names: list[str], shared, text: str, best: str, top: str, mass: str):
    """Fold one block of languages into the best language, its log score and
    the log of the sum of all scores; a text without letters has none."""

    def score(batches):
        matrix = shared.value
        for batch in batches:
            n = len(batch)
            sums = np.zeros((n, len(names)))
            seen = np.zeros(n, np.int64)
            for rows, buckets, bounds in grams(batch.column(text)):
                count = np.diff(bounds)
                some = np.flatnonzero(count)
                if len(some):
                    np.add.at(sums, rows[some], np.add.reduceat(matrix[buckets], bounds[some], axis=0))
                    np.add.at(seen, rows[some], count[some])
            sums += matrix[BUCKETS]
            old = batch.column(top).fill_null(-np.inf).to_numpy(zero_copy_only=False)
            whole = batch.column(mass).fill_null(-np.inf).to_numpy(zero_copy_only=False)
            first = np.argmax(sums, axis=1)
            value = sums[np.arange(n), first] if n else np.empty(0)
            better = value > old
            name = [names[f] if b else o for f, b, o in zip(first, better, batch.column(best).to_pylist())]
            high = np.maximum(whole, value)
            whole = high + np.log(np.exp(whole - high) + np.exp(sums - high[:, None]).sum(axis=1))
            none = seen == 0
            cols = {best: pa.array(name, pa.string(), mask=none), top: pa.array(np.where(better, value, old), mask=none),
                    mass: pa.array(whole, mask=none)}
            yield pa.RecordBatch.from_arrays([cols.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)

    return score


def identify(docs: DataFrame, model: Model, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the most probable language and its posterior probability
    (0 to 1).  Only the column ``text`` is looked at."""
    sc = docs.sparkSession.sparkContext
    names = list(docs.columns)
    pred, score = common.fresh(docs, pred), common.fresh(docs, score)
    # Columns are renamed by place, so no name of a caller can clash.
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                        F.col("text").cast("string").alias("text"), F.lit(None).cast("string").alias("best"),
                        F.lit(None).cast("double").alias("top"), F.lit(None).cast("double").alias("mass"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in plain.schema.fields])
    for block, matrix in model.blocks():
        plain = plain.mapInArrow(_scorer(block, sc.broadcast(matrix), "text", "best", "top", "mass"), schema)
    return plain.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
                        F.coalesce("best", F.lit(UNDETERMINED)).alias(pred),
                        F.coalesce(F.least(F.exp(F.col("top") - F.col("mass")), F.lit(1.0)), F.lit(0.0)).alias(score))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document's crc32 (of its id as text; null: of no text) falls
    into the fold."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold
