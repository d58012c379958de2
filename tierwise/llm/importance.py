"""Target-distribution importance resampling.

Features are the runs of 1 to :data:`LONGEST` consecutive words, hashed into
:data:`BUCKETS` buckets.  A bucket's gain is the log ratio of its smoothed
shares in the target texts and in the documents; a document's weight is the
mean gain of its features.  Gumbel noise, drawn from a hash of the document's
id, is added to the weight, and the highest scores are the sample: sampling
without replacement with probability proportional to exp(weight).

Features of a batch come from batch concatenation: texts are joined with a
separator that no word holds, one regex pass finds all words, the documents'
offsets (searchsorted) tell which document a word is of, runs of words that
cross a document's end are masked, and bincount sums per bucket or document.

The sample's order never passes through one task: scores are whole numbers in
a range that the gains bound, so a count per score gives every score its first
rank, and only documents of equal score are ranked among each other, the last
tie by id.

Defined cases: null, empty and word-free texts have no features and weight 0;
long texts are cut between words into pieces (runs across a cut count once);
a null id hashes as an empty one and ranks last among ties; repeated rows
count each time, and rank in the order of their texts' hashes; an empty table
gives an empty result; without target texts every gain comes from smoothing
alone.  ``doc_id`` and ``text`` are the only columns looked at.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm import common

LONGEST = 1
BUCKETS = 10_000
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
PIECE = 1 << 20
#: Fixed value: a word, in lower-cased UTF-8 bytes.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
SENTINEL = b"\x00"


def _joined(texts: pa.Array, longest: int):
    """Yield ``(row of each part, bytes, begin of each part, words carried)``:
    the lower-cased texts of consecutive rows with a sentinel after each.  A
    text longer than PIECE comes in parts of its own, cut between words, that
    repeat the last ``longest - 1`` words before the cut."""
    rows, parts, held = [], [], 0

    def whole(carried=0):
        begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        return np.array(rows), SENTINEL.join(parts) + SENTINEL, begins, carried

    for row, value in enumerate(texts.cast(pa.large_binary())):
        body = (value.as_py() or b"").lower()
        if len(body) <= PIECE:
            rows.append(row)
            parts.append(body)
            held += len(body)
            if held >= PIECE:
                yield whole()
                rows, parts, held = [], [], 0
            continue
        if rows:
            yield whole()
        at, carry = 0, []
        while at < len(body):
            cut = BREAK.search(body, min(at + PIECE, len(body)))
            end = cut.end() if cut else len(body)
            part = body[at:end]
            rows, parts = [row], [b" ".join([*carry, part])]
            yield whole(len(carry))
            carry = [*carry, *WORD.findall(part)][-(longest - 1):] if longest > 1 else []
            at = end
        rows, parts, held = [], [], 0
    if rows:
        yield whole()


def features(texts: pa.Array, longest: int, buckets: int):
    """Yield ``(rows, bucket, part, words, n)``: bucket and part of every
    feature, and the number of words ``n`` of each part; a part's row is
    ``rows[part]``."""
    known: dict[bytes, int] = {}
    for rows, body, begins, carried in _joined(texts, longest):
        found, starts = [], []
        for m in WORD.finditer(body):
            found.append(m.group())
            starts.append(m.start())
        part = np.searchsorted(begins, np.array(starts, np.int64), "right") - 1
        n = np.bincount(part, minlength=len(rows))
        if len(known) > 1 << 18:
            known.clear()
        crcs = []
        for w in found:
            crc = known.get(w)
            if crc is None:
                crc = known[w] = zlib.crc32(w)
            crcs.append(crc)
        # A run that ends with a carried word has been counted before.
        fresh = np.ones(len(found), bool)
        fresh[:carried] = False
        n[0] -= carried if len(n) else 0
        bucket, owner = [np.array(crcs, np.int64)[fresh] % buckets], [part[fresh]]
        runs = crcs
        for k in range(2, longest + 1):
            runs = [zlib.crc32(b" " + w, c) for c, w in zip(runs, found[k - 1:])]
            inside = (part[:len(runs)] == part[k - 1:]) & fresh[k - 1:]
            bucket.append(np.array(runs, np.int64)[inside] % buckets)
            owner.append(part[k - 1:][inside])
        yield rows, np.concatenate(bucket), np.concatenate(owner), n


def _counts(longest: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _, _ in features(batch.column(0), longest, buckets):
                total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows of the column ``text`` (``buckets``
    numbers, whatever the input)."""
    rows = (texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_counts(longest, buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1)(S + B) / ((s + 1)(T + B)))) per bucket."""
    all_raw, all_target, width = float(raw.sum()), float(target.sum()), float(len(raw))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_raw + width) / ((s + 1.0) * (all_target + width))))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def _weigh(gain, longest: int):
    def run(batches):
        of = gain.value
        for batch in batches:
            count, total, words = (np.zeros(len(batch), np.int64) for _ in range(3))
            for rows, bucket, part, n in features(batch.column("text"), longest, len(of)):
                np.add.at(words, rows, n)
                np.add.at(count, rows, np.bincount(part, minlength=len(rows)))
                # bincount's weights are doubles: exact below 2**53.
                np.add.at(total, rows, np.bincount(part, of[bucket].astype(float), len(rows)).astype(np.int64))
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(words), pa.array(count), pa.array(weight)],
                                             names=["doc_id", "key", "n_words", "n_features", "weight"])

    return run


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_features``,
    ``weight``, ``score`` and ``rank`` in the sample (null: not drawn).  Drawn
    are the ``percent`` % with the highest scores of the documents with
    ``min_words`` words or more."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    weighed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                          F.xxhash64("text").alias("key"))
    weighed = weighed.mapInArrow(_weigh(shared, longest), "doc_id long, key long, n_words long, n_features long, weight long")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = common.stored(weighed.withColumn("score", F.col("weight") + noise), "importance")

    enough = F.col("n_words") >= min_words
    # One row per score, a whole number between the least and the largest gain
    # plus noise: some ten thousand rows for the windows below, at any size.
    per = scored.where(enough).groupBy("score").agg(F.count("*").alias("n"))
    above = Window.orderBy(F.col("score").desc())
    ranked = per.select("score", (F.sum("n").over(above) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("all"))
    wanted = common.stored(ranked.where("before < floor(%d * all / 100)" % percent)
                           .select("score", "before", F.expr("floor(%d * all / 100)" % percent).alias("take")), "ranks")
    last = wanted.agg(F.min("score"), F.max("take")).first()
    if last[0] is None:
        return scored.select("doc_id", "n_words", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    chosen = enough & (F.col("score") >= last[0])
    # A score's rows are of one rank group; groups are many and none is hot,
    # as the noise differs by document.
    among = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "key")
    best = (scored.where(chosen).withColumn("place", F.row_number().over(among)).join(F.broadcast(wanted), "score")
            .withColumn("rank", (F.col("before") + F.col("place")).cast("long")))
    best = best.withColumn("rank", F.when(F.col("rank") <= last[1], F.col("rank")))
    cols = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return best.select(*cols).unionByName(scored.where(~chosen).withColumn("rank", F.lit(None).cast("long")).select(*cols))
