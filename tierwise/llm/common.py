"""Helpers shared by the training-data operators.

Words everywhere are runs of ``[^\\x20\\x09-\\x0D]+``.  Native operators get
them with :func:`words`; operators that run numpy inside tasks hash them in
bulk with :func:`hash_words`, which works on the UTF-8 bytes of an Arrow
batch in pieces of about :data:`PIECE` bytes, so its memory does not grow
with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.session import scratch_path
from tierwise.sources import versions

BLANKS = " \t\n\x0b\x0c\r"
SPLIT = "[ \\t-\\r]+"
PIECE = 1 << 19
ARROW_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Lists that take down the paths of stored tables (see :func:`recording`).
_records: list[list[str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    with files that survive the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if _records:
        _records[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recording(paths: list[str]):
    """Take down in ``paths`` what is stored inside."""
    _records.append(paths)
    try:
        yield
    finally:
        _records.pop()


def drop_paths(spark: SparkSession, paths: list[str], docs: DataFrame) -> None:
    """Remove stored tables that ``docs`` does not read, and take them off the
    list."""
    read = {f.rsplit("/", 2)[-2] for f in docs.inputFiles()} if paths else set()
    for path in [p for p in paths if p.rsplit("/", 1)[-1] not in read]:
        versions.delete(spark, path)
        paths.remove(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows by ``keys`` to as many tasks as shuffles have: for stages
    whose work is large against their bytes, which adaptive execution would
    put into few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: Rows that make a task worth its start, in steps that only join and count.
TASK_ROWS = 10_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, in one task for each TASK_ROWS of them, if
    these are fewer than shuffles have: for steps that repeat on tables small
    against the number of tasks.  The rows of one task come from whole shuffle
    partitions, one after the other."""
    tasks = max(1, -(-rows // TASK_ROWS))
    return df.coalesce(tasks) if tasks < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


#: No table of more bytes (as values, uncompressed) is broadcast.
BROADCAST_BYTES = 64 << 20


def _bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory: 16 per number, the length of
    texts, and the same for the members of arrays (by their JSON text)."""
    size = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        else:
            size = size + 16
    return size.cast("long")


def fit_to_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (stored) marked for broadcast if it has at most ``rows`` rows and
    BROADCAST_BYTES bytes; else as it is, for a shuffle join."""
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_BYTES else df


#: Keys of documents to drop are broadcast up to so many rows (some 30 MB).
DROP_ROWS = 500_000


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the documents named by ``keys`` (stored: ``_d`` a
    doc_id, ``_t`` the hash of the text), whatever the columns are called."""
    d, t = fresh(docs, "_d"), fresh(docs, "_t")
    keys = keys.select(F.col("_d").alias(d), F.col("_t").alias(t))
    return docs.join(fit_to_broadcast(keys, DROP_ROWS),
                     (F.xxhash64(docs["text"]) == F.col(t)) & docs["doc_id"].eqNullSafe(F.col(d)), "left_anti")


def drop_stored(*tables: DataFrame) -> None:
    """Remove the files of stored tables that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def words(text: Column) -> Column:
    """Array of words of a text; null and blank texts give an empty array."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPLIT))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that does not clash with the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


# ------------------------------------------------------- hashing inside tasks

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Odd multipliers for the five positions of a shingle.
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_keys(since: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """One pseudo-random value per (place in its word, byte), 0 for blanks."""
    key = (since.astype(np.uint64) << np.uint64(8)) + _LOWER[raw] + np.uint64(1)
    key *= np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    key ^= key >> np.uint64(29)
    key[_BLANK[raw]] = 0
    return key


#: The values of the first places of a word, looked up instead of computed.
_NEAR = 64
_KEYS = _byte_keys(np.repeat(np.arange(_NEAR), 256), np.tile(np.arange(256, dtype=np.uint8), _NEAR))


def _hash_piece(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``raw`` and the byte at which each begins; a
    word also begins at every offset of ``cuts``."""
    solid = ~_BLANK[raw]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cuts = cuts[cuts < len(raw)]
    begins[cuts] = solid[cuts]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.empty(0, np.uint64), at
    # A word's hash is the sum of the values of its bytes.
    start = np.zeros(len(raw), np.int32)
    start[at] = at
    since = np.arange(len(raw), dtype=np.int32) - np.maximum.accumulate(start)
    key = _KEYS.take((np.minimum(since, _NEAR - 1) << 8) + raw)
    if len(far := np.flatnonzero(since >= _NEAR)):
        key[far] = _byte_keys(since[far], raw[far])
    return mix(np.add.reduceat(key, at)), at


def hash_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first, last, hashes, bounds)`` for consecutive runs of rows:
    rows ``first..last-1`` have the word hashes
    ``hashes[bounds[i]:bounds[i + 1]]`` (A-Z lower-cased; nulls: no words)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, where, data = texts.buffers()
    ends = np.frombuffer(where, np.int64)[texts.offset: texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + PIECE, "right")) - 1
        last = min(max(last, first + 1), n)
        lo, hi = int(ends[first]), int(ends[last])
        if hi - lo <= 2 * PIECE:
            hashes, at = _hash_piece(raw[lo:hi], ends[first:last] - lo)
            bounds = np.searchsorted(at, ends[first:last + 1] - lo)
        else:  # one long text: cut it after blanks
            parts, pos = [], lo
            while pos < hi:
                end = min(pos + PIECE, hi)
                step = 4096
                while end < hi:
                    blank = np.flatnonzero(_BLANK[raw[end:min(end + step, hi)]])
                    if len(blank):
                        end += int(blank[0]) + 1
                        break
                    end = min(end + step, hi)
                parts.append(_hash_piece(raw[pos:end], np.zeros(1, np.int64))[0])
                pos = end
            hashes = np.concatenate(parts)
            bounds = np.array([0, len(hashes)])
        yield first, last, hashes, bounds
        first = last


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Five-word shingles of each run of words, repeats included, and their
    bounds.  One to four words make one shingle of them all; no words, none."""
    n = np.diff(bounds)
    count = np.where(n >= 5, n - 4, (n > 0).astype(n.dtype))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    if len(hashes) >= 5:
        m = len(hashes) - 4
        whole = np.zeros(m, np.uint64)
        for k in range(5):
            whole += hashes[k:m + k] * _PLACE[k]
    else:
        whole = np.empty(0, np.uint64)
    starts = np.repeat(bounds[:-1], count) + (np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], count))
    out = np.zeros(out_bounds[-1], np.uint64)
    full = np.repeat(n >= 5, count)
    out[full] = whole[starts[full]]
    for d in np.flatnonzero((n > 0) & (n < 5)):
        own = hashes[bounds[d]:bounds[d + 1]]
        out[out_bounds[d]] = (own * _PLACE[:len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(out), out_bounds


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    for _, _, hashes, bounds in hash_words(pa.array([text], pa.large_string())):
        return np.unique(shingle_hashes(hashes, bounds)[0])
    return np.empty(0, np.uint64)
