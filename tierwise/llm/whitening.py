"""Embedding whitening by weighted multiplicity covariance.

Vectors are put on a grid (x = floor(SCALE * c) + SHIFT per entry) and equal x
vectors are grouped; each distinct one enters the fit once, with its count as
weight (or one, ``weights="one"``: every distinct vector counts alike).  The
fit is n (sum of weights), S (weighted sums per dimension) and the covariance
as a weighted GEMM of centred vectors: every task multiplies its own vectors,
Spark adds the partial products up per matrix entry.  The eigenvectors of that
one matrix (dimensions squared) come from the driver and whiten each distinct
vector once, in numpy; rows then take their vector's result.

Hot vectors: a vector that holds a thousandth of all rows or more goes by
broadcast (there are at most a thousand of those), all others by a shuffle
join, so no task gets the rows of a hot vector.

Defined cases: rows whose vector is null, or has a null or non-finite entry,
are dropped; vectors of different lengths are populations of their own, each
with its own fit; empty vectors have no components, so no rows; entries
beyond +-LIMIT / SCALE saturate there (n times the largest x must stay below
2**63: 9e12 vectors at entries up to some thousands); repeated rows count and come back each;
a component whose eigenvalue is zero (within rounding) has null ``whitened``
and does not enter ``identity_error``; an empty table gives an empty result.
Of the input, only ``vec_id`` and the vector are looked at, so extra columns
of any name do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.llm import common

SCALE, SHIFT = 64, 1_000_000
LIMIT = 1 << 40
COMPONENTS = 32
#: Vectors with at least this share of all rows are joined by broadcast.
HOT = 1000

ROW = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("component", T.IntegerType()),
                    T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
                    T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                    T.StructField("identity_error", T.DoubleType())])


def gridded(vectors: DataFrame, vector: str) -> DataFrame:
    """``vec_id``, ``x`` of the rows whose vector is whole and finite."""
    v = F.col("v")
    whole = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    entry = lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))) + F.lit(SHIFT)
    return (vectors.select("vec_id", F.col(vector).cast("array<double>").alias("v"))
            .where(v.isNotNull() & whole).select("vec_id", F.transform(v, entry).alias("x")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list column as one matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _entries(total: np.ndarray | None):
    """A matrix as rows (i, j, v)."""
    if total is None:
        return
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())],
                                     names=["i", "j", "v"])


def _product(dims: int, values: str, centre, times: int = 1):
    """Partial sums of w * y y^T over a task's rows, with y the column
    ``values`` centred: (times * value - centre) / times, exact up to the
    division for integers."""

    def run(batches):
        total = None
        for batch in batches:
            if not len(batch):
                continue
            y = (_matrix(batch.column(values), dims) * times - centre) / times
            w = batch.column("w").to_numpy().astype(float)
            part = (y * w[:, None]).T @ y
            total = part if total is None else total + part
        yield from _entries(total)

    return run


def _summed(products: DataFrame, dims: int) -> np.ndarray:
    """The sum of all tasks' matrices (dims * dims numbers)."""
    rows = products.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((dims, dims))
    out[rows.column("i").to_numpy(), rows.column("j").to_numpy()] = rows.column("v").to_numpy()
    return out


def _whiten(n: int, sums: np.ndarray, axes: np.ndarray):
    """Append the projections on ``axes`` (scaled eigenvectors) and the exact
    deviation to the rows of distinct vectors."""
    dims = len(sums)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            far = x * n - sums
            z = (far / n) @ axes
            rough = (far.astype(float) ** 2).sum(axis=1)
            if len(rough) and rough.max() < 9e18:
                deviation = (far * far).sum(axis=1).tolist()
            else:  # beyond 64 bits
                deviation = [sum(int(d) * int(d) for d in row) for row in far]
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("c"), batch.column("w"),
                 pa.array([str(d) for d in deviation], pa.string()), pa.array(list(z), pa.list_(pa.float64()))],
                names=["x", "c", "w", "deviation", "z"])

    return run


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, weights: str = "count") -> DataFrame:
    """One row per vector and component: ``vec_id``, ``component`` (1 has the
    largest variance), ``n``, ``deviation`` (sum over dimensions of
    (n * x - S)^2, exact), ``whitened``, ``explained`` (share of the variance)
    and ``identity_error`` (largest absolute entry of the covariance of
    ``whitened`` minus the identity)."""
    spark = vectors.sparkSession
    rows = gridded(vectors, vector)
    w = F.col("c") if weights == "count" else F.lit(1).cast("long")
    distinct = common.stored(rows.groupBy("x").agg(F.count("*").alias("c")).withColumn("w", w)
                             .withColumn("dims", F.size("x")), "distinct-vectors")
    out = spark.createDataFrame([], ROW)
    lengths = [r.dims for r in distinct.where("dims > 0").select("dims").distinct().orderBy("dims").collect()]
    for dims in lengths:
        one = distinct.where(F.col("dims") == dims)
        out = out.unionByName(_whitened(rows.where(F.size("x") == dims), one, dims, components))
    return out


def _whitened(rows: DataFrame, distinct: DataFrame, dims: int, components: int) -> DataFrame:
    sc = distinct.sparkSession.sparkContext
    per = (distinct.select("w", F.posexplode("x").alias("i", "v"))
           .groupBy("i").agg(F.sum(F.col("v") * F.col("w")).alias("s"), F.sum("w").alias("n")).orderBy("i").collect())
    n, sums = per[0].n, np.array([r.s for r in per], np.int64)
    cov = _summed(distinct.select("x", "w").mapInArrow(_product(dims, "x", sums, n), "i int, j int, v double"), dims) / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    trace = float(np.trace(cov))
    real = values > max(trace, 0.0) * dims * np.finfo(float).eps
    axes = np.where(real, vectors / np.sqrt(np.where(real, values, 1.0)), 0.0)
    done = common.stored(distinct.select("x", "c", "w").mapInArrow(
        _whiten(n, sums, axes), "x array<bigint>, c long, w long, deviation string, z array<double>"), "whitened")
    k = len(values)
    means = np.array([r.m for r in done.select("w", F.posexplode("z").alias("i", "v")).groupBy("i")
                      .agg((F.sum(F.col("v") * F.col("w")) / n).alias("m")).orderBy("i").collect()])
    kept = _summed(done.select("z", "w").mapInArrow(_product(k, "z", means), "i int, j int, v double"), k) / n
    kept = kept[np.ix_(real, real)]
    error = float(np.abs(kept - np.eye(len(kept))).max()) if len(kept) else None
    explained = [float(v) / trace if trace > 0 else None for v in values]

    # Rows take their vector's result: hot vectors by broadcast (at most HOT
    # of them have a HOT-th of the rows each), the others by a shuffle.
    total = distinct.agg(F.sum("c")).first()[0]
    hot = F.col("c") * HOT >= total
    few = done.where(hot).select("x", "deviation", "z")
    if few.take(1):
        named = few.select(F.col("x").alias("hx"), F.col("deviation").alias("hd"), F.col("z").alias("hz"))
        marked = rows.join(F.broadcast(named), F.col("x") == F.col("hx"), "left")
        joined = (marked.where("hx is not null").select("vec_id", F.col("hd").alias("deviation"), F.col("hz").alias("z"))
                  .unionByName(marked.where("hx is null").select("vec_id", "x")
                               .join(done.where(~hot).select("x", "deviation", "z"), "x").drop("x")))
    else:
        joined = rows.join(done.select("x", "deviation", "z"), "x").drop("x")
    flags, shares = F.array(*[F.lit(bool(r)) for r in real]), F.array(*[F.lit(e).cast("double") for e in explained])
    return joined.select("vec_id", "deviation", F.posexplode("z").alias("at", "y")).select(
        F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        F.when(F.get(flags, F.col("at")), F.col("y")).alias("whitened"), F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
