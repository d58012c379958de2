"""Session construction and the shared scratch folder.

Runtime SQL settings live in :data:`SCALE_CONF`; :func:`apply_scale_conf`
sets them on an existing session (they are all runtime-modifiable), so a
session built by someone else (a cluster launcher, the test driver) gets
the same adaptive execution behaviour.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution: coalesce small shuffle partitions, split skewed join
# partitions at run time, and convert joins to broadcast only when the
# runtime size of a side is below the (size-checked) broadcast threshold.
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    # Wide projections of casts make methods that the JVM does not compile
    # beyond 8000 bytes; such a stage runs faster without being fused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_scale_conf(spark: SparkSession) -> SparkSession:
    """Set the adaptive-execution settings on a session (time zone untouched:
    every tierwise timestamp is zone-free)."""
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    return spark


#: Whether Spark removes an execution's shuffle files at its end; else they stay
#: until the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go as soon as their execution has ended.  For
    steps that execute every frame once, such as one table written after the
    other: a frame executed again would have to shuffle again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def build_session(
    master: str | None = None,
    app_name: str = "tierwise",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the scale settings applied.

    ``shuffle_partitions`` is the *initial* partition count; AQE coalesces it
    down at run time, so on a cluster set it to roughly
    ``total input bytes / 128MB`` and let AQE shrink it.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.sql.session.timeZone"] = "UTC"
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.ansi.enabled"] = "true"
    # No Python call-site capture per DataFrame call (it only enriches error
    # messages and costs extra JVM round trips while plans are built).
    conf["spark.python.sql.dataFrameDebugging.enabled"] = "false"
    # Remove checkpoint files once their DataFrames are garbage collected.
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_scale_conf(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a path every executor can reach); in local
    mode, where nobody set one, as in tests, it is a folder in the session's
    warehouse.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if conf_dir:
            sc.setCheckpointDir(conf_dir)
        elif sc.master.startswith("local"):
            warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or "spark-warehouse"
            sc.setCheckpointDir(f"{warehouse.rstrip('/')}/tierwise-ckpt-{uuid.uuid4().hex[:12]}")
        else:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/object store) before running tierwise on a cluster"
            )
        d = sc.getCheckpointDir()
    return d.rstrip("/")


_marked: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.  All of them
    are removed when the session's process ends."""
    root = f"{checkpoint_root(spark)}/tierwise"
    if root not in _marked:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _marked.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
