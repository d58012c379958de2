"""Session helpers: the shared checkpoint folder and the scale settings."""

import pytest

from tierwise import session


class _Ctx:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt, self.set_to = master, ckpt, None

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self.set_to = d
        self._ckpt = f"file:{d}/uuid"


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, k, default=None):
        return self.values.get(k, default)


class _Spark:
    def __init__(self, master, ckpt=None, conf=None):
        self.sparkContext = _Ctx(master, ckpt)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_refuses():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Spark("yarn"))


def test_configured_dir_is_used_on_a_cluster():
    s = _Spark("k8s://api", conf={"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert session.checkpoint_root(s) == "file:hdfs://nn/ckpt/uuid"
    assert s.sparkContext.set_to == "hdfs://nn/ckpt"


def test_existing_dir_wins_and_local_falls_back():
    assert session.checkpoint_root(_Spark("yarn", ckpt="hdfs://x/y/")) == "hdfs://x/y"
    local = _Spark("local[4]")
    assert session.checkpoint_root(local).startswith("file:")
    assert "tierwise-ckpt-" in local.sparkContext.set_to


def test_scratch_paths_are_unique_and_shared(spark):
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    root = spark.sparkContext.getCheckpointDir().rstrip("/")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_apply_scale_conf_leaves_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        session.apply_scale_conf(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
