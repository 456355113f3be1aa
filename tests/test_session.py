"""The shared folder comes from the session's checkpoint setting."""

import tempfile

import types

import pytest

from tablewright.session import drop_scratch, scratch_path, shared_dir


def test_shared_dir_uses_the_session_setting(spark):
    sc = spark.sparkContext
    before = sc.getCheckpointDir()
    chosen = tempfile.mkdtemp(prefix="tw-test-ckpt-")
    sc.setCheckpointDir(chosen)
    try:
        d = shared_dir(spark)
        assert d == sc.getCheckpointDir()
        assert chosen in d
        p = scratch_path(spark, "x")
        assert p.startswith(d.rstrip("/") + "/x-")
        assert scratch_path(spark, "x") != p
    finally:
        if before:
            sc.setCheckpointDir(before)


def test_a_cluster_without_the_setting_is_an_error():
    """No machine-local folder on a master that is not local."""
    def session(master):
        sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda k, d: None))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
    assert shared_dir(session("local[2]"))


def test_scratch_is_dropped(spark):
    from tablewright.sources.files import settle
    path = scratch_path(spark, "rows")
    spark.range(5).write.parquet(path)
    kept = settle(spark.read.parquet(path), path)
    assert kept.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        drop_scratch(spark, "/elsewhere/x")
