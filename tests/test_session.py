"""Scratch and checkpoint locations."""

import pytest

from ledgerline.session import checkpoint_root, scratch_path


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return _Conf()

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master):
        self.sparkContext = _Context(master)


def test_unset_checkpoint_dir_is_an_error_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("spark://head:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_root(_Session("yarn"))


def test_local_master_gets_a_private_folder():
    s = _Session("local[2]")
    root = checkpoint_root(s)
    assert root and s.sparkContext.dir == root


def test_scratch_paths_live_below_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root.rstrip("/") + "/") and a != b
