"""Shared-folder rules: a cluster must name spark.checkpoint.dir; local runs get a folder."""

import pytest

from rankfold.functions import spread
from rankfold.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, configured=None):
        self.master = master
        self._dir = None
        self._conf = _Conf({"spark.checkpoint.dir": configured} if configured else {})

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d + "/uuid"


class _Session:
    def __init__(self, master, configured=None):
        self.sparkContext = _Context(master, configured)
        self.conf = _Conf({})


def test_cluster_without_checkpoint_dir_refuses_local_folder():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))


def test_cluster_uses_configured_shared_folder():
    assert checkpoint_dir(_Session("yarn", "hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt/uuid"


def test_local_gets_a_folder():
    assert checkpoint_dir(_Session("local[2]")).endswith("/uuid")


def test_spread_is_noop_on_large_input(spark, monkeypatch):
    import rankfold.functions as functions

    scan = spark.range(0, 1000)
    monkeypatch.setattr(functions, "BYTES_PER_SPLIT", 0)
    assert spread(scan) is scan


def test_local_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("local-cluster[3,2,1024]"))
