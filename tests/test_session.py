"""The shared scratch folder rule: the cluster's spark.checkpoint.dir, never a machine-local folder on a cluster."""

import pytest

from carepulse.session import new_scratch, scratch_root


class _Conf(dict):
    def get(self, k, default=None):
        return super().get(k, default)


class _SC:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt, self._conf = master, ckpt, _Conf()

    def getCheckpointDir(self):
        return self._ckpt

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Spark:
    def __init__(self, sc):
        self.sparkContext, self.conf = sc, _Conf()


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        scratch_root(_Spark(_SC("yarn")))


def test_cluster_folder_is_used_as_is():
    s = _Spark(_SC("yarn", "hdfs://nn/ckpt/app-1/"))
    assert scratch_root(s) == "hdfs://nn/ckpt/app-1"
    a, b = new_scratch(s, "x"), new_scratch(s, "x")
    assert a.startswith("hdfs://nn/ckpt/app-1/x-") and a != b


def test_local_master_gets_a_folder_once():
    s = _Spark(_SC("local[2]"))
    first = scratch_root(s)
    assert first and scratch_root(s) == first
