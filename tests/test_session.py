"""Checkpoint folder rules: the cluster's shared spark.checkpoint.dir is
used; a local folder is made only for local sessions with no setting."""

import pytest

from clusterfold.session import checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _SC:
    def __init__(self, master, conf_value):
        self.master = master
        self._conf = _Conf(conf_value)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d + "/uuid"


class _Spark:
    def __init__(self, master, conf_value=None):
        self.sparkContext = _SC(master, conf_value)


def test_cluster_without_setting_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Spark("yarn"))


def test_cluster_setting_is_used():
    assert checkpoint_dir(_Spark("yarn", "hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt/uuid"


def test_local_session_gets_scratch_folder():
    assert checkpoint_dir(_Spark("local[2]")).endswith("/uuid")


def test_real_session_has_one(spark):
    assert checkpoint_dir(spark)
