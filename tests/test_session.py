"""checkpoint_dir: read the shared folder from the session; invent none on a cluster."""

import pytest

from seasonflow.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, conf=None, current=None):
        self.master = master
        self._conf = _Conf(conf or {})
        self.current = current

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self.current = path


class _Session:
    def __init__(self, context, conf=None):
        self.sparkContext = context
        self.conf = _Conf(conf or {})


def test_existing_checkpoint_dir_is_used():
    s = _Session(_Context("yarn", current="hdfs:///ckpt/abc"))
    assert checkpoint_dir(s) == "hdfs:///ckpt/abc"


def test_configured_dir_is_applied():
    s = _Session(_Context("yarn", conf={"spark.checkpoint.dir": "s3a://b/ckpt"}))
    assert checkpoint_dir(s) == "s3a://b/ckpt"


def test_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session(_Context("k8s://https://api")))


def test_local_without_setting_gets_scratch_folder():
    s = _Session(_Context("local[4]"))
    path = checkpoint_dir(s)
    assert "seasonflow-ckpt-" in path and s.conf.get("spark.checkpoint.dir") == path
