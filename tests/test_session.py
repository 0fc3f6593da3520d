"""Checkpoint-folder rules, exercised with stand-in session objects."""

import pytest

from marquee.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckpt=None, conf=None):
        self.master, self.ckpt, self._conf = master, ckpt, _Conf(conf or {})

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = path

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, context, conf=None):
        self._context, self.conf = context, _Conf(conf or {})

    @property
    def sparkContext(self):
        if self._context is None:
            raise RuntimeError("no SparkContext (Spark Connect)")
        return self._context


def test_cluster_session_without_checkpoint_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session(_Context("yarn")))


def test_cluster_session_uses_the_configured_shared_folder():
    session = _Session(_Context("yarn"), {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert checkpoint_dir(session) == "hdfs://nn/shared/ckpt"


def test_local_session_without_setting_gets_a_private_folder():
    session = _Session(_Context("local[4]"))
    path = checkpoint_dir(session)
    assert path and "marquee-ckpt-" in path
    assert checkpoint_dir(session) == path  # stable once set


def test_connect_style_session_reads_the_setting():
    assert checkpoint_dir(_Session(None, {"spark.checkpoint.dir": "s3a://b/ckpt"})) == "s3a://b/ckpt"
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session(None))
