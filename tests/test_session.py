import pytest

from tradelake.session import checkpoint_root, parallelism, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Ctx:
    defaultParallelism = 3

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, path):
        self.path = path


class _Session:
    def __init__(self, master, ckpt=None):
        self.conf = _Conf({"spark.master": master, "spark.sql.shuffle.partitions": "7"}
                          | ({"spark.checkpoint.dir": ckpt} if ckpt else {}))
        self.sparkContext = _Ctx()


def test_checkpoint_root_prefers_session_setting():
    assert checkpoint_root(_Session("yarn", "hdfs://nn/shared/ckpt/")) == "hdfs://nn/shared/ckpt"
    assert scratch_path(_Session("yarn", "hdfs://nn/c"), "x").startswith(
        "hdfs://nn/c/tradelake-scratch/x-")


def test_checkpoint_root_refuses_local_folder_on_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("yarn"))


def test_checkpoint_root_local_fallback_registers_folder():
    session = _Session("local[2]")
    root = checkpoint_root(session)
    assert session.conf.get("spark.checkpoint.dir") == root
    assert session.sparkContext.path == root


def test_parallelism_from_context():
    assert parallelism(_Session("local[2]")) == 3
