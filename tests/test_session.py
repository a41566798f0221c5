import pytest

from quire.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current
        self.set_to = None

    def getCheckpointDir(self):
        return self.set_to or self.current

    def setCheckpointDir(self, path):
        self.set_to = path


class _Session:
    def __init__(self, master, conf_value=None, current=None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf_value)


def test_cluster_without_checkpoint_dir_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("spark://cluster:7077"))


def test_cluster_checkpoint_dir_is_read_not_replaced():
    s = _Session("yarn", conf_value="hdfs://shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.set_to == "hdfs://shared/ckpt"
    s2 = _Session("yarn", current="hdfs://shared/already")
    assert ensure_checkpoint_dir(s2) == "hdfs://shared/already" and s2.sparkContext.set_to is None


def test_local_without_checkpoint_dir_gets_a_temporary_folder():
    s = _Session("local[2]")
    path = ensure_checkpoint_dir(s)
    assert path and s.sparkContext.set_to == path
