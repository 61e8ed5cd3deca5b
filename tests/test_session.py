import pytest

from tidemark.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value=None):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default

    def set(self, key, value):
        self.value = value


class _Context:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class _Session:
    def __init__(self, master, conf_value=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context(master)


def test_cluster_without_shared_checkpoint_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_setting_is_used_as_is():
    s = _Session("yarn", "hdfs:///shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.current == "hdfs:///shared/ckpt"


def test_local_mode_gets_a_scratch_folder():
    s = _Session("local[2]")
    path = ensure_checkpoint_dir(s)
    assert path and s.conf.value == path
