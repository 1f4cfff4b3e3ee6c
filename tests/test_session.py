import pytest

from tidemart.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default

    def set(self, key, value):
        self.value = value


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, value=None):
        self.conf, self.sparkContext = _Conf(value), _Context(master)


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_configured_checkpoint_dir_is_used_as_is():
    s = _Session("yarn", "hdfs://shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.dir == "hdfs://shared/ckpt"


def test_local_mode_gets_a_fresh_folder(tmp_path):
    s = _Session("local[4]")
    path = ensure_checkpoint_dir(s, str(tmp_path / "ckpt"))
    assert path.endswith("ckpt") and s.sparkContext.dir == path and s.conf.value is None


def test_cluster_refuses_a_local_fallback(tmp_path):
    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(_Session("yarn"), str(tmp_path / "ckpt"))


def test_real_session_without_the_setting(tmp_path):
    """In a process of its own: an empty configuration folder, no checkpoint folder set."""
    import os
    import subprocess
    import sys
    code = (
        "from pyspark.sql import SparkSession\n"
        "from tidemart.session import ensure_checkpoint_dir\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "path = ensure_checkpoint_dir(s)\n"
        "assert ensure_checkpoint_dir(s) == s.sparkContext.getCheckpointDir() and path in s.sparkContext.getCheckpointDir()\n"
        "assert s.range(5).checkpoint().count() == 5\n"
        "print('fine')\n")
    conf = tmp_path / "conf"
    conf.mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300,
                          env=os.environ | {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": root})
    assert done.returncode == 0 and "fine" in done.stdout, done.stderr[-2000:]
