"""Shared storage folder: read from the session; a temp folder only for local runs."""

import pytest

from tagweave.session import get_session, storage_root, work_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(dict(conf or {}))
        self.sparkContext = _Context(master)


def test_root_comes_from_the_session():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert storage_root(s) == "hdfs://nn/shared/ckpt"
    assert work_dir(s, "tags").startswith("hdfs://nn/shared/ckpt/tagweave/tags-")


def test_cluster_without_setting_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage_root(_Session("yarn"))


def test_local_session_gets_its_own_folder():
    s = _Session("local[2]")
    root = storage_root(s)
    assert root.startswith("/") and s.sparkContext.dir == root
    assert storage_root(s) == root  # stable once set


def test_a_running_session_keeps_its_settings(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        again = get_session()
        assert again.conf.get("spark.sql.session.timeZone") == "Asia/Shanghai"
        assert again.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
