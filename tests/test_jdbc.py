"""JDBC option wiring, checked without any database (none may be started)."""

import pytest

from tagweave.operators import export
from tagweave.sources import jdbc


class _FakeWriter:
    def __init__(self, calls):
        self.calls = calls

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls.setdefault("options", {})[key] = value
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def save(self):
        self.calls["saved"] = True


class _FakeFrame:
    def __init__(self):
        self.calls = {}

    @property
    def write(self):
        return _FakeWriter(self.calls)


def test_export_uses_batch_isolation_and_parallelism():
    df = _FakeFrame()
    jdbc.export_jdbc(df, "jdbc:x://h/db", "up_tag_merge_20000101", column_types="uid BIGINT, a VARCHAR(10)",
                     table_options="ENGINE = X")
    opts = df.calls["options"]
    assert df.calls["mode"] == "overwrite" and df.calls["saved"]
    assert (opts["batchsize"], opts["isolationLevel"], opts["numPartitions"]) == ("100", "NONE", "4")
    assert opts["createTableColumnTypes"] == "uid BIGINT, a VARCHAR(10)"
    assert opts["createTableOptions"] == "ENGINE = X" and opts["truncate"] == "false"


def test_append_mode():
    df = _FakeFrame()
    jdbc.append_jdbc(df, "jdbc:x://h/db", "t")
    assert df.calls["mode"] == "append" and df.calls["options"]["dbtable"] == "t"


def test_export_wide_column_types(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(export, "export_jdbc", lambda frame, url, table, **kw: seen.update(frame=frame, **kw))
    wide = spark.createDataFrame([("12", "a", "")], "uid string, tag_x string, tag_y string")
    export.export_wide_jdbc(wide, "jdbc:x://h/db", "up_tag_merge_20000101")
    assert seen["column_types"] == "uid BIGINT, tag_x TEXT, tag_y TEXT"
    assert seen["frame"].schema["uid"].dataType.simpleString() == "bigint"
    assert (seen["batch_size"], seen["isolation"], seen["num_partitions"]) == (100, "NONE", 4)


def test_read_argument_checks(spark):
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:x://h/db")
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:x://h/db", table="t", partition_column="id")
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:x://h/db", query="select 1", partition_column="id",
                       lower_bound=0, upper_bound=9, num_partitions=2)
