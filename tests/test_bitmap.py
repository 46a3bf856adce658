import pytest

from tagweave.functions import bitmap as bm
from tagweave.functions.bitmap import decode
from tagweave.operators.bitmap import (audience_uids, build_bitmaps, cardinality, explode_wide, select_audience,
                                       unpivot_wide)


def _long(spark, uids, code="t", value="v"):
    return spark.createDataFrame([(u, code, value) for u in uids], "uid string, tag_code string, tag_value string")


def test_bitmap_edges_decode_to_themselves(spark):
    uids = ["0", "1", "7", "7", "32768", "40000"]
    bitmaps = build_bitmaps(_long(spark, uids), "2000-01-01")
    decoded = sorted(r.uid for r in decode(bitmaps, ["tag_code", "tag_value"]).collect())
    assert decoded == [0, 1, 7, 32768, 40000]
    assert cardinality(bitmaps).first().users == 5
    assert {r.dt for r in bitmaps.collect()} == {"20000101"}


@pytest.mark.parametrize("bad", ["-1", "abc"])
def test_bad_uids_rejected(spark, bad):
    with pytest.raises(Exception, match="non-negative integer"):
        build_bitmaps(_long(spark, ["1", bad])).collect()


def test_unpivot_equals_explode_and_drops_empty(spark):
    wide = spark.createDataFrame([("1", "a", ""), ("2", "", "x,y")], "uid string, t1 string, t2 string")
    u = unpivot_wide(wide, ["T1", "T2"])
    e = explode_wide(wide, ["T1", "T2"])
    assert sorted(map(tuple, u.collect())) == sorted(map(tuple, e.collect())) == [("1", "t1", "a"), ("2", "t2", "x,y")]


def test_audiences(spark):
    rows = [(str(u), "g", "M" if u % 2 else "F") for u in range(1, 70000, 3)] + \
           [(str(u), "c", "A") for u in range(1, 70000, 5)]
    long = spark.createDataFrame(rows, "uid string, tag_code string, tag_value string")
    bitmaps = build_bitmaps(long)
    both = {r.uid for r in audience_uids(bitmaps, [("g", "M"), ("c", "A")], "and").collect()}
    either = {r.uid for r in audience_uids(bitmaps, [("g", "M"), ("c", "A")], "or").collect()}
    male = {u for u in range(1, 70000, 3) if u % 2}
    a = set(range(1, 70000, 5))
    assert both == male & a and either == male | a
    assert select_audience(bitmaps, [("g", "nobody"), ("c", "A")], "and").count() == 0


def test_stored_user_count_equals_bitmap_count(spark):
    from pyspark.sql import functions as F
    long = _long(spark, [str(u) for u in range(0, 100_000, 3)] + ["3", "6"])
    b = build_bitmaps(long)
    assert b.filter(F.col("users") != bm.users_in("us")).count() == 0
    assert cardinality(b).first().users == len(range(0, 100_000, 3))
