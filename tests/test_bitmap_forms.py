"""Both stored bitmap forms give the same answers; days are never mixed."""

import pytest
from pyspark.sql import functions as F

from tagweave.functions import bitmap as bm
from tagweave.operators import bitmap as ops
from tagweave.operators.merge import map_wide, pivot_wide


def _cells(spark):
    many = spark.range(1, 40_000).selectExpr("cast(id as string) uid", "'t' tag_code", "'big' tag_value")
    few = spark.range(1, 40_000, 500).selectExpr("cast(id as string) uid", "'t' tag_code", "'few' tag_value")
    one = spark.range(1, 3000).selectExpr("cast(id as string) uid", "'u' tag_code", "concat('v', id) tag_value")
    zero = spark.createDataFrame([("0", "t", "few")], "uid string, tag_code string, tag_value string")
    return many.unionByName(few).unionByName(one).unionByName(zero)


def test_forms_decode_count_and_combine_alike(spark):
    cells = _cells(spark)
    stored = ops.build_bitmaps(cells, "2000-01-01").cache()
    sizes = stored.select("tag_value", F.octet_length("us").alias("n"), "users", bm.users_in("us").alias("counted")).collect()
    assert all(r["users"] == r["counted"] for r in sizes)
    assert {r["n"] for r in sizes if r["tag_value"] == "big"} == {5}  # consecutive users are one run
    assert all(r["n"] == 2 for r in sizes if r["tag_value"].startswith("v"))
    back = bm.decode(stored, ["tag_code", "tag_value"])
    want = cells.selectExpr("tag_code", "tag_value", "cast(uid as bigint) uid")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    dense = bm.dense(stored, ["tag_code", "tag_value", "bucket"])
    assert dense.where(F.octet_length("us") != 4096).count() == 0
    assert dense.agg(F.sum(F.bitmap_count("us"))).first()[0] == cells.count()
    both = {r["uid"] for r in ops.audience_uids(stored, [("t", "big"), ("t", "few")], "and").collect()}
    assert both == set(range(1, 40_000, 500))
    either = ops.audience_uids(stored, [("t", "few"), ("u", "v7")], "or")
    assert {r["uid"] for r in either.collect()} == {0, 7, *range(1, 40_000, 500)}
    assert sum(len(bytes(r["us"])) for r in stored.where("tag_code = 'u'").collect()) / 2999 < 100
    stored.unpersist()


def test_days_are_not_mixed(spark):
    cells = _cells(spark).where("tag_value = 'few'")
    two = ops.build_bitmaps(cells, "2000-01-01").unionByName(ops.build_bitmaps(cells, "2000-01-02"))
    for job in (lambda: ops.cardinality(two), lambda: ops.select_audience(two, [("t", "few")], "and"),
                lambda: ops.select_audience(two, [("t", "few")], "or")):
        with pytest.raises(Exception, match="more than one day"):
            job().collect()


@pytest.mark.parametrize("tags", [8, 64, 65, 100])
def test_one_exchange_and_equal_forms(spark, tags):
    codes = [f"T{i}" for i in range(tags)]
    long = spark.range(40 * tags).selectExpr("cast(id % 40 as string) uid", f"concat('T', id % {tags}) tag_name",
                                             "cast(id % 7 as string) tag_value")
    a, b = pivot_wide(long, codes), map_wide(long, codes)
    for df in (a, b):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        below = plan[plan.index("Exchange hashpartitioning"):]
        assert "Aggregate" not in below and "Sort" not in below
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def _states(spark, sets):
    """Stored bitmaps of value v0, v1 ... from sets of uids, one day each."""
    rows = [(str(u), "t", f"v{i}", d) for i, days in enumerate(sets) for d, uids in enumerate(days) for u in uids]
    long = spark.createDataFrame(rows, "uid string, tag_code string, tag_value string, d int")
    parts = [ops.build_bitmaps(long.where(f"d = {d}").drop("d"), f"2000-01-0{d + 1}") for d in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def test_runs_are_stored_as_runs_and_forms_unite(spark):
    full, odd, few = range(1, 32769), range(1, 32769, 2), [5, 9, 10, 11]
    sets = [
        [full, few, []],                                   # one run; positions inside it
        [odd, range(2, 32769, 2), []],                     # two bitmaps that unite to one run
        [few, [5, 5, 12, 70_000], [0]],                    # repeated users, other buckets
        [range(100, 3000), range(2990, 9000), [9000]],     # runs that join
        [range(1, 2100, 2), range(50_000, 50_010), []],
    ]
    stored = _states(spark, sets).cache()
    one = {(r["tag_value"], r["bucket"], r["dt"]): len(bytes(r["us"])) for r in stored.collect()}
    assert one[("v0", 1, "20000101")] == 5 and one[("v1", 1, "20000101")] == 4096 and one[("v3", 1, "20000101")] == 5
    assert one[("v2", 1, "20000101")] == 8 and all(n < 100 for (v, *_), n in one.items() if v in ("v0", "v3"))
    sizes = stored.select("users", bm.users_in("us").alias("n")).collect()
    assert all(r["users"] == r["n"] for r in sizes)
    back = {}
    for r in bm.decode(stored, ["tag_value", "dt"]).collect():
        back.setdefault((r["tag_value"], r["dt"]), set()).add(r["uid"])
    assert back == {(f"v{i}", f"2000010{d + 1}"): set(u) for i, days in enumerate(sets) for d, u in enumerate(days) if len(u)}
    merged = ops.merge_days(stored).cache()
    whole = {}
    for r in bm.decode(merged, ["tag_value"]).collect():
        whole.setdefault(r["tag_value"], set()).add(r["uid"])
    assert whole == {f"v{i}": set().union(*days) for i, days in enumerate(sets)}
    assert {r["tag_value"]: r["users"] for r in ops.cardinality(merged).collect()} == {k: len(v) for k, v in whole.items()}
    assert [len(bytes(r["us"])) for r in merged.where("tag_value = 'v1'").collect()] == [5]
    # The form of a united state is the form that its users would get at once.
    again = ops.build_bitmaps(bm.decode(merged, ["tag_code", "tag_value"]).withColumn("uid", F.col("uid").cast("string")))
    assert sorted(map(tuple, again.select(*ops.STATE_KEY, "us", "users").collect())) == sorted(
        map(tuple, merged.select(*ops.STATE_KEY, "us", "users").collect()))
    dense = bm.dense(stored.where("dt = '20000101'"), list(ops.STATE_KEY))
    assert dense.agg(F.sum(F.bitmap_count("us"))).first()[0] == stored.where("dt = '20000101'").agg(F.sum("users")).first()[0]
    stored.unpersist()
    merged.unpersist()


def test_empty_days_unite_to_nothing(spark):
    none = spark.createDataFrame([], "uid string, tag_code string, tag_value string")
    assert ops.merge_days(ops.build_bitmaps(none, "2000-01-01")).count() == 0


def test_states_do_not_depend_on_batches(spark):
    """Groups cut by batch borders, one group over many batches, null values and repeated rows."""
    many = spark.range(1, 30_000).selectExpr("cast(id * 2 as string) uid", "'t' tag_code", "'big' tag_value")
    few = spark.range(1, 500).selectExpr("cast(id as string) uid", "'t' tag_code", "concat('v', id % 90) tag_value")
    null = spark.createDataFrame([("7", "t", None), ("8", None, None), ("9", None, "v1"), ("0", "t", "v1")], "uid string, tag_code string, tag_value string")
    cells = many.unionByName(many.limit(9000)).unionByName(few).unionByName(few).unionByName(null)
    want = sorted(map(str, ops.build_bitmaps(cells).collect()))
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    try:
        for rows in (1, 7, 1000):
            spark.conf.set(conf, str(rows))
            part = cells if rows > 1 else cells.where("tag_value is null or tag_value != 'big'")
            got = sorted(map(str, ops.build_bitmaps(part).collect()))
            assert got == (want if rows > 1 else [r for r in want if "'big'" not in r])
    finally:
        spark.conf.set(conf, before)
