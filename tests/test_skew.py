"""Hot keys: results stay whole and equal a brute-force computation."""

import random

import pandas as pd
from pyspark.sql import functions as F

from tagweave.functions.bitmap import decode
from tagweave.operators.bitmap import build_bitmaps, cardinality
from tagweave.operators import merge
from tagweave.operators.merge import merge_tags


def test_hot_user_with_duplicates(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.choice("abc")) for _ in range(6000)]          # one user: most rows
    rows += [(str(u), rnd.choice("abcdef")) for u in range(500) for _ in range(2)]
    rows += [("hot", None)] * 50
    frame = spark.createDataFrame(rows, "uid string, tag_value string").repartition(8)
    other = spark.createDataFrame([(str(u), str(u % 3)) for u in range(0, 500, 7)], "uid string, tag_value string")
    for method in ("pivot", "map"):
        wide = merge_tags([("TAG_HOT", frame), ("TAG_OTHER", other)], method=method)
        got = {r.uid: (r.tag_hot, r.tag_other) for r in wide.collect()}
        pdf = pd.DataFrame(rows, columns=["uid", "v"])
        want_hot = {u: ",".join(sorted(g.dropna().tolist())) for u, g in pdf.groupby("uid")["v"]}
        want_other = {str(u): str(u % 3) for u in range(0, 500, 7)}
        assert set(got) == set(want_hot)
        for uid, (hot, oth) in got.items():
            assert hot == want_hot[uid]
            assert oth == want_other.get(uid, "")


def test_value_held_by_most_users_spreads_over_buckets(spark):
    uids = list(range(0, 200_000, 2))
    long = spark.createDataFrame([(str(u), "gender", "M") for u in uids] +
                                 [("7", "gender", "F")], "uid string, tag_code string, tag_value string")
    bitmaps = build_bitmaps(long)
    hot = bitmaps.filter(F.col("tag_value") == "M")
    assert hot.count() == len({0 if u == 0 else (u - 1) // 32768 + 1 for u in uids})
    assert cardinality(bitmaps).filter(F.col("tag_value") == "M").first().users == len(uids)
    back = decode(hot, ["tag_value"]).select("uid")
    assert back.count() == len(uids) and back.agg(F.sum("uid")).first()[0] == sum(uids)


def _partition_sizes(df):
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())


def test_heavy_users_are_measured_and_spread(spark):
    """30 % of the rows on one user, 10 % on the NULL user: nobody's task gets over twice the median."""
    n = 100_000
    rows = (spark.range(n).selectExpr(
        "case when id % 10 < 3 then 'hot' when id % 10 = 3 then null else cast(id % 5000 as string) end uid",
        "case when id % 2 = 0 then 'A' else 'B' end tag_name",
        # a third of the hot rows repeat one value; the others are all different; some are NULL
        "case when id % 3 = 0 then 'same' when id % 101 = 0 then null else concat('v', id) end tag_value"))
    heavy = merge.heavy_users(rows, share=0.05, sample=0.2)
    assert heavy == ["hot", None]
    is_heavy = merge._is_heavy(heavy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        light = rows.filter(~is_heavy).repartition("uid")
        counted = rows.filter(is_heavy).groupBy("uid", "tag_name", "tag_value").count()
        for dealt in (light, counted, counted.repartitionByRange("uid", "tag_name", "tag_value")):
            sizes = _partition_sizes(dealt)
            assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = sorted(map(str, merge.pivot_wide(rows, ["A", "B"]).collect()))
    for found in (heavy, ["hot"], [None], ["hot", "17", None, "no such user"], []):
        assert sorted(map(str, merge.split_wide(rows, ["A", "B"], found).collect())) == whole


def test_heavy_cells_keep_empty_texts_nulls_and_duplicates(spark):
    rows = [("h", "A", v) for v in ("b", "", "a", "", None, "b", "a,b")] + [("h", "B", None), (None, "A", ""), ("x", "B", "1")]
    long = spark.createDataFrame(rows, "uid string, tag_name string, tag_value string").repartition(4)
    want = sorted(map(str, merge.pivot_wide(long, ["A", "B"]).collect()))
    assert sorted(map(str, merge.split_wide(long, ["A", "B"], ["h", None]).collect())) == want
    assert merge.heavy_users(long.limit(0)) == []
    assert merge.heavy_users(long, sample=1.0) == [] and merge.heavy_users(long, share=0.5, sample=1.0, least=1) == ["h"]
