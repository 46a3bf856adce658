"""Day replacement: a failed rerun keeps the old day, bad dates never reach a write, reads list one day."""

import pytest
from pyspark.sql import functions as F

from tagweave.functions.values import date_token
from tagweave.operators import bitmap as bitmap_ops
from tagweave.plans import jobs
from tagweave.plans.profile import demo_catalog
from tagweave.sources.tables import TagStore, register_tables
from tagweave.sources.text import read_tsv, write_tsv

from conftest import SF_SMALL

DT = "2000-01-01"


def _values(spark, n):
    return spark.range(n).selectExpr("cast(id as string) uid", "id tag_value")


def _failing(spark):
    return spark.range(3).select(F.col("id").cast("string").alias("uid"),
                                 F.when(F.col("id") == 2, F.raise_error(F.lit("broken source"))).otherwise(F.col("id"))
                                 .cast("long").alias("tag_value"))


def test_failed_rerun_keeps_the_day(spark, tmp_root):
    store = TagStore(spark, tmp_root)
    store.write_tag_day("T", "1", _values(spark, 5), DT)
    with pytest.raises(Exception, match="broken source"):
        store.write_tag_day("T", "1", _failing(spark), DT)
    assert store.read_tag_day("T", "1", DT).count() == 5
    wide = _values(spark, 4).withColumnRenamed("tag_value", "t")
    store.write_wide(wide, DT)
    with pytest.raises(Exception, match="broken source"):
        store.write_wide(_failing(spark), DT)
    assert store.read_wide(DT).count() == 4
    bits = bitmap_ops.build_bitmaps(_values(spark, 4).selectExpr("uid", "'t' tag_code", "'v' tag_value"))
    store.write_bitmap_day("1", bits, DT)
    with pytest.raises(Exception, match="broken source"):
        store.write_bitmap_day("1", bitmap_ops.build_bitmaps(
            _failing(spark).selectExpr("uid", "'t' tag_code", "cast(tag_value as string) tag_value")), DT)
    assert store.read_bitmap_day("1", DT).count() == bits.count()
    store.write_tag_day("T", "1", _values(spark, 2), DT)
    assert store.read_tag_table("T", "1").count() == 2  # no staged or old folder shows


@pytest.mark.parametrize("bad", ["20000101", "2000-01-01\n", "2000-01-01' or '1"])
def test_bad_dates_raise_before_any_write(spark, tmp_root, bad):
    register_tables(spark, SF_SMALL)
    catalog, store = demo_catalog(spark), TagStore(spark, tmp_root)
    store.write_wide(_values(spark, 3), DT)
    for run in (lambda: jobs.tag_job(spark, catalog, 2, bad, store), lambda: jobs.merge_job(spark, catalog, bad, store),
                lambda: jobs.bitmap_job(spark, catalog, bad, store), lambda: store.write_wide(_values(spark, 1), bad),
                lambda: store.write_tag_day("T", "1", _values(spark, 1), bad)):
        with pytest.raises(ValueError):
            run()
    assert store.read_wide(DT).count() == 3


def test_a_day_read_lists_that_day_only(spark, tmp_root):
    store = TagStore(spark, tmp_root)
    for day in ("1999-12-31", DT, "2000-01-02"):
        store.write_tag_day("T", "1", _values(spark, 3).repartition(2), day)
    files = store.read_tag_day("T", "1", DT).inputFiles()
    assert files and all(f"dt={DT}/" in f for f in files)
    assert store.read_tag_day("T", "1", "2001-01-01").count() == 0
    assert store.read_bitmap_day("1", DT).count() == 0
    assert date_token(DT) == "20000101"


def test_catalog_table_has_comments(spark, tmp_root):
    store = TagStore(spark, tmp_root, catalog_tables=True)
    store.write_tag_day("T_COMMENTED", "1", _values(spark, 3), DT, "order's count")
    store.write_tag_day("T_COMMENTED", "1", _values(spark, 2), "2000-01-02", "order's count")
    assert spark.table("t_commented").groupBy("dt").count().count() == 2
    said = {r["col_name"]: r for r in spark.sql("describe table extended t_commented").collect()}
    assert said["uid"]["comment"] == "user id" and said["Comment"]["data_type"] == "order's count"
    store.write_wide(_values(spark, 2), DT, {"tag_value": "how many"})
    assert {r["col_name"]: r["comment"] for r in spark.sql("describe table up_tag_merge_20000101").collect()}["tag_value"] == "how many"
    spark.sql("drop table t_commented")
    spark.sql("drop table up_tag_merge_20000101")


def test_text_round_trip_keeps_every_value(spark, tmp_root):
    rows = [(" a ", 1), ("line\nbreak\rand\ttab", 2), ("\\N", 3), (None, None), ("", 5), ("\\", 6), ("\\n", 7), ("a\\\\tb", 8),
            ('say "hi"', 9)]
    df = spark.createDataFrame(rows, "v string, n bigint")
    for codec in ("gzip", "bzip2"):
        write_tsv(df, f"{tmp_root}/{codec}", codec)
        back = read_tsv(spark, f"{tmp_root}/{codec}", df.schema)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    write_tsv(spark.createDataFrame([("x",)], "v string"), f"{tmp_root}/bad", "gzip")
    with pytest.raises(Exception, match="cells"):
        read_tsv(spark, f"{tmp_root}/bad", df.schema).collect()


def test_a_reader_between_write_and_swap_sees_the_old_day(spark, tmp_root, monkeypatch):
    store = TagStore(spark, tmp_root, catalog_tables=True)
    seen, swap = [], TagStore._swap_in

    def watched(self, name, day, folder):
        seen.append(spark.table(name).where(F.col("dt") == day).count())  # the new folder is complete already
        swap(self, name, day, folder)

    monkeypatch.setattr(TagStore, "_swap_in", watched)
    try:
        store.write_tag_day("T_SWAP", "1", _values(spark, 5), DT)
        store.write_tag_day("T_SWAP", "1", _values(spark, 3), DT)
        assert seen == [0, 5] and spark.table("t_swap").count() == 3
        with pytest.raises(Exception, match="broken source"):
            store.write_tag_day("T_SWAP", "1", _failing(spark), DT)
        assert store.read_tag_day("T_SWAP", "1", DT).count() == 3 and len(seen) == 2
        kept = [f.name for f in __import__("pathlib").Path(f"{tmp_root}/t_swap").iterdir() if f.is_dir()]
        assert len(kept) == 1  # replaced and failed folders are gone
        bits = bitmap_ops.build_bitmaps(_values(spark, 4).selectExpr("uid", "'t' tag_code", "'v' tag_value"))
        for _ in range(2):
            store.write_bitmap_day("1", bits, DT)
        assert store.read_bitmap_day("1", DT).count() == bits.count()
        assert store.read_bitmap_days("1", "1999-12-31", DT).count() == bits.count()
    finally:
        spark.sql("drop table if exists t_swap")
        spark.sql("drop table if exists user_tag_value_long")


@pytest.mark.parametrize("catalog_tables", [False, True])
def test_many_days_in_one_job(spark, tmp_root, catalog_tables):
    store = TagStore(spark, tmp_root, catalog_tables=catalog_tables)
    days = jobs.days_between("1999-12-30", "2000-01-02")
    assert days == ["1999-12-30", "1999-12-31", DT, "2000-01-02"]
    try:
        for d in ("1999-12-29", "1999-12-31", DT):
            store.write_tag_day("T_DAYS", "1", _values(spark, 9), d)
        rows = spark.createDataFrame([("1", 1, DT), ("2", 2, DT), ("1", 3, "2000-01-02")], "uid string, tag_value bigint, dt string")
        store.write_tag_days("T_DAYS", "1", rows, days)
        got = {r["dt"]: r["count"] for r in store.read_tag_table("T_DAYS", "1").groupBy("dt").count().collect()}
        assert got == {"1999-12-29": 9, DT: 2, "2000-01-02": 1}  # days without rows are cleared, others stay
        store.write_tag_days("T_DAYS", "1", rows.limit(0), days)
        assert {r["dt"] for r in store.read_tag_table("T_DAYS", "1").collect()} == {"1999-12-29"}
        with pytest.raises(Exception, match="not a day to replace"):
            store.write_tag_days("T_DAYS", "1", rows, ["1999-12-29", DT])
        assert store.read_tag_day("T_DAYS", "1", "1999-12-29").count() == 9
    finally:
        spark.sql("drop table if exists t_days")
    with pytest.raises(ValueError):
        jobs.days_between(DT, "1999-12-31")


def test_one_large_text_table_is_read_by_many_tasks(spark, tmp_root):
    df = spark.range(50_000).selectExpr("cast(id as string) uid", "sha2(cast(id as string), 256) tag_value").coalesce(1)
    write_tsv(df, f"{tmp_root}/gzip", "gzip", max_rows=5000)
    write_tsv(df, f"{tmp_root}/bzip2", "bzip2")
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        for kind, files in (("gzip", 10), ("bzip2", 1)):
            back = read_tsv(spark, f"{tmp_root}/{kind}", df.schema)
            assert len(back.inputFiles()) == files and back.rdd.getNumPartitions() > 1
            assert back.exceptAll(df).count() == 0 and back.count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
