import pytest
from pyspark.sql import types as T

from tagweave.operators.export import read_sorted, write_sorted
from tagweave.sources.tables import TagStore
from tagweave.sources.text import read_tsv, write_tsv


def test_static_partition_overwrite(spark, tmp_root):
    store = TagStore(spark, tmp_root)
    day1 = spark.createDataFrame([("1", 5), ("2", 6)], "uid string, tag_value bigint")
    day2 = spark.createDataFrame([("1", 7)], "uid string, tag_value bigint")
    store.write_tag_day("TAG_X", "1", day1, "2021-01-01")
    store.write_tag_day("TAG_X", "1", day2, "2021-01-02")
    store.write_tag_day("TAG_X", "1", day2, "2021-01-02")  # rerun is idempotent
    assert store.read_tag_day("TAG_X", "1", "2021-01-01").count() == 2
    assert store.read_tag_day("TAG_X", "1", "2021-01-02").count() == 1
    store.write_tag_day("TAG_X", "1", spark.createDataFrame([], "uid string, tag_value bigint"), "2021-01-02")
    assert store.read_tag_day("TAG_X", "1", "2021-01-02").count() == 0  # empty result clears the day
    assert store.read_tag_table("TAG_X", "1").count() == 2                # other days untouched
    assert store.read_tag_table("TAG_X", "1").schema["dt"].dataType == T.StringType()


def test_partition_filter_is_pruned(spark, tmp_root):
    store = TagStore(spark, tmp_root)
    df = spark.createDataFrame([("1", "a")], "uid string, tag_value string")
    store.write_tag_day("TAG_S", "3", df, "2021-01-01")
    plan = store.read_tag_table("TAG_S", "3").where("dt = '2021-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


@pytest.mark.parametrize("codec", ["gzip", "bzip2", "deflate"])
def test_tsv_roundtrip_keeps_tabs_and_nulls(spark, tmp_root, codec):
    df = spark.createDataFrame([("1", "a\tb"), ("2", None), ("3", "")], "uid string, tag_value string")
    write_tsv(df, tmp_root + "/t", compression=codec)
    back = read_tsv(spark, tmp_root + "/t", df.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [("1", "a\tb"), ("2", None), ("3", "")]


def test_sorted_export(spark, tmp_root):
    wide = spark.createDataFrame([(str(i), str(i % 3)) for i in range(200, 0, -1)], "uid string, t string")
    write_sorted(wide, tmp_root + "/e", num_partitions=4)
    back = read_sorted(spark, tmp_root + "/e")
    assert back.schema["uid"].dataType == T.LongType() and back.count() == 200
    for part in back.rdd.glom().collect():
        uids = [r.uid for r in part]
        assert uids == sorted(uids)


def test_catalog_tag_tables(spark, tmp_root):
    store = TagStore(spark, tmp_root, catalog_tables=True)
    a = spark.createDataFrame([("1", 5), ("2", 6)], "uid string, tag_value bigint")
    store.write_tag_day("TAG_CAT_X", "1", a, "2021-01-01")
    store.write_tag_day("TAG_CAT_X", "1", a.limit(1), "2021-01-02")
    assert spark.sql("select count(*) from tag_cat_x where dt = '2021-01-01'").first()[0] == 2
    assert spark.sql("select count(*) from tag_cat_x").first()[0] == 3
    assert spark.table("tag_cat_x").schema["tag_value"].dataType == T.LongType()
    store.write_tag_day("TAG_CAT_X", "1", a.limit(0), "2021-01-01")  # empty day clears
    assert spark.sql("select count(*) from tag_cat_x").first()[0] == 1
    with pytest.raises(ValueError):
        store.tag_table_name("bad name; drop")
    spark.sql("DROP TABLE tag_cat_x")


def test_register_tables_skips_missing(spark, tmp_root):
    from tagweave.sources.tables import register_tables
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_root}/probe_present.parquet")
    assert register_tables(spark, tmp_root, names=("probe_present", "probe_missing")) == ["probe_present"]
    assert spark.table("probe_present").columns == ["x"]
    spark.catalog.dropTempView("probe_present")
