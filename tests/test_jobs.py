"""The daily flow: tag tables -> wide table -> bitmap tables, on sf0.001."""

import pytest
from pyspark.sql import functions as F

from tagweave.functions.bitmap import decode
from tagweave.plans import jobs
from tagweave.plans.profile import RULES, TAGS, TASKS, demo_catalog
from tagweave.sources.catalog import active_tag_list, catalog_from_rows
from tagweave.sources.tables import TagStore, register_tables

from conftest import SF_SMALL

DAY = "2000-01-01"


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    register_tables(spark, SF_SMALL)
    catalog = demo_catalog(spark)
    store = TagStore(spark, str(tmp_path_factory.mktemp("flow")))
    for tag in active_tag_list(catalog):
        jobs.tag_job(spark, catalog, tag.tag_task_id, DAY, store)
    wide = jobs.merge_job(spark, catalog, DAY, store)
    return catalog, store, wide


def test_stored_flow_equals_in_plan_merge(spark, flow):
    catalog, _, wide = flow
    _, direct = jobs.wide_frame(spark, catalog, DAY)
    assert wide.columns == direct.columns
    assert wide.exceptAll(direct).count() == 0 and direct.exceptAll(wide).count() == 0


def test_bitmaps_cover_every_cell(spark, flow):
    catalog, store, wide = flow
    tables = jobs.bitmap_job(spark, catalog, DAY, store)
    decoded = decode(jobs.all_bitmaps(tables), ["tag_code", "tag_value"])
    cells = wide.unpivot("uid", [c for c in wide.columns if c != "uid"], "tag_code", "tag_value") \
        .filter(F.col("tag_value") != "").select("tag_code", "tag_value", F.col("uid").cast("long"))
    assert decoded.exceptAll(cells).count() == 0 and cells.exceptAll(decoded).count() == 0


def test_deactivated_type_is_cleared_on_rerun(spark, flow):
    _, store, _ = flow
    jobs.bitmap_job(spark, demo_catalog(spark), DAY, store)
    assert store.read_bitmap_day("2", DAY).count() > 0
    # switch off the only decimal tag's task and rerun the day
    tasks = [dict(t, task_status="0") if t["id"] == 3 else t for t in TASKS]
    smaller = catalog_from_rows(spark, tasks, TAGS, RULES)
    jobs.bitmap_job(spark, smaller, DAY, store)
    assert store.read_bitmap_day("2", DAY).count() == 0
    assert store.read_bitmap_day("3", DAY).count() > 0


def test_stored_tables_queryable_by_name(spark, flow):
    catalog, store, _ = flow
    jobs.bitmap_job(spark, catalog, DAY, store)
    names = store.register_views(active_tag_list(catalog), dts=[DAY], value_types=["3"])
    assert "tag_order_count" in names and "up_tag_merge_20000101" in names
    n = spark.sql(f"select count(*) from tag_order_count where dt = '{DAY}'").first()[0]
    assert n == store.read_tag_day("TAG_ORDER_COUNT", "1", DAY).count() > 0
    users = spark.sql("select sum(users) from user_tag_value_string "
                      "where dt = '20000101' and tag_code = 'tag_base_segment' and tag_value = 'Furn'").first()[0]
    wide = spark.sql("select count(*) from up_tag_merge_20000101 where tag_base_segment = 'Furn'").first()[0]
    assert users == wide > 0
    for name in names:
        spark.catalog.dropTempView(name)


def test_catalog_table_mode_for_wide_and_bitmaps(spark, tmp_path_factory):
    register_tables(spark, SF_SMALL)
    catalog = demo_catalog(spark)
    for view in [t.column for t in active_tag_list(catalog)] + ["up_tag_merge_20000101"]:
        spark.catalog.dropTempView(view)  # temp views would shadow the catalog tables
    store = TagStore(spark, str(tmp_path_factory.mktemp("cat")), catalog_tables=True)
    for tag in active_tag_list(catalog):
        jobs.tag_job(spark, catalog, tag.tag_task_id, DAY, store)
    wide = jobs.merge_job(spark, catalog, DAY, store)
    jobs.bitmap_job(spark, catalog, DAY, store)
    n_users = wide.count()
    assert spark.sql("select count(*) from up_tag_merge_20000101").first()[0] == n_users
    furn = spark.sql("select sum(users) from user_tag_value_string where dt = '20000101' "
                     "and tag_code = 'tag_base_segment' and tag_value = 'Furn'").first()[0]
    assert furn == wide.filter(F.col("tag_base_segment") == "Furn").count()
    jobs.merge_job(spark, catalog, DAY, store)  # rerun drops and recreates the day's table
    assert spark.sql("select count(*) from up_tag_merge_20000101").first()[0] == n_users
    for t in ["up_tag_merge_20000101", "user_tag_value_long", "user_tag_value_decimal", "user_tag_value_string",
              "user_tag_value_date"] + [t.column for t in active_tag_list(catalog)]:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
