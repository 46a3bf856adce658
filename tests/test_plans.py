"""Physical-plan shape: the scale design, checked so it cannot regress silently."""

import re

from tagweave.plans import registry
from tagweave.sources.tables import TagStore

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _merge_part(plan: str) -> str:
    """The plan above the union of the tag frames."""
    return plan.split("Union")[0]


def test_wide_merge_is_one_uid_shuffle_with_partial_collect(spark):
    top = _merge_part(_plan(registry.wide_pivot(spark, SF_SMALL)))
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", top)
    assert len(exchanges) == 1 and exchanges[0][0] == "hashpartitioning"
    assert exchanges[0][1].startswith("uid#")
    assert "partial_collect_list" in top


def test_preaggregated_merge_adds_one_counting_shuffle(spark):
    top = _merge_part(_plan(registry.wide_pivot_preagg(spark, SF_SMALL)))
    assert len(re.findall(r"Exchange hashpartitioning", top)) == 2
    assert "partial_count" in top


def test_bitmaps_shuffle_cells_once_on_full_key(spark):
    plan = _plan(registry._bitmaps(spark, SF_SMALL))
    above = plan.split("Exchange hashpartitioning(uid")[0]  # everything after the merge
    assert re.search(r"Exchange hashpartitioning\(tag_code#\d+, tag_value#\d+, bucket#\d+L?, \d+\), REPARTITION_BY_COL",
                     above)
    below_cells_exchange = above.split("REPARTITION_BY_COL")[1]
    assert "bitmap_construct_agg" not in below_cells_exchange  # no map-side partial bitmaps


def test_rule_join_broadcasts_the_rule_side(spark):
    plan = _plan(registry.tag_rule_join(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftOuter, BuildRight" in plan
    assert "SortMergeJoin" not in plan


def test_tag_scans_are_pruned_and_filtered(spark):
    plan = _plan(registry.tag_passthrough(spark, SF_SMALL))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in plan


def test_day_read_is_partition_pruned(spark, tmp_root):
    store = TagStore(spark, tmp_root)
    df = spark.createDataFrame([("1", 2)], "uid string, tag_value bigint")
    store.write_tag_day("TAG_X", "1", df, "2021-01-01")
    store.write_tag_day("TAG_X", "1", df, "2021-01-02")
    files = store.read_tag_day("TAG_X", "1", "2021-01-02").inputFiles()
    assert files and all("dt=2021-01-02/" in f for f in files)  # the other day is not even listed
    plan = _plan(store.read_tag_table("TAG_X", "1").where("dt = '2021-01-02'"))
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt#" in plan


def test_audience_filter_below_bitmap_build(spark):
    plan = _plan(registry.audience_and(spark, SF_SMALL))
    cells_side = plan.split("REPARTITION_BY_COL")[1]
    assert "tag_base_segment" in cells_side.split("Expand")[0]  # condition filter sits under the exchange
