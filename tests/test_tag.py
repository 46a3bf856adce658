import pytest
from pyspark.sql import functions as F

from tagweave.operators.tag import (compute_tag, map_values_case, map_values_join, passthrough, plan_active,
                                    plan_tasks, run_task_sql)
from tagweave.plans.profile import demo_catalog
from tagweave.sources.catalog import active_tag_list, catalog_from_rows, lookup_one, task_rules
from tagweave.sources.tables import register_tables

from conftest import SF_SMALL


def _rules_df(spark, rules):
    return spark.createDataFrame([(i + 1, q, v) for i, (q, v) in enumerate(rules)],
                                 "id long, query_value string, sub_tag_value string")


def test_case_first_match_and_null_for_unmatched(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None)], "uid long, query_value string")
    rules = [("a", "A1"), ("b", "B"), ("a", "A2")]
    case = {r.uid: r.tag_value for r in map_values_case(src, rules, "3").collect()}
    assert case == {"1": "A1", "2": "B", "3": None, "4": None}
    join = {r.uid: r.tag_value for r in map_values_join(src, _rules_df(spark, rules), "3").collect()}
    assert join == case


def test_numeric_query_value_against_quoted_rules(spark):
    src = spark.createDataFrame([(1, 0), (2, 1), (3, 7)], "uid long, query_value int")
    rules = [("0", "10"), ("1", "11"), ("x", "99")]
    case = {r.uid: r.tag_value for r in map_values_case(src, rules, "1").collect()}
    assert case == {"1": 10, "2": 11, "3": None}
    join = {r.uid: r.tag_value for r in map_values_join(src, _rules_df(spark, rules), "1").collect()}
    assert join == case


def test_passthrough_types(spark):
    src = spark.createDataFrame([(1, 35)], "uid int, query_value int")
    out = passthrough(src, "1")
    assert out.schema["uid"].dataType.simpleString() == "string"
    assert out.schema["tag_value"].dataType.simpleString() == "bigint"
    with pytest.raises(TypeError):
        passthrough(spark.createDataFrame([(1, "x")], "uid int, query_value string"), "2")


def test_task_sql_must_give_uid_and_query_value(spark):
    with pytest.raises(ValueError, match="query_value"):
        run_task_sql(spark, "select 1 as uid, 2 as v", "2000-01-01")


def test_catalog_lookups(spark):
    cat = demo_catalog(spark)
    assert lookup_one(cat.task_info, "id", 2).task_name == "order count"
    with pytest.raises(LookupError):
        lookup_one(cat.task_info, "id", 999, what="task")
    with pytest.raises(LookupError):
        plan_tasks(cat, [999])
    tags = active_tag_list(cat)
    assert [t.tag_code for t in tags] == ["TAG_BASE_SEGMENT", "TAG_ORDER_COUNT", "TAG_ORDER_AMOUNT",
                                          "TAG_LAST_ORDER", "TAG_PRIORITY", "TAG_NATION_GROUP",
                                          "TAG_EVENT_COUNT", "TAG_EVENT_TYPES"]
    assert [p.tag.tag_code for p in plan_active(cat)] == [t.tag_code for t in tags]


def test_rules_join_drops_missing_sub_tag(spark):
    cat = demo_catalog(spark)
    rules = task_rules(cat, 1).orderBy("id").collect()
    assert [(r.id, r.query_value, r.sub_tag_value) for r in rules] == [
        (1, "FURNITURE", "Furn"), (2, "BUILDING", "Build"), (3, "MACHINERY", "Mach"),
        (4, "AUTOMOBILE", "Auto"), (5, "FURNITURE", "Furniture")]
    plan = plan_tasks(cat, [1])[1]
    assert plan.rule_count == 5 and plan.rules[0] == ("FURNITURE", "Furn")


def test_no_active_tags_raises(spark):
    cat = catalog_from_rows(spark, [dict(id=1, task_status="0", task_sql="select 1 uid, 1 query_value")],
                            [dict(id=1, tag_code="T", tag_value_type="1", tag_task_id=1)], [])
    with pytest.raises(ValueError, match="no active tags"):
        active_tag_list(cat)


def test_compute_tag_case_equals_join(spark):
    register_tables(spark, SF_SMALL)
    cat = demo_catalog(spark)
    for task in (1, 6):
        a = compute_tag(spark, cat, task, "2000-01-01", "case").values
        b = compute_tag(spark, cat, task, "2000-01-01", "join").values
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    seg = compute_tag(spark, cat, 1, "2000-01-01").values
    assert seg.filter(F.col("tag_value") == "Furniture").count() == 0  # rule 5 never wins


def test_many_rules_switch_to_join_form(spark):
    register_tables(spark, SF_SMALL)
    rules, subs = [], []
    for i in range(150):  # more than CASE_RULE_LIMIT: the auto form is the join
        rules.append(dict(id=i + 1, tag_id=1, task_id=1, query_value=str(i), sub_tag_id=1000 + i))
        subs.append(dict(id=1000 + i, tag_code=f"N{i}", tag_name=f"n{i % 7}", tag_value_type="3"))
    cat = catalog_from_rows(spark, [dict(id=1, task_status="1",
                                         task_sql="select c_custkey uid, c_nationkey query_value from customer")],
                            [dict(id=1, tag_code="TAG_N", tag_value_type="3", tag_task_id=1)] + subs, rules)
    plan = plan_tasks(cat, [1])[1]
    assert plan.rule_count == 150 and plan.rules is None
    auto = compute_tag(spark, cat, 1, "2000-01-01").values
    with pytest.raises(ValueError, match="CASE form"):  # the form is refused beyond its limit, not silently grown
        compute_tag(spark, cat, 1, "2000-01-01", "case")
    pairs = [(r["query_value"], subs[r["id"] - 1]["tag_name"]) for r in rules]
    case = map_values_case(run_task_sql(spark, plan.task_sql, "2000-01-01"), pairs, "3")
    assert "BroadcastHashJoin" in auto._jdf.queryExecution().executedPlan().toString()
    assert auto.exceptAll(case).count() == 0 and case.exceptAll(auto).count() == 0
    assert auto.filter(F.col("tag_value").isNull()).count() == 0  # nation keys 0..24 all have rules


def test_join_form_dedupes_after_type_conversion(spark):
    src = spark.createDataFrame([(1, 1), (2, 2)], "uid long, query_value int")
    rules = [("1", "first"), ("01", "second"), ("2", "two")]
    case = sorted(map(tuple, map_values_case(src, rules, "3").collect()))
    join = sorted(map(tuple, map_values_join(src, _rules_df(spark, rules), "3").collect()))
    assert case == join == [("1", "first"), ("2", "two")]
