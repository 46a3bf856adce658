"""No cap on tasks, tags or rules, and both rule forms agree on either side of the switch."""

from decimal import Decimal

import pytest

from tagweave.operators import tag as tag_ops
from tagweave.operators.tag import CASE_RULE_LIMIT, build_tag, plan_active, plan_tasks
from tagweave.sources.catalog import Catalog, active_tag_list, catalog_from_rows, rows_as_json


def test_every_active_tag_is_listed(spark):
    """6000 active tasks, the 500 tagged ones at the end."""
    tasks = [{"id": i, "task_status": "1", "task_sql": "select 1 uid, 1 query_value"} for i in range(6000)]
    tags = [{"id": 10_000 + i, "tag_code": f"T{i}", "tag_name": f"t{i}", "tag_value_type": "1", "tag_task_id": 5500 + i}
            for i in range(500)]
    catalog = catalog_from_rows(spark, tasks, tags, [])
    listed = active_tag_list(catalog)
    assert len(listed) == 500
    assert [p.tag for p in plan_active(catalog)] == listed


def _catalog(spark, rules, value_type="1", sql="select * from rule_source"):
    """``rules``: (query_value, mapped text); rule and sub-tag tables are Spark frames of any size."""
    base = catalog_from_rows(spark, [{"id": 1, "task_status": "1", "task_sql": sql}],
                             [{"id": 1, "tag_code": "T", "tag_name": "t", "tag_value_type": value_type, "tag_task_id": 1}], [])
    frame = spark.createDataFrame([(i, 1, 1, q, 100 + i, v) for i, (q, v) in enumerate(rules)],
                                  "id long, tag_id long, task_id long, query_value string, sub_tag_id long, v string")
    subs = frame.selectExpr("sub_tag_id as id", "v as tag_name")
    return Catalog(base.task_info, base.tag_info.unionByName(subs, allowMissingColumns=True), frame.drop("v"))


@pytest.mark.parametrize("n", [CASE_RULE_LIMIT, CASE_RULE_LIMIT + 1])
@pytest.mark.parametrize("method", ["auto", "join"])
def test_forms_agree_around_the_limit(spark, n, method):
    spark.createDataFrame([("u1", Decimal("1.00")), ("u2", Decimal("2.50")), ("u3", None)],
                          "uid string, query_value decimal(10,2)").createOrReplaceTempView("rule_source")
    rules = [("1.004", "99"), ("1.0", "7"), ("1", "8"), ("x", "not a number")] + [(str(1000 + i), str(i)) for i in range(n - 4)]
    catalog = _catalog(spark, rules)
    plan = plan_tasks(catalog, [1])[1]
    assert plan.rule_count == n and (plan.rules is None) == (n > CASE_RULE_LIMIT)
    got = {r.uid: r.tag_value for r in build_tag(spark, catalog, plan, "2000-01-01", method).values.collect()}
    assert got == {"u1": 7, "u2": None, "u3": None}
    # A row that takes a rule whose text is no number fails in either form.
    bad = _catalog(spark, [("1", "1_000")] + rules[3:])
    with pytest.raises(Exception, match="not a number"):
        build_tag(spark, bad, plan_tasks(bad, [1])[1], "2000-01-01", method).values.collect()


def test_many_rules_use_the_shuffle_join(spark, monkeypatch):
    spark.range(3).selectExpr("cast(id as string) uid", "id * 40000 as query_value").createOrReplaceTempView("rule_source")
    big = spark.range(100_001).selectExpr("id", "1L tag_id", "1L task_id", "cast(id as string) query_value",
                                          "id + 1000 as sub_tag_id")
    base = _catalog(spark, [("0", "0")])
    subs = spark.range(100_001).selectExpr("id + 1000 as id", "cast(id + 5 as string) as tag_name")
    catalog = Catalog(base.task_info, base.tag_info.where("id = 1").unionByName(subs, allowMissingColumns=True), big)
    plan = plan_tasks(catalog, [1])[1]
    assert plan.rule_count == 100_001 and plan.rules is None and not plan.broadcast_rules
    values = build_tag(spark, catalog, plan, "2000-01-01").values
    assert sorted((r.uid, r.tag_value) for r in values.collect()) == [("0", 5), ("1", 40005), ("2", 80005)]
    with pytest.raises(ValueError, match="CASE form"):
        build_tag(spark, catalog, plan, "2000-01-01", "case")
    monkeypatch.setattr(tag_ops, "BROADCAST_RULE_BYTES", 10)
    assert not plan_tasks(_catalog(spark, [("1", "x" * 20)]), [1])[1].broadcast_rules


def test_task_sql_names_match_in_any_case(spark):
    out = tag_ops.run_task_sql(spark, "select 1 as UID, 2 as Query_Value", "2000-01-01")
    assert out.columns == ["uid", "query_value"] and tuple(out.first()) == (1, 2)
    with pytest.raises(ValueError):
        tag_ops.run_task_sql(spark, "select 1 as uid", "2000-01-01")


def test_json_keeps_null_columns(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows_as_json(df).first()["json"] == '{"a":1,"b":null}'
