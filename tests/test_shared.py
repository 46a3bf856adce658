"""Tags of one source are computed in one pass, with the rows that their own SQL gives."""

import re
from collections import Counter

import pytest

from tagweave.operators import shared
from tagweave.operators.tag import plan_active, run_task_sql
from tagweave.plans import jobs, registry
from tagweave.plans.profile import BUSINESS_DATE
from tagweave.sources.catalog import catalog_from_rows
from tagweave.sources.tables import TagStore

from conftest import SF_SMALL


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def _scans(df, table: str) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"Location: [^\n]*/{table}\.parquet", plan))


def test_wide_table_reads_each_source_once(spark):
    wide = registry.wide_pivot(spark, SF_SMALL)
    assert {t: _scans(wide, t) for t in ("orders", "customer", "events")} == {"orders": 1, "customer": 1, "events": 1}


def test_every_task_gets_its_own_rows(spark):
    catalog = registry._setup(spark, SF_SMALL)
    passes, single = shared.shared_passes(spark, plan_active(catalog), BUSINESS_DATE)
    assert sorted(len(p.members) for p in passes) == [2, 2, 4] and not single
    for p in passes:
        frame = p.frame(spark)
        for plan, _ in p.members:
            assert _rows(p.source(frame, plan)) == _rows(run_task_sql(spark, plan.task_sql, BUSINESS_DATE))


@pytest.fixture()
def visits(spark):
    rows = [(1, "a", 2), (1, "a", 3), (1, None, 4), (2, "b", None), (None, "c", 5), (None, None, 6), (3, None, None), (2, "b", 1)]
    spark.createDataFrame(rows, "user long, kind string, n int").createOrReplaceTempView("visits")


SAME = [
    "select user uid, count(distinct kind) query_value from visits group by user",
    "select user uid, sum(n) filter (where kind = 'a') query_value from visits group by user",
    "select max(kind) query_value, user UID from visits group by user",
    "select user uid, concat('u', user, ':', count(*)) query_value from visits group by user",
    "select distinct user uid, kind query_value from visits",
    "select distinct user uid, n % 2 query_value from visits",
    "select distinct user uid, kind query_value from visits",
]
ROWS = ["select user uid, kind query_value from visits where n > 1", "select user uid, n + 1 query_value from visits where n > 1"]
ALONE = [
    "select user uid, count(*) query_value from visits group by user having count(*) > 1",
    "select user uid, n query_value from visits order by n limit 3",
    "select user uid, count(*) query_value from (select * from visits where n > 0) group by user",
    "select a.user uid, b.n query_value from visits a join visits b on a.user = b.user",
    "select user uid, (select max(n) from visits) query_value from visits",
    "select user uid, rand() query_value from visits",
    "select user uid, count(*) query_value from visits where n in (select 1) group by user",
    "select user uid, kind query_value from visits tablesample (100 percent)",
    "select user uid, kind query_value, n extra from visits",
    "select kind uid, count(*) query_value from visits group by kind, user",
]


def test_shapes(spark, visits):
    assert all(shared.shape_of(spark, q) for q in SAME + ROWS)
    assert not any(shared.shape_of(spark, q) for q in ALONE)


def test_odd_tasks_in_one_pass_equal_their_own_sql(spark, visits):
    queries = SAME + ROWS + ALONE[:2]
    tasks = [dict(id=i, task_name="t", task_status="1", task_sql=q) for i, q in enumerate(queries)]
    tags = [dict(id=100 + i, tag_code=f"T{i}", tag_name="t", tag_level=1, tag_value_type="3", tag_task_id=i) for i in range(len(queries))]
    catalog = catalog_from_rows(spark, tasks, tags, [dict(id=1, tag_id=100, task_id=99, query_value="x", sub_tag_id=1)])
    plans = plan_active(catalog)
    passes, single = shared.shared_passes(spark, plans, BUSINESS_DATE)
    assert sorted(len(p.members) for p in passes) == [2, 7] and len(single) == 2
    for p in passes:
        frame = p.frame(spark)
        for plan, _ in p.members:
            assert _rows(p.source(frame, plan)) == _rows(run_task_sql(spark, plan.task_sql, BUSINESS_DATE)), plan.task_sql
    long = jobs.shared_long(spark, catalog, plans, BUSINESS_DATE)
    _, frames = jobs.active_tag_frames(spark, catalog, BUSINESS_DATE)
    want = Counter((r["uid"], r["tag_value"], code) for code, df in frames for r in df.collect())
    assert _rows(long.select("uid", "tag_value", "tag_name")) == want


def test_tags_job_writes_what_single_jobs_write(spark, tmp_root):
    catalog = registry._setup(spark, SF_SMALL)
    together, alone = TagStore(spark, f"{tmp_root}/a"), TagStore(spark, f"{tmp_root}/b")
    tags = jobs.tags_job(spark, catalog, BUSINESS_DATE, together)
    for tag in tags:
        jobs.tag_job(spark, catalog, tag.tag_task_id, BUSINESS_DATE, alone)
        one, other = (s.read_tag_day(tag.tag_code, tag.tag_value_type, BUSINESS_DATE) for s in (together, alone))
        assert _rows(one) == _rows(other) and one.count()
    import os
    assert not [f for f in os.listdir(f"{tmp_root}/a") if f.startswith("_pass")]
