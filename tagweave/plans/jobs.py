"""The daily batch jobs: tag -> merge -> bitmap.

Each job is one Spark plan per output table; the catalog is read once on the
driver to decide *which* plan to build, never to move data.  The serving
export and tag prediction are in :mod:`tagweave.operators.export` and
:mod:`tagweave.operators.ml`; :mod:`tagweave.plans.cli` runs all of them
from ``spark-submit``.
"""

from __future__ import annotations

import uuid
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.values import check_date
from tagweave.operators import bitmap as bitmap_ops
from tagweave.operators.merge import HEAVY_SAMPLE, HEAVY_SHARE, heavy_users, merge_long, merge_tags, split_wide, union_long
from tagweave.operators.shared import shared_passes
from tagweave.operators.tag import TagResult, TaskPlan, build_tag, compute_tag, plan_active, plan_tasks
from tagweave.sources.catalog import Catalog, TagDef, active_tag_list
from tagweave.sources.tables import TagStore, delete_folder


def tag_job(spark: SparkSession, catalog: Catalog, task_id: int, dt: str, store: TagStore,
            rules_method: str = "auto") -> TagResult:
    """Compute one tag and replace its day in the tag table."""
    check_date(dt)
    result = compute_tag(spark, catalog, task_id, dt, rules_method)
    store.write_tag_day(result.tag.tag_code, result.tag.tag_value_type, result.values, dt, result.tag.tag_name)
    return result


def tags_job(spark: SparkSession, catalog: Catalog, dt: str, store: TagStore) -> list[TagDef]:
    """Compute all active tags of the day and replace their days; tags of the same source rows share one pass.

    The result of a pass is written to a hidden folder of the store (it cuts the
    lineage: a source is read once, whatever becomes of executors) and dropped
    after its tags are written.
    """
    check_date(dt)
    plans = plan_active(catalog)
    passes, single = shared_passes(spark, plans, dt)
    for shared in passes:
        folder = f"{store.root}/_pass-{uuid.uuid4().hex[:12]}"
        try:
            shared.frame(spark).write.parquet(folder)
            frame = spark.read.parquet(folder)
            for plan, _ in shared.members:
                tag, values = plan.tag, build_tag(spark, catalog, plan, dt, source=shared.source(frame, plan)).values
                store.write_tag_day(tag.tag_code, tag.tag_value_type, values, dt, tag.tag_name)
        finally:
            delete_folder(spark, folder)
    for plan in single:
        tag = plan.tag
        store.write_tag_day(tag.tag_code, tag.tag_value_type, build_tag(spark, catalog, plan, dt).values, dt, tag.tag_name)
    return [p.tag for p in plans]


def days_between(first: str, last: str) -> list[str]:
    """The days from ``first`` to ``last``, both included."""
    a, b = (date.fromisoformat(check_date(d)) for d in (first, last))
    if a > b:
        raise ValueError(f"{first} is after {last}")
    return [(a + timedelta(days=i)).isoformat() for i in range((b - a).days + 1)]


def backfill_job(spark: SparkSession, catalog: Catalog, task_id: int, days: list[str], store: TagStore) -> TagDef:
    """Compute one tag for many days in one job and replace exactly those days; days without rows are cleared.

    The catalog is read and the tag planned once; the days' queries are the
    branches of one plan, so their scans and shuffles run side by side.
    """
    days = [check_date(d) for d in dict.fromkeys(days)]
    if not days:
        raise ValueError("no days to fill")
    plan = plan_tasks(catalog, [task_id])[task_id]
    parts = [build_tag(spark, catalog, plan, d).values.withColumn("dt", F.lit(d)) for d in days]
    tag = plan.tag
    store.write_tag_days(tag.tag_code, tag.tag_value_type, reduce(DataFrame.unionByName, parts), days, tag.tag_name)
    return tag


def shared_long(spark: SparkSession, catalog: Catalog, plans: list[TaskPlan], dt: str) -> DataFrame:
    """``(uid, tag_value, tag_name)`` of all tags, each source read once; large rule sets are joined one by one."""
    joined = [p for p in plans if p.rule_count and p.rules is None]
    passes, single = shared_passes(spark, [p for p in plans if p not in joined], dt)
    parts = [p.long(p.frame(spark)) for p in passes]
    alone = [p for p in plans if p in single or p in joined]
    if alone:
        parts.append(union_long([(p.tag.tag_code, build_tag(spark, catalog, p, dt).values) for p in alone],
                                {p.tag.tag_code: p.tag.tag_value_type for p in alone}))
    return reduce(DataFrame.unionByName, parts)


def active_tag_frames(spark: SparkSession, catalog: Catalog, dt: str, store: TagStore | None = None,
                      plans: list[TaskPlan] | None = None
                      ) -> tuple[list[TagDef], list[tuple[str, DataFrame]]]:
    """Active tags and their day's values: from the tag tables when a store
    is given, otherwise computed in the same plan from the source tables."""
    if store is not None:
        tags = [p.tag for p in plans] if plans is not None else active_tag_list(catalog)
        return tags, [(t.tag_code, store.read_tag_day(t.tag_code, t.tag_value_type, dt)) for t in tags]
    plans = plans if plans is not None else plan_active(catalog)
    return [p.tag for p in plans], [(p.tag.tag_code, build_tag(spark, catalog, p, dt).values) for p in plans]


def wide_frame(spark: SparkSession, catalog: Catalog, dt: str, store: TagStore | None = None,
               preaggregate: bool = False, plans: list[TaskPlan] | None = None,
               method: str = "auto") -> tuple[list[TagDef], DataFrame]:
    """The day's wide table as a plan (not written): active tags, their values, merged."""
    if store is None:
        plans = plans if plans is not None else plan_active(catalog)
        if not plans:
            raise ValueError("no tags to merge")
        codes = [p.tag.tag_code for p in plans]
        return [p.tag for p in plans], merge_long(shared_long(spark, catalog, plans, dt), codes, preaggregate, method)
    tags, frames = active_tag_frames(spark, catalog, dt, store, plans)
    types = {t.tag_code: t.tag_value_type for t in tags}
    return tags, merge_tags(frames, types, preaggregate, method)


def merge_job(spark: SparkSession, catalog: Catalog, dt: str, store: TagStore, heavy_share: float = HEAVY_SHARE,
              heavy_sample: float = HEAVY_SAMPLE) -> DataFrame:
    """Wide table of the day from the tag tables; the day's table is replaced.

    Users with at least ``heavy_share`` of the day's rows, measured on a sample
    of the stored uids, are merged in pieces.
    """
    check_date(dt)
    tags, frames = active_tag_frames(spark, catalog, dt, store)
    long, codes = union_long(frames, {t.tag_code: t.tag_value_type for t in tags}), [t.tag_code for t in tags]
    wide = split_wide(long, codes, heavy_users(long, heavy_share, heavy_sample))
    store.write_wide(wide, dt, {t.column: t.tag_name for t in tags})
    return store.read_wide(dt)


def bitmap_job(spark: SparkSession, catalog: Catalog, dt: str, store: TagStore,
               wide: DataFrame | None = None, tags: list[TagDef] | None = None) -> dict[str, DataFrame]:
    """Bitmaps of the day's wide table, one table per value type.

    Each type reads only its own tag columns of the stored wide table
    (column pruning), so the four writes together scan the table once.
    Every type's day is rewritten (an empty one when no active tag has that
    type), so a rerun after a catalog change leaves no stale bitmaps.
    """
    check_date(dt)
    tags = tags if tags is not None else active_tag_list(catalog)
    if wide is None:
        wide = store.read_wide(dt)
    for code, frame in bitmap_ops.bitmaps_by_type(wide, tags, dt).items():
        if frame is None:
            frame = spark.createDataFrame([], "tag_code string, tag_value string, bucket bigint, us binary, "
                                             "users bigint")
        store.write_bitmap_day(code, frame, dt)
    return {code: store.read_bitmap_day(code, dt) for code in bitmap_ops.BITMAP_TABLE_SUFFIX}


def all_bitmaps(tables: dict[str, DataFrame]) -> DataFrame:
    """The per-type bitmap tables as one frame with a ``value_type`` column."""
    parts = [df.withColumn("value_type", F.lit(code)) for code, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
