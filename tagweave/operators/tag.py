"""One tag for one day: user SQL -> rule mapping -> typed ``(uid, tag_value)``.

The task's SELECT must produce ``uid`` and ``query_value``.  With no rules the
value passes through (cast to the tag type); with rules, each raw value maps
to its rule's sub-tag name, the first rule (lowest rule id) wins, and an
unmatched value gives a NULL row that is kept.

Two physical forms of the mapping give the same result:

* ``case`` -- a ``CASE WHEN`` chain; stays in the scan's codegen stage, no
  join at all.  Used for up to ``CASE_RULE_LIMIT`` rules.
* ``join`` -- a left join against the de-duplicated rules; broadcast when the
  rules' number and text size are within ``BROADCAST_RULE_LIMIT`` and
  ``BROADCAST_RULE_BYTES`` (counted in Spark), else a shuffle join that AQE
  may split for skewed values.

Both compare in :func:`match_type` and convert the winning rule's text with
:func:`rule_value` on the rows that take it, so they agree on values and on
errors.  Only the texts of ``case`` tasks are read on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.values import check_date, rule_key, rule_value, spark_type, to_tag_type, value_key
from tagweave.sources.catalog import Catalog, TagDef, active_tags_with_sql, check_active, task_rules, task_rules_for

CASE_RULE_LIMIT = 100
BROADCAST_RULE_LIMIT = 100_000
BROADCAST_RULE_BYTES = 16 << 20


def bind_date(sql: str, dt: str) -> str:
    """Replace ``$dt`` and ``${dt}`` with the business date.

    The date is checked to be ``yyyy-MM-dd`` first, so the substitution can
    never inject SQL.  Like the original, any text starting with ``$dt`` is
    rewritten (``$dt_end`` becomes ``<date>_end``).
    """
    check_date(dt)
    return sql.replace("$dt", dt).replace("${dt}", dt)


def run_task_sql(spark: SparkSession, sql: str, dt: str) -> DataFrame:
    """The task's SELECT as a DataFrame ``(uid, query_value)``."""
    df = spark.sql(bind_date(sql, dt))
    picked = []
    for name in ("uid", "query_value"):  # names match in any letter case, as SQL names do
        found = [c for c in df.columns if c.lower() == name]
        if len(found) != 1:
            raise ValueError(f"task SQL must return one uid and one query_value; it returns {df.columns}")
        picked.append(F.col(f"`{found[0]}`").alias(name))
    return df.select(*picked)


def passthrough(source: DataFrame, value_type) -> DataFrame:
    qtype = source.schema["query_value"].dataType
    return source.select(F.col("uid").cast("string").alias("uid"),
                         to_tag_type(F.col("query_value"), qtype, value_type).alias("tag_value"))


def case_value(value: Column, qtype: T.DataType, rules: list[tuple[str, str]], value_type) -> Column:
    """``CASE value WHEN q THEN v ... END`` in the tag's type; ``rules`` in priority order."""
    key = value_key(value, qtype)
    expr = None
    for query_value, sub_value in rules:
        cond = key == rule_key(query_value, qtype)
        out = rule_value(F.lit(sub_value).cast("string"), value_type)
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr.cast(spark_type(value_type))


def map_values_case(source: DataFrame, rules: list[tuple[str, str]], value_type) -> DataFrame:
    """``CASE query_value WHEN q THEN v ... END``; ``rules`` in priority order."""
    if not rules:
        return passthrough(source, value_type)
    qtype = source.schema["query_value"].dataType
    return source.select(F.col("uid").cast("string").alias("uid"),
                         case_value(F.col("query_value"), qtype, rules, value_type).alias("tag_value"))


def first_rule_per_value(rules: DataFrame, key=None) -> DataFrame:
    """One rule per match key (default: the raw text): the lowest rule id wins."""
    key = F.col("query_value") if key is None else key
    return (rules.select(key.alias("_rule_key"), "id", "sub_tag_value")
            .filter(F.col("_rule_key").isNotNull())
            .groupBy("_rule_key")
            .agg(F.min_by("sub_tag_value", "id").alias("sub_tag_value")))


def map_values_join(source: DataFrame, rules: DataFrame, value_type, broadcast: bool = False) -> DataFrame:
    """Rule mapping as a left join; same result as :func:`map_values_case`.

    Rules are de-duplicated on the key *after* converting it to the
    comparison type, so texts like ``'1'`` and ``'01'`` that match the same
    number behave as in the CASE chain: the lower rule id wins.
    ``broadcast`` says that the caller has checked the rules' size.
    """
    qtype = source.schema["query_value"].dataType
    target = spark_type(value_type)
    mapped = first_rule_per_value(rules, rule_key(F.col("query_value"), qtype))
    if broadcast:
        mapped = F.broadcast(mapped)
    joined = source.join(mapped, value_key(source["query_value"], qtype) == mapped["_rule_key"], "left")
    return joined.select(F.col("uid").cast("string").alias("uid"),
                         rule_value(F.col("sub_tag_value"), value_type).cast(target).alias("tag_value"))


@dataclass(frozen=True)
class TaskPlan:
    """What the driver needs to build one tag's plan (read from the catalog)."""
    task_id: int
    task_sql: str
    tag: TagDef
    rule_count: int
    rules: list[tuple[str, str]] | None  # priority order; None when too many for a CASE
    rule_bytes: int = 0

    @property
    def broadcast_rules(self) -> bool:
        return self.rule_count <= BROADCAST_RULE_LIMIT and self.rule_bytes <= BROADCAST_RULE_BYTES


def value_column(plan: TaskPlan, value: Column, qtype: T.DataType) -> Column:
    """The tag's value of a raw one, for tasks whose rules are none or fit a CASE."""
    if plan.rule_count == 0:
        return to_tag_type(value, qtype, plan.tag.tag_value_type)
    if plan.rules is None:
        raise ValueError(f"the rules of task {plan.task_id} need a join")
    return case_value(value, qtype, plan.rules, plan.tag.tag_value_type)


@dataclass
class TagResult:
    tag: TagDef
    task_id: int
    values: DataFrame  # (uid string, tag_value <tag type>)


def _rule_sizes(catalog: Catalog, task_ids: list[int]) -> dict[int, tuple[int, int]]:
    """Number and text bytes of the rules of each task, counted in Spark: one row a task comes back.

    A rule whose sub-tag is missing maps nothing and does not count.
    """
    rules = task_rules_for(catalog, task_ids)
    size = F.coalesce(F.octet_length("query_value"), F.lit(0)) + F.coalesce(F.octet_length("sub_tag_value"), F.lit(0))
    return {r["task_id"]: (r["n"], r["b"]) for r in
            rules.groupBy("task_id").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).collect()}


def _few_rules(catalog: Catalog, task_ids: list[int]) -> list | None:
    """All rules of the tasks, if there are at most ``CASE_RULE_LIMIT`` a task on average; else None.

    Two filtered reads of at most that many rows, no join: the usual small
    catalog is planned without a Spark job.
    """
    most = CASE_RULE_LIMIT * len(task_ids)
    rules = (catalog.task_tag_rule.filter(F.col("task_id").isin(task_ids))
             .select("id", "task_id", "query_value", "sub_tag_id").limit(most + 1).collect())
    if len(rules) > most:
        return None
    wanted = sorted({r.sub_tag_id for r in rules if r.sub_tag_id is not None})
    names = {r.id: r.tag_name for r in catalog.tag_info.filter(F.col("id").isin(wanted)).select("id", "tag_name").collect()}
    return [(r.task_id, r.id, r.query_value, names[r.sub_tag_id]) for r in rules if r.sub_tag_id in names]


def _rules_of(catalog: Catalog, task_ids: list[int]) -> tuple[dict[int, tuple[int, int]], dict[int, list]]:
    """Sizes of the tasks' rules, and the (query value, mapped text) pairs of tasks short enough for a CASE."""
    if not task_ids:
        return {}, {}
    rows = _few_rules(catalog, task_ids)
    if rows is None:
        sizes = _rule_sizes(catalog, task_ids)
        short = [t for t, (n, _) in sizes.items() if n <= CASE_RULE_LIMIT]
        rows = [(r.task_id, r.id, r.query_value, r.sub_tag_value)
                for r in task_rules_for(catalog, short).collect()] if short else []
    else:
        sizes = {}
        for task_id, _, query_value, mapped in rows:
            n, size = sizes.get(task_id, (0, 0))
            sizes[task_id] = n + 1, size + len((query_value or "").encode()) + len((mapped or "").encode())
    lists: dict[int, list] = {}
    for task_id, _, query_value, mapped in sorted(rows, key=lambda r: r[:2]):
        if sizes[task_id][0] <= CASE_RULE_LIMIT:
            lists.setdefault(task_id, []).append((query_value, mapped))
    return sizes, lists


def _task_plans(catalog: Catalog, tasks: list[tuple[int, str, TagDef]]) -> list[TaskPlan]:
    for _, _, tag in tasks:
        spark_type(tag.tag_value_type)  # unknown types fail before any work
    sizes, lists = _rules_of(catalog, sorted({t for t, _, _ in tasks}))
    plans = []
    for task_id, sql, tag in tasks:
        n, size = sizes.get(task_id, (0, 0))
        plans.append(TaskPlan(task_id, sql, tag, n, lists.get(task_id, [] if n == 0 else None), size))
    return plans


def _tag_def(r) -> TagDef:
    return TagDef(r.id, r.tag_code, r.tag_name, str(r.tag_value_type), r.tag_task_id)


def plan_tasks(catalog: Catalog, task_ids: list[int]) -> dict[int, TaskPlan]:
    """Catalog reads for the given tasks: the task, its first tag (lowest
    id), its rules.  Missing tasks or tags raise ``LookupError``."""
    ids = sorted(set(int(t) for t in task_ids))
    tasks = {r.id: r.task_sql for r in catalog.task_info.filter(F.col("id").isin(ids)).select("id", "task_sql").collect()}
    tags: dict[int, TagDef] = {}
    for r in sorted(catalog.tag_info.filter(F.col("tag_task_id").isin(ids))
                    .select("id", "tag_code", "tag_name", "tag_value_type", "tag_task_id").collect(), key=lambda r: r.id):
        tags.setdefault(r.tag_task_id, _tag_def(r))
    for task_id in ids:
        if task_id not in tasks:
            raise LookupError(f"no task for id = {task_id}")
        if task_id not in tags:
            raise LookupError(f"no tag for tag_task_id = {task_id}")
    return {p.task_id: p for p in _task_plans(catalog, [(t, tasks[t], tags[t]) for t in ids])}


def plan_active(catalog: Catalog) -> list[TaskPlan]:
    """Plans of all active tags, in tag-id order (the tags of :func:`active_tag_list`)."""
    rows = (active_tags_with_sql(catalog)
            .select("id", "tag_code", "tag_name", "tag_value_type", "tag_task_id", "task_sql").collect())
    rows = sorted(rows, key=lambda r: r.id)
    check_active([_tag_def(r) for r in rows])
    return _task_plans(catalog, [(r.tag_task_id, r.task_sql, _tag_def(r)) for r in rows])


def build_tag(spark: SparkSession, catalog: Catalog, plan: TaskPlan, dt: str,
              rules_method: str = "auto", source: DataFrame | None = None) -> TagResult:
    """The tag's value plan from an already-read :class:`TaskPlan`, over the rows of its SQL (``source`` if given)."""
    source = run_task_sql(spark, plan.task_sql, dt) if source is None else source
    value_type = plan.tag.tag_value_type
    if rules_method not in ("auto", "case", "join"):
        raise ValueError(f"unknown rules_method {rules_method!r}")
    if plan.rule_count == 0:
        values = passthrough(source, value_type)
    elif rules_method != "join" and plan.rules is not None:
        values = map_values_case(source, plan.rules, value_type)
    elif rules_method == "case":
        raise ValueError(f"the CASE form takes at most {CASE_RULE_LIMIT} rules, task {plan.task_id} has {plan.rule_count}")
    else:
        values = map_values_join(source, task_rules(catalog, plan.task_id), value_type, plan.broadcast_rules)
    return TagResult(plan.tag, plan.task_id, values)


def compute_tag(spark: SparkSession, catalog: Catalog, task_id: int, dt: str,
                rules_method: str = "auto") -> TagResult:
    """Full tag computation for one task and day (not yet written)."""
    plan = plan_tasks(catalog, [task_id])[task_id]
    return build_tag(spark, catalog, plan, dt, rules_method)
