"""Tags of one source in one pass: tasks that read the same rows are computed by one query.

A profile has many tags over few tables.  Tasks of one of these shapes

    SELECT <user> uid, <aggregate> query_value FROM <table> [WHERE <rows>] GROUP BY <user>
    SELECT DISTINCT <user> uid, <value> query_value FROM <table> [WHERE <rows>]
    SELECT <user> uid, <value> query_value FROM <table> [WHERE <rows>]

are grouped by table, row condition and user expression.  A group of plain
selects becomes one projection.  Aggregates and DISTINCTs become one aggregation
with grouping sets: ``(user)`` for all aggregates, ``(user, value)`` for each
DISTINCT, so no user's values are ever collected into a state.  The union of the
columns is scanned once, and one exchange serves the whole group.

The parts of a task come from Spark's own analysis of its SQL.  A task is only
shared if the query put together from its parts has the same semantics as its own
(``DataFrame.sameSemantics``); every other task runs by itself, as before.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.operators.merge import value_as_text
from tagweave.operators.tag import TaskPlan, bind_date, value_column

ROWS, GROUPS, DISTINCT = "rows", "groups", "distinct"


@dataclass(frozen=True)
class Shape:
    kind: str
    source: str
    condition: str | None
    uid: str
    value: str

    @property
    def _from(self) -> str:
        return f"FROM {self.source}" + (f" WHERE {self.condition}" if self.condition else "")

    def sql(self, names: list[str]) -> str:
        head = "SELECT DISTINCT" if self.kind == DISTINCT else "SELECT"
        tail = f" GROUP BY {self.uid}" if self.kind == GROUPS else ""
        texts = {"uid": self.uid, "query_value": self.value}
        return f"{head} {', '.join(f'{texts[n]} AS {n}' for n in names)} {self._from}{tail}"

    @property
    def pass_key(self) -> tuple:
        """Tasks with equal keys can be computed in one pass."""
        return self.kind == ROWS, self.source, self.condition, self.uid


def _name(node) -> str:
    return node.getClass().getSimpleName()


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _child(node):
    return node.children().apply(0)


def _body(plan) -> tuple[str, object] | None:
    """The kind of a plan and its node with the two output columns."""
    if _name(plan) == "Distinct" and _name(_child(plan)) == "Project":
        return DISTINCT, _child(plan)
    return {"Project": (ROWS, plan), "Aggregate": (GROUPS, plan)}.get(_name(plan))


def shape_of(spark: SparkSession, sql: str) -> Shape | None:
    """The shape of a task's SQL, or None if it has another."""
    if not hasattr(spark, "_jsparkSession"):  # a remote session shows no plans
        return None
    own = spark.sql(sql)
    parsed = _body(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql))
    analysed = _body(own._jdf.queryExecution().analyzed())
    if parsed is None or analysed is None or parsed[0] != analysed[0]:
        return None
    below, rows, condition = _child(parsed[1]), _child(analysed[1]), None
    if _name(below) == "Filter":
        if _name(rows) != "Filter":
            return None
        below, condition = _child(below), rows.condition().sql()
    if _name(below) != "UnresolvedRelation" or not below.options().isEmpty():
        return None
    kind, node = analysed
    columns = _items(node.aggregateExpressions() if kind == GROUPS else node.projectList())
    texts = {c.name().lower(): (c.child() if _name(c) == "Alias" else c).sql() for c in columns}
    if len(columns) != 2 or set(texts) != {"uid", "query_value"} or not own._jdf.queryExecution().analyzed().deterministic():
        return None
    if kind == GROUPS and [g.sql() for g in _items(node.groupingExpressions())] != [texts["uid"]]:
        return None
    if texts["uid"] == texts["query_value"]:
        return None
    shape = Shape(kind, below.tableName(), condition, texts["uid"], texts["query_value"])
    try:
        again = spark.sql(shape.sql([c.lower() for c in own.columns]))
    except PySparkException:  # a part that cannot be written as SQL by itself (a subquery)
        return None
    return shape if again.sameSemantics(own) else None


@dataclass
class SharedPass:
    """Tasks computed by one query; ``sql`` gives (uid, one column a task or DISTINCT value, grouping marks)."""

    members: list[tuple[TaskPlan, Shape]]
    columns: dict[int, str] = field(default_factory=dict)   # task id -> column
    distinct: list[str] = field(default_factory=list)       # DISTINCT values, in the order of d0, d1 ...

    def __post_init__(self):
        for plan, shape in self.members:
            if shape.kind == DISTINCT:
                if shape.value not in self.distinct:
                    self.distinct.append(shape.value)
                self.columns[plan.task_id] = f"d{self.distinct.index(shape.value)}"
            else:
                self.columns[plan.task_id] = f"v{plan.task_id}"

    @property
    def sql(self) -> str:
        first = self.members[0][1]
        values = [f"{s.value} AS {self.columns[p.task_id]}" for p, s in self.members if s.kind != DISTINCT]
        if first.kind == ROWS:
            return f"SELECT {', '.join([f'{first.uid} AS uid', *values])} {first._from}"
        keys = [f"{d} AS d{i}, grouping({d}) AS g{i}" for i, d in enumerate(self.distinct)]
        sets = ([f"({first.uid})"] if values else []) + [f"({first.uid}, {d})" for d in self.distinct]
        by = f"GROUPING SETS ({', '.join(sets)})" if self.distinct else first.uid
        return f"SELECT {', '.join([f'{first.uid} AS uid', *values, *keys])} {first._from} GROUP BY {by}"

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.sql(self.sql)

    def _mine(self, column: str) -> Column:
        """The rows of the pass that belong to a column's tasks."""
        if column.startswith("d"):
            return F.col("g" + column[1:]) == 0
        mine = F.lit(True)
        for i in range(len(self.distinct)):
            mine &= F.col(f"g{i}") == 1
        return mine

    def source(self, frame: DataFrame, plan: TaskPlan) -> DataFrame:
        """``(uid, query_value)`` of one task, as its own SQL gives it."""
        column = self.columns[plan.task_id]
        return frame.filter(self._mine(column)).select("uid", F.col(column).alias("query_value"))

    def long(self, frame: DataFrame) -> DataFrame:
        """``(uid, tag_value, tag_name)`` of all tasks, the values as text: each row of the pass gives its tags' cells."""
        by_column: dict[bool | str, list[Column]] = {}
        for plan, _ in self.members:
            column = self.columns[plan.task_id]
            value = value_column(plan, F.col(column), frame.schema[column].dataType)
            cell = F.struct(value_as_text(value, plan.tag.tag_value_type).alias("tag_value"),
                            F.lit(plan.tag.tag_code).alias("tag_name"))
            by_column.setdefault(column if column.startswith("d") else "v", []).append(cell)
        cells = None
        for column, structs in by_column.items():
            mine, listed = self._mine(column), F.array(*structs)
            cells = F.when(mine, listed) if cells is None else cells.when(mine, listed)
        return frame.select(F.col("uid").cast("string").alias("uid"), F.explode(cells).alias("c")).select("uid", "c.tag_value", "c.tag_name")


def shared_passes(spark: SparkSession, plans: list[TaskPlan], dt: str) -> tuple[list[SharedPass], list[TaskPlan]]:
    """Passes over tasks of the same rows, two or more each, and the tasks that run by themselves."""
    groups: dict[tuple, list[tuple[TaskPlan, Shape]]] = {}
    for plan in plans:
        shape = shape_of(spark, bind_date(plan.task_sql, dt))
        groups.setdefault(shape.pass_key if shape else (plan.task_id,), []).append((plan, shape))
    passes = [SharedPass(members) for members in groups.values() if len(members) > 1]
    return passes, [members[0][0] for members in groups.values() if len(members) == 1]
