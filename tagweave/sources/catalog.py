"""Tag catalog: task definitions, tag definitions and value-mapping rules.

The catalog is three small DataFrames (``task_info``, ``tag_info``,
``task_tag_rule``).  They can come from a JDBC database
(:func:`read_catalog_jdbc`), from any table, or from Python rows
(:func:`catalog_from_rows`).  Lookups that steer planning (which SQL to run,
which tags exist) are tiny driver-side reads of this catalog; the data itself
never passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.values import BITMAP_TABLE_PREFIX, BITMAP_TABLE_SUFFIX, TASK_ACTIVE, camel_name

TASK_INFO_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("task_name", T.StringType()),
    T.StructField("task_status", T.StringType()),
    T.StructField("task_comment", T.StringType()),
    T.StructField("task_time", T.StringType()),
    T.StructField("task_type", T.StringType()),
    T.StructField("exec_type", T.StringType()),
    T.StructField("main_class", T.StringType()),
    T.StructField("file_id", T.LongType()),
    T.StructField("task_args", T.StringType()),
    T.StructField("task_sql", T.StringType()),
    T.StructField("task_exec_level", T.LongType()),
    T.StructField("create_time", T.TimestampType()),
])

TAG_INFO_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("tag_code", T.StringType()),
    T.StructField("tag_name", T.StringType()),
    T.StructField("tag_level", T.LongType()),
    T.StructField("parent_tag_id", T.LongType()),
    T.StructField("tag_type", T.StringType()),
    T.StructField("tag_value_type", T.StringType()),
    T.StructField("tag_value_limit", T.LongType()),
    T.StructField("tag_value_step", T.LongType()),
    T.StructField("tag_task_id", T.LongType()),
    T.StructField("tag_comment", T.StringType()),
    T.StructField("create_time", T.TimestampType()),
    T.StructField("update_time", T.TimestampType()),
])

TASK_TAG_RULE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("tag_id", T.LongType()),
    T.StructField("task_id", T.LongType()),
    T.StructField("query_value", T.StringType()),
    T.StructField("sub_tag_id", T.LongType()),
])


@dataclass(frozen=True)
class TagDef:
    id: int
    tag_code: str
    tag_name: str
    tag_value_type: str
    tag_task_id: int | None

    @property
    def column(self) -> str:
        return self.tag_code.lower()


@dataclass(frozen=True)
class Catalog:
    task_info: DataFrame
    tag_info: DataFrame
    task_tag_rule: DataFrame


_ARROW_TYPES = {"bigint": pa.int64(), "string": pa.string(), "timestamp": pa.timestamp("us", tz="UTC")}


def _local_frame(spark: SparkSession, schema: T.StructType, rows: list[dict]) -> DataFrame:
    """Python rows -> DataFrame backed by a local relation (an Arrow table).

    A local relation is read on the driver without starting a job, which
    keeps catalog lookups cheap; ``createDataFrame(list)`` would build an
    RDD whose every read runs Python tasks.
    """
    arrow_schema = pa.schema([pa.field(f.name, _ARROW_TYPES[f.dataType.simpleString()]) for f in schema.fields])
    table = pa.Table.from_pylist([{f.name: r.get(f.name) for f in schema.fields} for r in rows],
                                 schema=arrow_schema)
    return spark.createDataFrame(table, schema=schema)


def catalog_from_rows(spark: SparkSession, tasks: list[dict], tags: list[dict],
                      rules: list[dict]) -> Catalog:
    return Catalog(
        _local_frame(spark, TASK_INFO_SCHEMA, tasks),
        _local_frame(spark, TAG_INFO_SCHEMA, tags),
        _local_frame(spark, TASK_TAG_RULE_SCHEMA, rules),
    )


def read_catalog_jdbc(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> Catalog:
    """Catalog tables read over JDBC (one small query each)."""
    from tagweave.sources.jdbc import read_jdbc
    return Catalog(*(read_jdbc(spark, url, table=name, properties=properties)
                     for name in ("task_info", "tag_info", "task_tag_rule")))


def lookup_one_df(df: DataFrame, key_col: str, key_value, order_col: str | None = None) -> DataFrame:
    """At most one row whose ``key_col`` equals ``key_value`` (lowest ``order_col`` first).

    The filter is pushed to the scan; the one-row limit is the operator itself.
    """
    hit = df.filter(F.col(key_col) == F.lit(key_value))
    if order_col:
        hit = hit.orderBy(F.col(order_col).asc_nulls_last())
    return hit.limit(1)


def lookup_one(df: DataFrame, key_col: str, key_value, order_col: str | None = None,
               what: str = "row") -> Row:
    """First matching row or ``LookupError`` (task and tag lookups)."""
    rows = lookup_one_df(df, key_col, key_value, order_col).collect()
    if not rows:
        raise LookupError(f"no {what} for {key_col} = {key_value}")
    return rows[0]


def active_tags(catalog: Catalog) -> DataFrame:
    """Tags whose task is active: ``tag_info JOIN task_info ON tag_task_id = id``."""
    return active_tags_with_sql(catalog).drop("task_sql")


def active_tags_with_sql(catalog: Catalog) -> DataFrame:
    """:func:`active_tags` with the ``task_sql`` of each tag's task."""
    tasks = catalog.task_info.filter(F.col("task_status") == TASK_ACTIVE).select(
        F.col("id").alias("_task_id"), "task_sql")
    return (catalog.tag_info.join(tasks, F.col("tag_task_id") == F.col("_task_id"), "inner")
            .drop("_task_id"))


def active_tag_list(catalog: Catalog) -> list[TagDef]:
    """Active tags as plan inputs, in tag-id order; an empty list raises.

    One row per active tag comes to the driver: each is a column of the plan.
    """
    rows = active_tags(catalog).select("id", "tag_code", "tag_name", "tag_value_type", "tag_task_id").collect()
    return check_active([TagDef(r.id, r.tag_code, r.tag_name, str(r.tag_value_type), r.tag_task_id)
                         for r in sorted(rows, key=lambda r: r.id)])


def check_active(tags: list[TagDef]) -> list[TagDef]:
    """An empty or column-colliding active tag list raises."""
    if not tags:
        raise ValueError("no active tags")
    columns = [t.column for t in tags]
    if len(set(columns)) != len(columns):
        raise ValueError("two active tags share a lower-cased tag_code")
    if "uid" in columns:
        raise ValueError("tag_code 'uid' is reserved for the user column")
    return tags


def task_rules(catalog: Catalog, task_id: int) -> DataFrame:
    """Rules of one task with the mapped value (sub-tag name).

    Inner join on ``sub_tag_id = tag_info.id``: a rule whose sub-tag is
    missing does not map anything.
    """
    return task_rules_for(catalog, [task_id])


def task_rules_for(catalog: Catalog, task_ids: list[int]) -> DataFrame:
    """:func:`task_rules` for several tasks at once."""
    sub = catalog.tag_info.select(F.col("id").alias("_sub_id"), F.col("tag_name").alias("sub_tag_value"))
    return (catalog.task_tag_rule.filter(F.col("task_id").isin([int(t) for t in task_ids]))
            .join(sub, F.col("sub_tag_id") == F.col("_sub_id"), "inner")
            .select("id", "tag_id", "task_id", "query_value", "sub_tag_id", "sub_tag_value"))


def bitmap_table_col(value_type_col: Column) -> Column:
    """Value-type code -> bitmap table name; unknown codes fail the job."""
    expr = None
    for code, suffix in BITMAP_TABLE_SUFFIX.items():
        name = F.lit(BITMAP_TABLE_PREFIX + suffix)
        expr = F.when(value_type_col == code, name) if expr is None else expr.when(value_type_col == code, name)
    return expr.otherwise(F.raise_error(F.concat(F.lit("unknown tag value type "),
                                                 F.coalesce(value_type_col, F.lit("NULL")))))


def tags_by_type(tags: DataFrame) -> DataFrame:
    """(value type, bitmap table, sorted tag codes) per value type."""
    return (tags.groupBy("tag_value_type")
            .agg(F.array_sort(F.collect_list(F.lower("tag_code"))).alias("tag_codes"))
            .withColumn("table_name", bitmap_table_col(F.col("tag_value_type"))))


def camel_columns(df: DataFrame) -> DataFrame:
    """Rename ``snake_case`` columns to ``camelCase``."""
    return df.toDF(*[camel_name(c) for c in df.columns])


def rows_as_json(df: DataFrame, column: str = "json") -> DataFrame:
    """Each row as one JSON object keyed by column name; a NULL column is ``null``."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias(column))
