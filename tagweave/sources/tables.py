"""Warehouse tables: input scans and the partitioned tables this package writes.

Tables are Parquet folders under one root (see :mod:`tagweave.session`).

* tag tables ``<root>/<tag_code>/dt=<yyyy-MM-dd>/`` -- ``(uid, tag_value)``
* wide tables ``<root>/up_tag_merge_<yyyyMMdd>/`` -- one table per day
* bitmap tables ``<root>/user_tag_value_<type>/dt=<yyyyMMdd>/``

A day is replaced in two steps: the result is written to a new hidden folder
beside the table's days, and only when that job has succeeded does it become the
day.  In a plain store it takes the place of the ``dt=`` folder (two renames in
the file system); in a store with catalog tables the day's partition is pointed at
it, one metastore step, so a reader sees the old day or the new one and never
none.  A failed rerun leaves the old day as it was; other days are never touched
and an empty result still clears the day it targets.  Reads of one day list that
day's folder only and pass the schema, so ``dt`` stays a string.

Several days are replaced by one job (:meth:`TagStore.write_tag_days`), with
dynamic partition overwrite in a plain store.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.bitmap import users_in
from tagweave.functions.values import bitmap_table_name, check_date, date_token, spark_type, wide_table_name

INPUT_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                "events", "documents", "embeddings", "pages", "benchmark", "labels",
                "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=INPUT_TABLES) -> list[str]:
    """Temp views so user-written tag SQL can name the input tables (only
    file metadata is read here).  Tables missing from ``sf_dir`` are skipped;
    a tag SQL naming one fails when it is planned."""
    done = []
    for name in names:
        try:
            read_table(spark, sf_dir, name).createOrReplaceTempView(name)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            continue
        done.append(name)
    return done


def tag_table_schema(value_type) -> T.StructType:
    return T.StructType([
        T.StructField("uid", T.StringType()),
        T.StructField("tag_value", spark_type(value_type)),
        T.StructField("dt", T.StringType()),
    ])


BITMAP_SCHEMA = T.StructType([
    T.StructField("tag_code", T.StringType()),
    T.StructField("tag_value", T.StringType()),
    T.StructField("bucket", T.LongType()),
    T.StructField("us", T.BinaryType()),
    T.StructField("users", T.LongType()),
    T.StructField("dt", T.StringType()),
])


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package wrote, if it is there."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    to_path(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(to_path(path), True)


def replace_folder(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write ``df`` as Parquet and put it in the place of folder ``path`` once it is complete."""
    spark = df.sparkSession
    parent, _, name = path.rpartition("/")
    token = uuid.uuid4().hex[:12]
    # Names with a leading underscore are invisible to table reads.
    staged, old = f"{parent}/_new-{name}-{token}", f"{parent}/_old-{name}-{token}"
    writer = df.write
    if compression:
        writer = writer.option("compression", compression)
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        writer.parquet(staged)
    except Exception:
        fs.delete(to_path(staged), True)
        raise
    had_old = fs.exists(to_path(path))
    if had_old and not fs.rename(to_path(path), to_path(old)):
        raise OSError(f"could not move the old {path}")
    if not fs.rename(to_path(staged), to_path(path)):
        if had_old:
            fs.rename(to_path(old), to_path(path))
        raise OSError(f"could not publish {path}")
    if had_old:
        fs.delete(to_path(old), True)


def _read_partitioned(spark: SparkSession, table_path: str, schema: T.StructType, day: str | None = None) -> DataFrame:
    """All days of a table, or one, whose folder alone is listed; a missing day or table is empty."""
    path = table_path if day is None else f"{table_path}/dt={day}"
    try:
        return spark.read.schema(schema).option("basePath", table_path).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], schema)


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name or ""):
        raise ValueError(f"not a plain identifier: {name!r}")
    return f"`{name}`"


def _literal(text: str) -> str:
    """Body of a single-quoted SQL string literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


class TagStore:
    """Folder-per-table store for tag, wide and bitmap tables.

    With ``catalog_tables=True`` every tag table is also a table of the
    session catalog (``CREATE TABLE IF NOT EXISTS ... USING parquet
    PARTITIONED BY (dt) LOCATION ...``, in ``database`` if given), so SQL can
    read it by name and a metastore-backed cluster keeps it across sessions.
    Its days then are partitions with folders of their own; a day that is
    replaced gets a new folder, and the old one is removed after the swap.
    """

    def __init__(self, spark: SparkSession, root: str, catalog_tables: bool = False,
                 database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog_tables = catalog_tables
        self.database = database

    # tag tables -----------------------------------------------------------
    def tag_path(self, tag_code: str) -> str:
        return f"{self.root}/{tag_code.lower()}"

    def write_tag_day(self, tag_code: str, value_type, values: DataFrame, dt: str, comment: str | None = None) -> None:
        """Replace one day of a tag table with ``values(uid, tag_value)``; ``comment`` is the tag's name."""
        target, dt = spark_type(value_type), check_date(dt)
        out = values.select(F.col("uid").cast("string").alias("uid"),
                            F.col("tag_value").cast(target).alias("tag_value"))
        if self.catalog_tables:
            self._publish_day(self.create_tag_table(tag_code, value_type, comment), out, self.tag_path(tag_code), dt)
        else:
            replace_folder(out, f"{self.tag_path(tag_code)}/dt={dt}")

    def write_tag_days(self, tag_code: str, value_type, values: DataFrame, days: list[str], comment: str | None = None) -> None:
        """Replace ``days`` of a tag table with ``values(uid, tag_value, dt)`` in one job; days without rows are cleared."""
        target, days = spark_type(value_type), [check_date(d) for d in dict.fromkeys(days)]
        known = F.when(F.col("dt").isin(days), F.col("dt")).otherwise(F.raise_error(F.concat(F.lit("not a day to replace: "), "dt")))
        rows = values.select(F.col("uid").cast("string").alias("uid"), F.col("tag_value").cast(target).alias("tag_value"),
                             known.alias("dt"))
        path, found = self.tag_path(tag_code), Observation()
        rows = rows.observe(found, *[F.count_if(F.col("dt") == d).alias(d) for d in days])
        writer = rows.write.partitionBy("dt")
        if self.catalog_tables:
            folder = f"{path}/_days-{uuid.uuid4().hex[:12]}"
            writer.parquet(folder)
            name = self.create_tag_table(tag_code, value_type, comment)
            for d in days:
                if found.get.get(d):
                    self._swap_in(name, d, f"{folder}/dt={d}")
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        empty = self.spark.createDataFrame([], tag_table_schema(value_type)).drop("dt")
        for d in days:
            if not found.get.get(d):
                self.write_tag_day(tag_code, value_type, empty, d, comment)

    def _publish_day(self, name: str, rows: DataFrame, path: str, day: str, compression: str | None = None) -> None:
        """Write ``rows`` to a new folder of a catalog table and make it the day's partition."""
        folder = f"{path}/_day-{day}-{uuid.uuid4().hex[:12]}"
        try:
            (rows.write.option("compression", compression) if compression else rows.write).parquet(folder)
        except Exception:
            delete_folder(self.spark, folder)
            raise
        self._swap_in(name, day, folder)

    def _swap_in(self, name: str, day: str, folder: str) -> None:
        """Point a day's partition at ``folder`` (one step of the metastore), then remove what it was."""
        old = self._day_folder(name, day)
        if old is None:
            self.spark.sql(f"ALTER TABLE {name} ADD PARTITION (dt = '{day}') LOCATION '{_literal(folder)}'")
        else:
            self.spark.sql(f"ALTER TABLE {name} PARTITION (dt = '{day}') SET LOCATION '{_literal(folder)}'")
        self.spark.sql(f"REFRESH TABLE {name}")
        if old is not None:
            delete_folder(self.spark, old)

    def _day_folder(self, name: str, day: str) -> str | None:
        if not self.spark.sql(f"SHOW PARTITIONS {name} PARTITION (dt = '{day}')").take(1):
            return None
        said = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION (dt = '{day}')").collect()
        return next(r["data_type"] for r in said if r["col_name"] == "Location")

    def _read(self, table: str, path: str, schema: T.StructType, day: str | None = None) -> DataFrame:
        if not self.catalog_tables:
            return _read_partitioned(self.spark, path, schema, day)
        name = self._qualified(table)
        if not self.spark.catalog.tableExists(name.replace("`", "")):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.table(name).select(*schema.fieldNames())
        return rows if day is None else rows.filter(F.col("dt") == day)

    def _qualified(self, table: str) -> str:
        # Always with its database: a temp view of the same name must not stand in for the table.
        return f"{_ident(self.database or self.spark.catalog.currentDatabase())}.{_ident(table)}"

    def tag_table_name(self, tag_code: str) -> str:
        return self._qualified(tag_code.lower())

    def create_tag_table(self, tag_code: str, value_type, comment: str | None = None) -> str:
        """Catalog table over the tag table's folder, typed by value type, commented with the tag's name."""
        name = self.tag_table_name(tag_code)
        about = f" COMMENT '{_literal(comment)}'" if comment else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (uid STRING COMMENT 'user id', tag_value "
                       f"{spark_type(value_type).simpleString()} COMMENT 'tag value', dt STRING COMMENT 'business day') "
                       f"USING parquet PARTITIONED BY (dt){about} LOCATION '{_literal(self.tag_path(tag_code))}'")
        return name

    def read_tag_table(self, tag_code: str, value_type) -> DataFrame:
        return self._read(tag_code.lower(), self.tag_path(tag_code), tag_table_schema(value_type))

    def read_tag_day(self, tag_code: str, value_type, dt: str) -> DataFrame:
        return self._read(tag_code.lower(), self.tag_path(tag_code), tag_table_schema(value_type),
                          check_date(dt)).select("uid", "tag_value")

    # wide tables ----------------------------------------------------------
    def wide_path(self, dt: str) -> str:
        return f"{self.root}/{wide_table_name(check_date(dt))}"

    def write_wide(self, wide: DataFrame, dt: str, comments: dict[str, str] | None = None) -> None:
        """Drop-and-recreate semantics: the day's wide table is replaced whole
        (its columns are that day's active tags, so the schema can change).
        ``comments`` are the tag names by column."""
        replace_folder(wide, self.wide_path(dt))
        if self.catalog_tables:
            name = self._qualified(wide_table_name(dt))
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()} COMMENT '{_literal((comments or {}).get(f.name, f.name))}'"
                for f in wide.schema.fields)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # a table with LOCATION keeps its files
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet COMMENT 'merged tags of {dt}' "
                           f"LOCATION '{_literal(self.wide_path(dt))}'")

    def read_wide(self, dt: str) -> DataFrame:
        return self.spark.read.parquet(self.wide_path(dt))

    # bitmap tables --------------------------------------------------------
    def bitmap_path(self, value_type) -> str:
        return f"{self.root}/{bitmap_table_name(value_type)}"

    def write_bitmap_day(self, value_type, bitmaps: DataFrame, dt: str) -> None:
        users = F.col("users") if "users" in bitmaps.columns else users_in("us")
        out = bitmaps.select("tag_code", "tag_value", "bucket", "us", users.cast("long").alias("users"))
        day = date_token(check_date(dt))
        if not self.catalog_tables:
            replace_folder(out, f"{self.bitmap_path(value_type)}/dt={day}", compression="zstd")
            return
        name = self._qualified(bitmap_table_name(value_type))
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (tag_code STRING, tag_value STRING, "
                       f"bucket BIGINT, us BINARY, users BIGINT, dt STRING) USING parquet "
                       f"PARTITIONED BY (dt) LOCATION '{_literal(self.bitmap_path(value_type))}'")
        self._publish_day(name, out, self.bitmap_path(value_type), day, compression="zstd")

    def read_bitmap_table(self, value_type) -> DataFrame:
        return self._read(bitmap_table_name(value_type), self.bitmap_path(value_type), BITMAP_SCHEMA)

    def read_bitmap_day(self, value_type, dt: str) -> DataFrame:
        return self._read(bitmap_table_name(value_type), self.bitmap_path(value_type), BITMAP_SCHEMA, date_token(check_date(dt)))

    def read_bitmap_days(self, value_type, first: str, last: str) -> DataFrame:
        """Bitmaps of the days ``first`` to ``last``; other days are pruned by their folder."""
        a, b = date_token(check_date(first)), date_token(check_date(last))
        return self.read_bitmap_table(value_type).filter(F.col("dt").between(a, b))

    # SQL access -------------------------------------------------------------
    def register_views(self, tags, dts=(), value_types=()) -> list[str]:
        """Temp views named like the tables, for SQL over stored results:
        ``<tag_code>`` per tag (all days), ``up_tag_merge_<yyyyMMdd>`` per
        day in ``dts``, ``user_tag_value_<type>`` per value type.  A view
        lists its files when made; register again after new writes."""
        names = []
        for tag in tags:
            self.read_tag_table(tag.tag_code, tag.tag_value_type).createOrReplaceTempView(tag.column)
            names.append(tag.column)
        for dt in dts:
            self.read_wide(dt).createOrReplaceTempView(wide_table_name(dt))
            names.append(wide_table_name(dt))
        for code in value_types:
            self.read_bitmap_table(code).createOrReplaceTempView(bitmap_table_name(code))
            names.append(bitmap_table_name(code))
        return names
