"""Serving copies of the wide table.

* :func:`serving_frame` -- ``uid`` as bigint plus the text tag columns.
* :func:`write_sorted` -- files range-partitioned and sorted by ``uid`` (the
  serving table's primary order), so readers can skip by uid ranges.
* :func:`export_wide_jdbc` -- drop/recreate/fill a JDBC table with the same
  column types and the export batch settings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.sources.jdbc import EXPORT_BATCH_SIZE, EXPORT_ISOLATION, EXPORT_PARTITIONS, export_jdbc


EXPORT_TEXT_TYPE = "TEXT"  # no length: a cell may hold all values of a user


def serving_frame(wide: DataFrame) -> DataFrame:
    uid = F.col("uid").cast("string").try_cast("bigint")
    checked = F.when(uid.isNull(), F.raise_error(F.concat(F.lit("uid is not an integer: "),
                                                          F.coalesce(F.col("uid").cast("string"),
                                                                     F.lit("NULL")))))
    return wide.select(checked.otherwise(uid).alias("uid"), *[c for c in wide.columns if c != "uid"])


def write_sorted(wide: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """Range-partition on uid, sort inside each file, write Parquet.

    ``repartitionByRange`` samples uids to place the range bounds (all rows
    are written); without ``num_partitions`` the session's shuffle partition
    count is used and AQE may coalesce small ranges.
    """
    frame = serving_frame(wide)
    ranged = (frame.repartitionByRange(num_partitions, "uid") if num_partitions
              else frame.repartitionByRange("uid"))
    ranged.sortWithinPartitions("uid").write.mode("overwrite").parquet(path)


def read_sorted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_wide_jdbc(wide: DataFrame, url: str, table: str, table_options: str | None = None,
                     properties: dict[str, str] | None = None, batch_size: int = EXPORT_BATCH_SIZE,
                     isolation: str = EXPORT_ISOLATION, num_partitions: int = EXPORT_PARTITIONS,
                     text_type: str = EXPORT_TEXT_TYPE) -> None:
    """Replace ``table`` with the wide table: ``uid BIGINT`` + one ``text_type`` column per tag.

    A database without a type of that name needs its own unbounded text type named.
    """
    frame = serving_frame(wide)
    tag_cols = [c for c in frame.columns if c != "uid"]
    column_types = ", ".join(["uid BIGINT"] + [f"{c} {text_type}" for c in tag_cols])
    export_jdbc(frame, url, table, column_types=column_types, table_options=table_options,
                properties=properties, batch_size=batch_size, isolation=isolation,
                num_partitions=num_partitions)
