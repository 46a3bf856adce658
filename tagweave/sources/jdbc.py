"""JDBC source and sinks (catalog reads, wide-table export, row append).

Thin option sets over Spark's own JDBC data source.  Reads can be split into
parallel range queries with ``partition_column``; writes default to the
serving-store settings the export job uses (100-row batches, no transaction,
at most 4 concurrent connections).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EXPORT_BATCH_SIZE = 100
EXPORT_ISOLATION = "NONE"
EXPORT_PARTITIONS = 4


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: dict[str, str] | None = None, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              fetch_size: int | None = None) -> DataFrame:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    reader = spark.read.format("jdbc").option("url", url)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if query is not None:
        if partition_column:
            raise ValueError("partitioned reads need table=, Spark does not split query=")
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    if fetch_size:
        reader = reader.option("fetchsize", str(fetch_size))
    return reader.load()


def _writer(df: DataFrame, url: str, table: str, properties: dict[str, str] | None,
            batch_size: int, isolation: str, num_partitions: int):
    writer = (df.write.format("jdbc").option("url", url).option("dbtable", table)
              .option("batchsize", str(batch_size)).option("isolationLevel", isolation)
              .option("numPartitions", str(num_partitions)))
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    return writer


def export_jdbc(df: DataFrame, url: str, table: str, column_types: str | None = None,
                table_options: str | None = None, properties: dict[str, str] | None = None,
                batch_size: int = EXPORT_BATCH_SIZE, isolation: str = EXPORT_ISOLATION,
                num_partitions: int = EXPORT_PARTITIONS) -> None:
    """Drop, recreate and fill ``table`` (rerunnable: it always starts empty)."""
    writer = _writer(df, url, table, properties, batch_size, isolation, num_partitions)
    writer = writer.option("truncate", "false")
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    if table_options:
        writer = writer.option("createTableOptions", table_options)
    writer.mode("overwrite").save()


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                batch_size: int = 1000, isolation: str = "READ_UNCOMMITTED",
                num_partitions: int = EXPORT_PARTITIONS) -> None:
    """Append rows to an existing table (columns by name)."""
    _writer(df, url, table, properties, batch_size, isolation, num_partitions).mode("append").save()
