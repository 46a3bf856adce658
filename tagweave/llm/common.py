"""Helpers shared by the operators: shared folders, lineage cuts, Arrow batches, split letters."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.session import storage_root

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# The upper-case letters that "lower-case A-Z" replaces, and their replacements.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def workers_can_import(spark: SparkSession) -> None:
    """Let Python workers import this package by name where nothing else does (a plain local session).

    Also lowers the rows of an Arrow batch from Spark's default: texts are wide
    rows, and a batch is held by the JVM and the worker at once.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, never reused folder name below ``spark.checkpoint.dir``; the writer creates the folder."""
    return f"{storage_root(spark)}/tagweave/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the session's shared checkpoint folder (eager)."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(storage_root(df.sparkSession))
    return df.checkpoint(eager=True)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_rows(docs: DataFrame) -> DataFrame:
    """(row, row_id, row_hash): every row as one struct beside its id and the hash of its text.

    Whatever the columns of ``docs`` are called, they clash with nothing that is joined.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("row_id"), F.xxhash64("text").alias("row_hash"))


def fold_of(doc_id: Column) -> Column:
    """crc32 of the decimal id, mod 4; a null id counts as the empty string.  Fold 2 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a part's ``column`` (text) holds about ``limit`` characters, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)
        del batch
        pa.default_memory_pool().release_unused()  # reused workers would keep the peak of every stage
