"""Delimited text tables (Hive text layout: tab separated, ``\\N`` for NULL).

Compression is chosen per write (gzip, deflate, bzip2, snappy, ...); reads
pick the codec from the file extension.  A backslash, tab, line feed or
carriage return inside a value is written as ``\\\\``, ``\\t``, ``\\n`` or
``\\r``, so every text (blanks at its ends, line breaks, a literal ``\\N``)
survives a round trip, and a line is always one row.

A gzip file is read by one task, so a write closes a file at ``MAX_ROWS`` rows;
bzip2 files are split by the reader at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL = "\\N"
_ESCAPES = [("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def _escaped(col: Column) -> Column:
    out = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    for raw, mark in _ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(mark))
    return out


def _unescaped(col: Column) -> Column:
    def part(piece: Column) -> Column:
        for raw, mark in _ESCAPES:
            piece = F.replace(piece, F.lit(mark), F.lit(raw))
        return piece

    # Between escaped backslashes every backslash starts a mark.
    return F.array_join(F.transform(F.split(col, r"\\\\", -1), part), "\\")


MAX_ROWS = 2_000_000  # rows of one file; about 100 MB of a tag table as text


def write_tsv(df: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite", max_rows: int = MAX_ROWS) -> None:
    """Write ``df`` as text; no file has more than ``max_rows`` rows."""
    cells = [F.coalesce(_escaped(F.col(f"`{c}`").cast("string")), F.lit(NULL)) for c in df.columns]
    df.select(F.concat_ws("\t", *cells).alias("value")).write.mode(mode).option(
        "compression", compression).option("maxRecordsPerFile", max_rows).text(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows typed by ``schema``; a line with another number of cells, or a cell that does not convert, fails the job."""
    cells = F.split("value", "\t", -1)
    n = len(schema.fields)
    checked = F.when(F.size(cells) != n, F.raise_error(F.concat(F.lit(f"a line does not have {n} cells: "), "value"))
                     ).otherwise(cells)
    columns = []
    for i, f in enumerate(schema.fields):
        cell = F.col("cells")[i]
        text = F.when(cell == NULL, None).otherwise(_unescaped(cell))
        value = text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)
        bad = text.isNotNull() & value.isNull()
        columns.append(F.when(bad, F.raise_error(F.concat(F.lit(f"not a {f.dataType.simpleString()}: "), text)))
                       .otherwise(value).alias(f.name))
    return spark.read.text(path).select(checked.alias("cells")).select(*columns)
