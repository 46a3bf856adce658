"""Tag value types, typed literals, casts and small column helpers.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import re
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's:
# value type codes: "1" long, "2" decimal(16,2), "3" string, "4" date kept as text;
# wide table name prefix "up_tag_merge_"; bitmap table name prefix "user_tag_value_";
# bitmap table suffix per type: "1" long, "2" decimal, "3" string, "4" date;
# active task status "1".
TYPE_LONG, TYPE_DECIMAL, TYPE_STRING, TYPE_DATE = "1", "2", "3", "4"
WIDE_TABLE_PREFIX = "up_tag_merge_"
BITMAP_TABLE_PREFIX = "user_tag_value_"
BITMAP_TABLE_SUFFIX = {TYPE_LONG: "long", TYPE_DECIMAL: "decimal",
                       TYPE_STRING: "string", TYPE_DATE: "date"}
TASK_ACTIVE = "1"

DECIMAL_TYPE = T.DecimalType(16, 2)
_SPARK_TYPES = {TYPE_LONG: T.LongType(), TYPE_DECIMAL: DECIMAL_TYPE,
                TYPE_STRING: T.StringType(), TYPE_DATE: T.StringType()}
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
            T.FloatType, T.DoubleType, T.DecimalType)


def _code(value_type) -> str:
    return str(value_type).strip()


def spark_type(value_type) -> T.DataType:
    """Column type of a tag table for a value-type code; unknown codes raise."""
    code = _code(value_type)
    if code not in _SPARK_TYPES:
        raise ValueError(f"unknown tag value type {value_type!r}")
    return _SPARK_TYPES[code]


def bitmap_table_name(value_type) -> str:
    code = _code(value_type)
    if code not in BITMAP_TABLE_SUFFIX:
        raise ValueError(f"unknown tag value type {value_type!r}")
    return BITMAP_TABLE_PREFIX + BITMAP_TABLE_SUFFIX[code]


_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


def check_date(dt: str) -> str:
    """The business date, checked to be ``yyyy-MM-dd``."""
    if not _DATE.fullmatch(dt or ""):
        raise ValueError(f"business date must be yyyy-MM-dd, got {dt!r}")
    return dt


def date_token(dt: str) -> str:
    """``yyyy-MM-dd`` -> ``yyyyMMdd`` as used in table names and bitmap days."""
    return dt.replace("-", "")


def date_token_col(col) -> Column:
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, "-", "")


def wide_table_name(dt: str) -> str:
    return WIDE_TABLE_PREFIX + date_token(dt)


def rule_value(text: Column, value_type) -> Column:
    """Rule output text as a value of the tag's type; both mapping forms use it.

    String and date tags take the text as is.  Numeric tags need text that
    casts to the type (decimals round half-up to two places and must fit
    (16,2)); a row that maps to any other text fails the job.
    """
    target = spark_type(value_type)
    if isinstance(target, T.StringType):
        return text.cast(target)
    raw = F.trim(text)
    value = raw.try_cast(target)
    return F.when(raw.isNotNull() & value.isNull(),
                  F.raise_error(F.concat(F.lit("rule value is not a number: "), raw))).otherwise(value)


def match_type(source_type: T.DataType) -> T.DataType:
    """Type in which a rule's text and ``query_value`` are compared.

    Exact numbers compare in a wide decimal, so ``1.0`` matches the whole
    number 1 and ``1.004`` never matches 1.00; other numbers compare as
    doubles, everything else in its own type.
    """
    if isinstance(source_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.DecimalType(38, 18)
    if isinstance(source_type, T.DecimalType):
        if source_type.precision - source_type.scale <= 20 and source_type.scale <= 18:
            return T.DecimalType(38, 18)
        return T.DoubleType()
    if isinstance(source_type, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return source_type


def rule_key(text, source_type: T.DataType) -> Column:
    """Rule match text (a string or a column) in the comparison type; text that does not convert never matches."""
    col = text if isinstance(text, Column) else F.lit(text)
    if isinstance(source_type, T.StringType):
        return col
    return col.try_cast(match_type(source_type))


def value_key(col: Column, source_type: T.DataType) -> Column:
    """``query_value`` in the comparison type."""
    target = match_type(source_type)
    return col if target == source_type else col.cast(target)


def to_tag_type(col: Column, source_type: T.DataType, value_type, what: str = "tag_value") -> Column:
    """Cast a raw value to the tag column type, the way a typed insert does.

    Numeric -> numeric and anything -> string are allowed; text into a numeric
    tag is rejected up front.  A numeric value that does not fit the target
    (e.g. decimal(16,2) overflow) fails the job instead of turning into NULL.
    A timestamp in a date tag (type 4) keeps its day and loses its time.
    """
    target = spark_type(value_type)
    if isinstance(target, T.StringType):
        if isinstance(source_type, (T.DateType, T.TimestampType, T.TimestampNTZType)) \
                and _code(value_type) == TYPE_DATE:
            return F.date_format(col, "yyyy-MM-dd")
        return col.cast(target)
    if not isinstance(source_type, _NUMERIC):
        raise TypeError(f"{what} of type {source_type.simpleString()} cannot be stored "
                        f"in a {target.simpleString()} tag")
    if source_type == target:
        return col
    converted = col.try_cast(target)
    return F.when(col.isNotNull() & converted.isNull(),
                  F.raise_error(F.concat(F.lit(f"{what} out of range for {target.simpleString()}: "),
                                         col.cast("string")))
                  ).otherwise(converted)


def epoch_millis(col) -> Column:
    """Timestamp -> epoch milliseconds at second precision (sub-seconds dropped).

    A TIMESTAMP is an instant; a TIMESTAMP_NTZ is read as UTC wall-clock time.
    Neither depends on the session time zone (a plain DATE or text does not occur here).
    """
    c = F.col(col) if isinstance(col, str) else col
    wall = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c.cast(T.TimestampNTZType()))
    instant = F.unix_seconds(c.cast(T.TimestampType()))
    return F.when(F.typeof(c) == "timestamp", instant).otherwise(wall) * F.lit(1000)


def camel_name(name: str) -> str:
    """``lower_underscore`` -> ``lowerCamel`` (first word lower, others capitalised)."""
    parts = name.split("_")
    head = parts[0].lower()
    return head + "".join(p[:1].upper() + p[1:].lower() for p in parts[1:])
