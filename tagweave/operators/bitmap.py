"""Inverted index: wide table -> uid bitmaps per (tag_code, tag_value).

Unpivot the wide table to ``(uid, tag_code, tag_value)``, drop empty cells,
then aggregate per ``(tag_code, tag_value, bucket)``.  A bucket covers 32768
uids, so a value held by a third of all users spreads over ``users / 32768``
independent groups; a group is stored as its positions, its runs of consecutive
positions or a 4 KB bitmap, whichever is smallest (see
:mod:`tagweave.functions.bitmap`).  Bitmaps of several days are united state to
state (:func:`merge_days`).
Multi-valued cells (``'a,b'``) are one value, as in the wide table.

Audience selection (AND / OR of several ``(tag_code, tag_value)`` pairs)
stays bitmap-to-bitmap per bucket; :func:`tagweave.functions.bitmap.decode`
turns a result back into uid rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions import bitmap as bm
from tagweave.functions.values import BITMAP_TABLE_SUFFIX, date_token
from tagweave.sources.catalog import TagDef


STATE_KEY = ("tag_code", "tag_value", "bucket")


def unpivot_wide(wide: DataFrame, columns: list[str]) -> DataFrame:
    """``(uid, tag_code, tag_value)`` for every non-empty cell (``unpivot``)."""
    long = wide.unpivot("uid", [c.lower() for c in columns], "tag_code", "tag_value")
    return long.filter(F.col("tag_value") != "")


def explode_wide(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Same rows as :func:`unpivot_wide`, via ``explode(array(struct(code, value)))``."""
    pairs = F.array(*[F.struct(F.lit(c.lower()).alias("tag_code"), F.col(c.lower()).alias("tag_value"))
                      for c in columns])
    return (wide.select("uid", F.explode(pairs).alias("kv"))
            .select("uid", "kv.tag_code", "kv.tag_value")
            .filter(F.col("tag_value") != ""))


def _matches(conditions: list[tuple[str, str]]) -> Column:
    """Rows of any of the (tag_code, tag_value) pairs."""
    wanted = F.lit(False)
    for code, value in dict.fromkeys(conditions):
        wanted |= (F.col("tag_code") == F.lit(code.lower())) & (F.col("tag_value") == F.lit(value))
    return wanted


def build_bitmaps(long: DataFrame, dt: str | None = None, only: list[tuple[str, str]] | None = None) -> DataFrame:
    """``(tag_code, tag_value, bucket, us, users[, dt])`` from ``(uid, tag_code, tag_value)``.

    ``only`` names the (tag_code, tag_value) pairs that are wanted: a filter on
    the result would come after all bitmaps are built, as the task function
    that builds them hides its columns from the optimizer.

    ``users`` is the bitmap's cardinality, stored beside it so audience
    sizes read an 8-byte column instead of the 4 KB bitmaps.

    The compact cells are shuffled on the full key ``(tag_code, tag_value,
    bucket)`` and each bitmap is built once, after the exchange.  A map-side
    partial bitmap costs a sort plus a fixed 4 KB state per (task, key):
    with uids scattered over map tasks (the wide table is hash-partitioned
    on uid) each would hold a handful of uids, for about 3x the CPU and 10x
    the task memory at the same compressed shuffle size (see README).  A key
    never has more than 32768 rows (one per uid of its bucket), so no
    reducer group can grow with the data.  The sorted positions of many groups
    become states at once with arrays (see :func:`tagweave.functions.bitmap.build_states`):
    no set, list or 4 KB buffer is made for a group that does not store it.
    """
    key = list(STATE_KEY)
    long = long if only is None else long.filter(_matches(only))
    uid = bm.checked_uid(F.col("uid"))
    keyed = (long.select("tag_code", "tag_value", uid.alias("_uid"))
             .select("tag_code", "tag_value", bm.bucket(F.col("_uid")).alias("bucket"), bm.position(F.col("_uid")).alias("_at"))
             .repartition(*key))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (keyed.schema[k] for k in key))
    out = keyed.sortWithinPartitions(*key, "_at").mapInArrow(bm.build_states(key, "_at"), f"{kinds}, us binary, users bigint")
    if dt is not None:
        out = out.withColumn("dt", F.lit(date_token(dt)))
    return out


def bitmaps_by_type(wide: DataFrame, tags: list[TagDef], dt: str | None = None,
                    use_explode: bool = False) -> dict[str, DataFrame]:
    """One bitmap frame per value type (every known type, empty when no tag has it)."""
    out = {}
    for code in BITMAP_TABLE_SUFFIX:
        cols = [t.column for t in tags if t.tag_value_type == code]
        if cols:
            long = explode_wide(wide, cols) if use_explode else unpivot_wide(wide, cols)
            out[code] = build_bitmaps(long, dt)
        else:
            out[code] = None
    return out


def merge_days(bitmaps: DataFrame) -> DataFrame:
    """``(tag_code, tag_value, bucket, us, users)``: the users that hold a value on any of the given days.

    The stored states of a key are united as they are, without going back to users.
    """
    return bm.merged(bitmaps, list(STATE_KEY))


def _one_day(df: DataFrame, value: Column) -> Column:
    """``value`` of a group, which must come from one day: bitmaps of several days would count a user twice."""
    if "dt" not in df.columns:
        return value
    return F.when(F.min("dt") != F.max("dt"), F.raise_error(F.lit("bitmaps of more than one day"))).otherwise(value)


def cardinality(bitmaps: DataFrame, keys=("tag_code", "tag_value")) -> DataFrame:
    """Users per key: the bucket counts summed (buckets are disjoint).

    The bitmaps must be of one day; a key that two days hold fails the job.

    Uses the stored ``users`` column when the frame has one, so only that
    column is read; otherwise counts the bits.
    """
    per_bucket = F.col("users") if "users" in bitmaps.columns else bm.users_in("us")
    return bitmaps.groupBy(*keys).agg(_one_day(bitmaps, F.sum(per_bucket).cast("long")).alias("users"))


def select_audience(bitmaps: DataFrame, conditions: list[tuple[str, str]], how: str = "and") -> DataFrame:
    """``(bucket, us)`` of users matching all (``and``) or any (``or``) condition.

    Conditions are ``(tag_code, tag_value)`` pairs.  Per bucket, AND needs all
    of them present (a missing one means an empty intersection there).  The
    bitmaps must be of one day, in which (code, value, bucket) is unique.
    """
    if not conditions:
        raise ValueError("an audience needs at least one condition")
    days = ["dt"] if "dt" in bitmaps.columns else []
    picked = bm.dense(bitmaps.filter(_matches(conditions)), ["tag_code", "tag_value", "bucket", *days])
    n = len(dict.fromkeys(conditions))
    if how == "and":
        per_bucket = (picked.groupBy("bucket")
                      .agg(_one_day(picked, F.bitmap_and_agg("us")).alias("us"), F.count(F.lit(1)).alias("_hits"))
                      .filter(F.col("_hits") >= n).drop("_hits"))
    elif how == "or":
        per_bucket = picked.groupBy("bucket").agg(_one_day(picked, F.bitmap_or_agg("us")).alias("us"))
    else:
        raise ValueError(f"how must be 'and' or 'or', not {how!r}")
    return per_bucket.filter(F.bitmap_count("us") > 0)


def audience_uids(bitmaps: DataFrame, conditions: list[tuple[str, str]], how: str = "and") -> DataFrame:
    """Uids of an audience, one row each."""
    return bm.decode(select_audience(bitmaps, conditions, how), keys=[]).select("uid")
