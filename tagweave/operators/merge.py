"""All active tags of a day -> one wide row per uid.

1. **Long form**: every tag frame becomes ``(uid, tag_value, tag_name)`` with
   the value rendered as text *before* the union (longs ``35``, decimals
   ``9.50``), so mixed value types never widen each other.
2. **Pivot**: ``groupBy(uid).pivot(tag_name, <explicit tag list>)``; each
   cell is the sorted values joined with ``,`` (duplicates kept, NULLs
   dropped) and ``''`` when the user has none.  The long rows are shuffled
   once, on ``uid``, and everything after happens behind that one exchange:
   with about one row per user and tag a map-side combine has nothing to
   combine and would only sort.  Rows with a NULL uid form one user row.

Optional **pre-aggregation** (``preaggregate=True``) first counts
``(uid, tag_name, tag_value)`` on all three keys and collects distinct values
with counts.  It costs a second shuffle (measured: about 1.8x the CPU of the
single-shuffle plan on a workload whose hottest user holds a fifth of the
rows) and cannot shrink the hot user's output cell, which repeats every
duplicate; it pays off only for tag SQL that emits heavy duplicates spread
over many map tasks, where it shrinks the shuffle to one row per distinct
value and task.

**Heavy users** (a bot, a default account, the NULL uid) would put their whole
history into one task of that exchange.  :func:`heavy_users` measures them on a
sample; :func:`split_wide` leaves everyone else on the one exchange and builds
heavy cells in pieces: equal values are counted (combined in the map tasks), the
distinct ones are dealt by range, so each task sorts and joins a stretch of a
cell, and the cell is those stretches in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.values import TYPE_DATE, spark_type


def tag_as_text(values: DataFrame, tag_code: str, value_type: str | None = None) -> DataFrame:
    """``(uid, tag_value)`` of one tag -> ``(uid, tag_value string, tag_name)``."""
    value = F.col("tag_value")
    vtype = values.schema["tag_value"].dataType.simpleString()
    if vtype in ("date", "timestamp", "timestamp_ntz") or (value_type == TYPE_DATE and vtype != "string"):
        value = F.date_format(value, "yyyy-MM-dd")
    return values.select(F.col("uid").cast("string").alias("uid"),
                         value.cast("string").alias("tag_value"),
                         F.lit(tag_code).alias("tag_name"))


def value_as_text(value: Column, value_type: str) -> Column:
    """A value in its tag's type as text (type 4 is text already)."""
    return value.cast(spark_type(value_type)).cast("string")


def union_long(frames: list[tuple[str, DataFrame]], value_types: dict[str, str] | None = None) -> DataFrame:
    """N-way ``UNION ALL`` of the text-rendered tag frames."""
    if not frames:
        raise ValueError("no tags to merge")
    value_types = value_types or {}
    return reduce(DataFrame.unionByName, [tag_as_text(df, code, value_types.get(code)) for code, df in frames])


def _joined_values(entries: Column) -> Column:
    """``array<struct<v, n>>`` -> ``'a,a,b'`` (sorted, duplicates kept, NULLs dropped)."""
    ordered = F.array_sort(entries)
    repeated = F.transform(ordered, lambda e: F.array_repeat(e["v"], e["n"].cast("int")))
    return F.concat_ws(",", F.flatten(repeated))


def _prepared(long: DataFrame, keys: list[str], preaggregate: bool) -> tuple[DataFrame, Column]:
    """The rows to group and the per-group cell expression."""
    if preaggregate:
        group = list(dict.fromkeys(keys + ["tag_name", "tag_value"]))
        counted = long.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
        return counted, _joined_values(F.collect_list(F.struct(F.col("tag_value").alias("v"), "n")))
    return long, F.concat_ws(",", F.array_sort(F.collect_list("tag_value")))


def collect_values(long: DataFrame, keys: list[str], preaggregate: bool = False) -> DataFrame:
    """Per ``keys`` group: its values joined as text (the multi-value cell)."""
    rows, cell = _prepared(long, keys, preaggregate)
    return rows.groupBy(*keys).agg(F.coalesce(cell, F.lit("")).alias("tag_value"))


def _columns(tag_codes: list[str]) -> list[str]:
    columns = [c.lower() for c in tag_codes]
    if len(set(columns)) != len(columns):
        raise ValueError("tag codes must stay distinct when lower-cased")
    if "uid" in columns:
        raise ValueError("tag code 'uid' is reserved for the user column")
    return columns


def pivot_wide(long: DataFrame, tag_codes: list[str], preaggregate: bool = False) -> DataFrame:
    """Long form -> ``uid`` + one lower-cased text column per tag (in given order)."""
    columns = _columns(tag_codes)
    rows, cell = _prepared(long, ["uid"], preaggregate)
    rows = rows.repartition("uid")
    pivoted = rows.groupBy("uid").pivot("tag_name", list(tag_codes)).agg(cell)
    return pivoted.select("uid", *[F.coalesce(F.col(f"`{code}`"), F.lit("")).alias(col)
                                   for code, col in zip(tag_codes, columns)])


def map_wide(long: DataFrame, tag_codes: list[str], preaggregate: bool = False) -> DataFrame:
    """Same result as :func:`pivot_wide`, for catalogs with many tags.

    A string pivot keeps one collect buffer per tag in every user's
    aggregation state, so its memory grows with the tag count.  Here each
    ``(uid, tag)`` cell is joined first, then every user carries one
    ``tag -> cell`` map that the output columns look up.
    """
    columns = _columns(tag_codes)
    wanted = long.filter(F.col("tag_name").isin(list(tag_codes)))
    rows, cell = _prepared(wanted, ["uid", "tag_name"], preaggregate)
    # Distributed by uid, both groupings find their rows in place.
    cells = rows.repartition("uid").groupBy("uid", "tag_name").agg(F.coalesce(cell, F.lit("")).alias("tag_value"))
    per_uid = cells.groupBy("uid").agg(
        F.map_from_entries(F.collect_list(F.struct("tag_name", "tag_value"))).alias("_cells"))
    return per_uid.select("uid", *[F.coalesce(F.try_element_at("_cells", F.lit(code)), F.lit("")).alias(col)
                                   for code, col in zip(tag_codes, columns)])


# A user is heavy with at least this share of the rows: about half of what one of 200 tasks gets.
HEAVY_SHARE = 1 / 400
HEAVY_SAMPLE = 0.01
HEAVY_LEAST = 50  # rows of a user in the sample: fewer harm no task, whatever their share


def heavy_users(long: DataFrame, share: float = HEAVY_SHARE, sample: float = HEAVY_SAMPLE, seed: int = 42,
                least: int = HEAVY_LEAST) -> list[str | None]:
    """Uids (None: the NULL uid) with at least ``share`` of the rows and ``least`` rows, measured on a sample.

    The answer has at most ``1 / share`` entries.  It only decides how rows
    are dealt, never what the result is: a user that the sample misses is merged
    like any other.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    rows = long.select("uid") if sample >= 1 else long.select("uid").sample(False, sample, seed)
    counts = rows.groupBy("uid").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return []
    return [r.uid for r in counts.filter(F.col("n") >= max(share * total, least)).orderBy(F.desc("n")).limit(int(1 / share)).collect()]


def _is_heavy(heavy: list[str | None]) -> Column:
    known = [u for u in heavy if u is not None]
    listed = F.coalesce(F.col("uid").isin(known), F.lit(False)) if known else F.lit(False)
    return listed | F.col("uid").isNull() if None in heavy else listed


def heavy_stretches(long: DataFrame) -> DataFrame:
    """``(uid, tag_name, part, stretch)``: the sorted, joined values of a cell in pieces, in the order of ``part``.

    A stretch without values (all NULL) is NULL.
    """
    keys = ["uid", "tag_name", "tag_value"]
    counted = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    dealt = counted.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    entries = F.collect_list(F.when(F.col("tag_value").isNotNull(), F.struct(F.col("tag_value").alias("v"), "n")))
    return (dealt.groupBy("uid", "tag_name", "part").agg(entries.alias("entries"))
            .select("uid", "tag_name", "part",
                    F.when(F.size("entries") > 0, _joined_values(F.col("entries"))).alias("stretch")))


def heavy_wide(long: DataFrame, tag_codes: list[str]) -> DataFrame:
    """The rows of :func:`pivot_wide` for few users with very many values."""
    columns = _columns(tag_codes)
    ordered = F.array_sort(F.collect_list(F.struct("part", "stretch")))
    cells = heavy_stretches(long).groupBy("uid", "tag_name").agg(
        F.concat_ws(",", F.transform(ordered, lambda s: s["stretch"])).alias("cell"))
    pivoted = cells.groupBy("uid").pivot("tag_name", list(tag_codes)).agg(F.first("cell"))
    return pivoted.select("uid", *[F.coalesce(F.col(f"`{code}`"), F.lit("")).alias(col)
                                   for code, col in zip(tag_codes, columns)])


def split_wide(long: DataFrame, tag_codes: list[str], heavy: list[str | None], preaggregate: bool = False,
               method: str = "auto") -> DataFrame:
    """The wide table with the users of ``heavy`` merged in pieces, all others as in :func:`merge_long`."""
    if not heavy:
        return merge_long(long, tag_codes, preaggregate, method)
    is_heavy = _is_heavy(heavy)
    light = merge_long(long.filter(~is_heavy), tag_codes, preaggregate, method)
    return light.unionByName(heavy_wide(long.filter(is_heavy), tag_codes))


# Above this many tags the map form replaces the pivot (see :func:`map_wide`).
PIVOT_TAG_LIMIT = 64


def merge_tags(frames: list[tuple[str, DataFrame]], value_types: dict[str, str] | None = None,
               preaggregate: bool = False, method: str = "auto") -> DataFrame:
    """Tag frames (in tag order) -> wide table (``method``: auto, pivot or map)."""
    return merge_long(union_long(frames, value_types), [code for code, _ in frames], preaggregate, method)


def merge_long(long: DataFrame, codes: list[str], preaggregate: bool = False, method: str = "auto") -> DataFrame:
    """The long form (uid, tag_value, tag_name) of the tags ``codes`` -> wide table."""
    if method == "map" or (method == "auto" and len(codes) > PIVOT_TAG_LIMIT):
        return map_wide(long, codes, preaggregate)
    if method not in ("auto", "pivot"):
        raise ValueError(f"unknown merge method {method!r}")
    return pivot_wide(long, codes, preaggregate)
