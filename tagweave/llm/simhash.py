"""SimHash fingerprints and exact near-duplicate groups by tiled comparison.

``fingerprints`` hashes the word shingles of every text (XXH64, seed 42) and
sets a bit where over half the hashes have it.  ``link_tiles`` finds every pair
of distinct fingerprints within ``radius`` bits:

* fingerprints are cut into ``segments`` bit ranges; two that differ in at most
  ``radius`` bits agree on at least ``segments - radius`` of them, so rows meet
  in tiles that share such a combination of ranges (all combinations are used:
  exact, no pair is lost);
* inside, tiles are ordered by population count and compared block by block with
  numpy exclusive-or and bit counts; block pairs whose population counts differ
  by more than the radius are skipped;
* a combination that is shared by more than ``TILE`` fingerprints is cut into
  tiles by population count and hash, and its tile pairs (again only those within
  the radius) become separate work items, so no task holds an unbounded group;
* each work item returns a spanning forest of the links it found, never all pairs.

Equal fingerprints are collapsed by a map-side combined aggregate first.
``classes`` then takes connected components.

Defined results: a null or empty text has fingerprint zero, which links like
any other; repeated rows share a fingerprint; a null ``doc_id`` never becomes a
component id unless its whole component has none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import whole_rows, written
from tagweave.llm.components import components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
TILE = 4096       # fingerprints of one work item's side
BLOCK = 1024      # rows of one exclusive-or block
GROUP_TARGET = 256  # wanted mean size of a tile; decides the number of segments


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, 1 << 16):
        stop = min(n, start + (1 << 16))
        part = [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle_words]), SEED) for i in range(start, stop)]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle_words: int = SHINGLE_WORDS):
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return fp


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash (to tell rows of one id apart) and fp (the fingerprint as a signed long)."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                       fingerprint_udf(shingle_words)(F.col("text")).alias("fp"))


# --- comparison of one work item ------------------------------------------------------------


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a[i], b[i]) reduced to one (node, smallest reachable node) row per linked node."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _blocks(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of ``a`` x ``b`` (or inside ``a``), both sorted by population count."""
    left, right = [], []
    same = b is None
    b = a if same else b
    pa_, pb = np.bitwise_count(a).astype(np.int16), np.bitwise_count(b).astype(np.int16)
    for i in range(0, len(a), BLOCK):
        x, px = a[i:i + BLOCK], pa_[i:i + BLOCK]
        for j in range(i if same else 0, len(b), BLOCK):
            y, py = b[j:j + BLOCK], pb[j:j + BLOCK]
            if py[0] - px[-1] > radius or px[0] - py[-1] > radius:
                continue
            near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            r, c = np.nonzero(near)
            left.append(x[r])
            right.append(y[c])
    if not left:
        return a[:0], a[:0]
    return np.concatenate(left), np.concatenate(right)


def _compare(key: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All links of complete work items; rows come sorted by (key, side, population count)."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    left, right = [], []
    # Many small tiles: compare each row with the d-th next one of its tile, all tiles at once.
    small = sizes <= 64
    last = np.repeat(starts + sizes, sizes)
    rows = np.flatnonzero(np.repeat(small & (sizes > 1), sizes))
    d = 1
    while len(rows):
        rows = rows[rows + d < last[rows]]
        hit = np.bitwise_count(fp[rows] ^ fp[rows + d]) <= radius
        left.append(fp[rows[hit]])
        right.append(fp[rows[hit] + d])
        d += 1
    for s, n in zip(starts[~small], sizes[~small]):
        f, two = fp[s:s + n], side[s:s + n] == 1
        a, b = _blocks(f[~two], f[two] if two.any() else None, radius)
        left.append(a)
        right.append(b)
    if not left:
        return fp[:0], fp[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    return _forest(a[a != b], b[a != b])


def _links(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> pa.RecordBatch:
            col = [table.column(n).to_numpy() for n in ("item", "side", "fp")]
            a, b = _compare(col[0], col[1], col[2].view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            last = batch.column("item")[batch.num_rows - 1].as_py()
            first = batch.column("item")[0].as_py()
            if n < (1 << 16) or first == last:
                continue  # the item at the end may go on in the next batch
            table = pa.Table.from_batches(held)
            items = table.column("item").to_numpy()
            stop = int(np.flatnonzero(items != last)[-1]) + 1
            yield flush(table.slice(0, stop))
            held = table.slice(stop).combine_chunks().to_batches()
            n = sum(x.num_rows for x in held)
        if n:
            yield flush(pa.Table.from_batches(held))

    return run


def segment_count(n: int, radius: int = RADIUS) -> int:
    """Fewest segments whose tiles hold ``GROUP_TARGET`` fingerprints on average (results never depend on it)."""
    for segments in range(radius + 1, radius + 4):
        if n <= GROUP_TARGET << (64 * (segments - radius) // segments):
            break
    return segments


def link_tiles(distinct: DataFrame, radius: int = RADIUS, segments: int | None = None,
               tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all of ``distinct`` (column fp, unique) lying within ``radius`` bits."""
    if segments is None:
        segments = segment_count(distinct.count(), radius)
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(segments), segments - radius)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        mask -= (mask >> 63) << 64  # as a signed long
        keys.append(F.struct(F.lit(number).alias("c"), F.col("fp").bitwiseAND(F.lit(mask).cast("long")).alias("v")))
    rows = distinct.select("fp", F.bit_count("fp").alias("p"), F.explode(F.array(*keys)).alias("k")).select(
        "fp", "p", "k.c", "k.v")

    sizes = rows.groupBy("c", "v", "p").agg(F.count("*").alias("n"))
    groups = sizes.groupBy("c", "v").agg(F.sum("n").alias("n"))
    plain = groups.where(f"n > 1 and n <= {tile}").select("c", "v")
    # Work items of shared keys that fit one tile.
    one = rows.join(plain, ["c", "v"]).select(F.xxhash64("c", "v").alias("item"), F.lit(0).alias("side"), "fp", "p")

    # Keys that do not fit: tiles of one population count, paired within the radius.
    large = groups.where(f"n > {tile}").select("c", "v")
    cuts = sizes.join(large, ["c", "v"]).select("c", "v", "p", F.ceil(F.col("n") / tile).cast("int").alias("cuts"))
    tiles = cuts.select("c", "v", "p", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("s"))
    other = tiles.select("c", "v", F.col("p").alias("p2"), F.col("s").alias("s2"))
    pairs = tiles.join(other, ["c", "v"]).where(
        f"p2 - p between 0 and {radius} and (p2 > p or s2 >= s)").withColumn(
        "item", F.xxhash64("c", "v", "p", "s", "p2", "s2"))
    member = rows.join(cuts, ["c", "v", "p"]).select(
        "c", "v", "p", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int").alias("s"), "fp")
    first = member.join(pairs.select("c", "v", "p", "s", "item"), ["c", "v", "p", "s"]).select(
        "item", F.lit(0).alias("side"), "fp", "p")
    second = member.join(
        pairs.where("p2 > p or s2 > s").select("c", "v", F.col("p2").alias("p"), F.col("s2").alias("s"), "item"),
        ["c", "v", "p", "s"]).select("item", F.lit(1).alias("side"), "fp", "p")

    work = one.unionByName(first).unionByName(second)
    work = work.repartition("item").sortWithinPartitions("item", "side", "p").select("item", "side", "fp")
    return work.mapInArrow(_links(radius), "a long, b long")


def classes(fps: DataFrame, radius: int = RADIUS, segments: int | None = None, tile: int = TILE) -> DataFrame:
    """``fps`` (doc_id, fp, ...) with the fingerprint ``root`` of its component and its ``component_id``.

    ``component_id`` is the smallest doc_id of the component.
    """
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = components(link_tiles(distinct.select("fp"), radius, segments, tile))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "low")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = named.select("fp", "root").join(lows, "root")
    return fps.join(by_fp, "fp")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per row of ``docs``."""
    fps = written(fingerprints(docs, shingle_words), "simhash-fp")
    return classes(fps, radius).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with only the first document (smallest id, then text hash) of each component."""
    fps = written(fingerprints(docs, shingle_words), "simhash-fp")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    members = written(classes(fps, radius).select("root", "doc_id", "text_hash"), "simhash-members")
    first = members.groupBy("root").agg(F.min(order).alias("f")).select("root", "f.doc_id", "f.text_hash")
    # Few rows fall out, so the join carries the losers, not the survivors.
    same = (members["doc_id"].eqNullSafe(first["doc_id"])) & (members["text_hash"] == first["text_hash"])
    losers = written(members.join(first, (members["root"] == first["root"]) & same, "left_anti").select(
        "doc_id", "text_hash").distinct(), "simhash-losers")
    twins = written(members.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select(
        "doc_id", "text_hash"), "simhash-twins")
    rows = whole_rows(docs)

    def here(other: DataFrame):
        return rows["row_id"].eqNullSafe(other["doc_id"]) & (rows["row_hash"] == other["text_hash"])

    kept = rows.join(losers, here(losers), "left_anti")
    if not twins.isEmpty():
        # Rows that repeat an id and its text: the group keeps one of them.
        repeated = kept.join(twins, here(twins), "left_semi").dropDuplicates(["row_id", "row_hash"])
        kept = kept.join(twins, here(twins), "left_anti").unionByName(repeated)
    return kept.select("row.*")
