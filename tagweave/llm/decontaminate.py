"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet where they share a seed, ``least``
consecutive words (a map-side join with the seed table).  Each meeting pair is
tiled: running Karp-Rabin finds the longest common word runs that are not yet
marked, marks them without overlap, and goes on with shorter ones down to
``least``.  The share of an item's words that tiles cover is its coverage, so a
passage whose sentences were put into another order is found as well.

The seed table is broadcast, so the benchmark is cut into blocks of at most
``BLOCK_CHARS`` characters (checked by a count first) and documents are scanned
once for each block; the documents themselves are never shuffled, and no number
of documents that share a passage makes a hot key.

Defined results: words are runs of letters and digits (A-Z lower-cased, any
character above ASCII counts as a letter); null and empty texts have none and
match nothing; items of fewer than ``least`` words are never reported; repeated
benchmark rows count once; repeated documents each get their rows; other
columns are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import small_batches, whole_rows, written

LEAST = 5               # words of a seed and of the shortest tile
COVERAGE = 0.5          # share of an item's words that makes a document contaminated
BLOCK_CHARS = 4 << 20   # benchmark characters in one broadcast
PART_CHARS = 1 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_R = np.uint64(0x9E3779B97F4A7C15)  # odd, so every window hash below can be shifted back


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def window_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` ids (modulo 2**64).

    With s the running sum of ``ids[i] / R**i``, a window's hash is the difference
    of two sums, shifted to the window's last place.
    """
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        back = np.full(len(ids), pow(int(_R), -1, 1 << 64), dtype=np.uint64)
        forth = np.full(len(ids), _R, dtype=np.uint64)
        back[0] = forth[0] = 1
        back, forth = np.cumprod(back), np.cumprod(forth)
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(ids.astype(np.uint64) * back)]
        return (sums[length:] - sums[:n]) * forth[length - 1:]


def _match_lengths(p: np.ndarray, t: np.ndarray, used_p, used_t, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many free words from pattern places ``i`` and text places ``j`` on are equal."""
    size, open_ = np.zeros(len(i), dtype=np.int64), np.arange(len(i))
    while len(open_):
        a, b = i[open_] + size[open_], j[open_] + size[open_]
        inside = (a < len(p)) & (b < len(t))
        open_, a, b = open_[inside], a[inside], b[inside]
        open_ = open_[(p[a] == t[b]) & ~used_p[a] & ~used_t[b]]
        size[open_] += 1
    return size


def greedy_tiles(pattern: list[int], text: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (pattern start, text start, length): longest first, none overlapping in either sequence."""
    p, t = np.array(pattern, dtype=np.int64), np.array(text, dtype=np.int64)
    used_p, used_t = np.zeros(len(p), dtype=bool), np.zeros(len(t), dtype=bool)
    tiles: list[tuple[int, int, int]] = []
    search = max(least, min(len(p), len(t)) // 2)
    while np.count_nonzero(~used_p) >= least:
        h = window_hashes(t, search)
        order = np.argsort(h, kind="stable")
        wanted = window_hashes(p, search)
        low, high = (np.searchsorted(h[order], wanted, side=s) for s in ("left", "right"))
        starts_i, starts_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(high > low).tolist():
            j = order[low[i]:high[i]]
            if i and not used_p[i - 1]:
                # Only the start of a run: a run that began one word earlier is already in.
                j = j[(j == 0) | used_t[j - 1] | (t[j - 1] != p[i - 1])]
            starts_i.append(np.full(len(j), i))
            starts_j.append(j)
        i, j = np.concatenate(starts_i), np.concatenate(starts_j)
        size = _match_lengths(p, t, used_p, used_t, i, j)
        longest = int(size.max()) if len(size) else 0
        if longest > 2 * search:
            search = longest
            continue
        found = defaultdict(list)
        for a, b, n in zip(i.tolist(), j.tolist(), size.tolist()):
            if n >= search:
                found[n].append((a, b))
        length = longest
        while length >= search:
            for a, b in sorted(found.pop(length, ())):
                # Parts may have been marked since: what is left free may still be a match.
                free = ~(used_p[a:a + length] | used_t[b:b + length])
                if free.all():
                    tiles.append((a, b, length))
                    used_p[a:a + length] = used_t[b:b + length] = True
                elif free.any():
                    edges = np.flatnonzero(np.diff(np.r_[0, free.astype(np.int8), 0])).tolist()
                    for x, y in zip(edges[::2], edges[1::2]):
                        if y - x >= search:
                            found[y - x].append((a + x, b + x))
            length -= 1
        if search > 2 * least:
            search //= 2
        elif search > least:
            search = least
        else:
            break
    return tiles


class SeedIndex:
    """Seeds, vocabulary and word ids of one block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, str | None]], least: int):
        self.least = least
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int | None, list[int]]] = []
        hashes, owners = [], []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if len(ids) < least:
                continue
            h = np.unique(window_hashes(np.array(ids, dtype=np.uint64), least))
            hashes.append(h)
            owners.append(np.full(len(h), len(self.items)))
            self.items.append((item_id, ids))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owners = (np.concatenate(owners) if owners else np.zeros(0, np.int64))[order]

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """(text number, item number, tiles) of every pair that shares a seed."""
        get = self.vocabulary.get
        ids, begins = [], []
        for t in texts:
            begins.append(len(ids))
            ids.extend([get(w, 0) for w in words_of(t)])
            ids.append(0)  # word 0 is outside the benchmark: no seed spans two texts
        if not len(self.hashes) or len(ids) < self.least:
            return
        flat = np.array(ids, dtype=np.uint64)
        h = window_hashes(flat, self.least)
        outside = np.r_[0, np.cumsum(flat == 0)]
        inside = np.flatnonzero(outside[self.least:][:len(h)] == outside[:len(h)])
        low = np.searchsorted(self.hashes, h[inside], side="left")
        high = np.searchsorted(self.hashes, h[inside], side="right")
        hits = inside[high > low]
        if not len(hits):
            return
        number = np.searchsorted(np.array(begins), hits, side="right") - 1
        low, high = low[high > low], high[high > low]
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for at, t, a, b in zip(hits.tolist(), number.tolist(), low.tolist(), high.tolist()):
            for owner in self.owners[a:b].tolist():
                places[t, owner].append(at)
        for (t, owner), at in places.items():
            # A tile consists of seeds, so the words that the shared seeds cover hold every tile.
            text, end = [], -1
            for p in at:
                if p > end >= 0:
                    text.append(0)
                text.extend(ids[max(p, end):p + self.least])
                end = p + self.least
            yield t, owner, greedy_tiles(self.items[owner][1], text, self.least)


_RESULT = ("doc_id long, text_hash long, item_id long, item_words long, n_tiles long, covered_words long, "
           "longest_tile long, coverage double")


def _tile(index):
    names = [x.split()[0] for x in _RESULT.split(", ")]
    types = [pa.float64() if x.endswith("double") else pa.int64() for x in _RESULT.split(", ")]
    schema = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = index.value

        for batch in small_batches(batches, "text", PART_CHARS):
            doc_ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            rows = []
            for t, owner, tiles in seeds.matches(batch.column("text").to_pylist()):
                item_id, ids = seeds.items[owner]
                covered = sum(x[2] for x in tiles)
                rows.append((doc_ids[t], hashes[t], item_id, len(ids), len(tiles), covered,
                             max((x[2] for x in tiles), default=0), covered / len(ids)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], schema=schema)

    return run


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per (document, benchmark item) that share a seed, with the tiling's figures."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), "text").dropDuplicates()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(chars) // block_chars))
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    if blocks == 1:
        index = SeedIndex([tuple(r) for r in items.collect()], least)
        return rows.mapInArrow(_tile(spark.sparkContext.broadcast(index)), _RESULT)
    # One block at a time: its pairs are written and its index let go before the next.
    items = written(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "benchmark-blocks")
    parts = []
    for b in range(blocks):
        index = spark.sparkContext.broadcast(SeedIndex(
            [tuple(r) for r in items.where(F.col("block") == b).select("item_id", "text").collect()], least))
        parts.append(written(rows.mapInArrow(_tile(index), _RESULT), "overlaps"))
        index.unpersist()
    return reduce(DataFrame.unionByName, parts)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
                       least: int = LEAST) -> DataFrame:
    """The overlaps whose tiles cover at least ``coverage`` of the item's words."""
    return overlaps(docs, benchmark, least).where(F.col("coverage") >= coverage)


def clean(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the documents named in ``found`` (doc_id, text_hash); all columns stay.

    The names are written first: with their size known, the planner need not
    shuffle the texts of all documents to drop a few.
    """
    bad = written(found.select("doc_id", "text_hash").distinct(), "contaminated")
    rows = whole_rows(docs)
    same = rows["row_id"].eqNullSafe(bad["doc_id"]) & (rows["row_hash"] == bad["text_hash"])
    return rows.join(bad, same, "left_anti").select("row.*")
