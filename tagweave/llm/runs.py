"""Periodic runs of words: maximal stretches that repeat with some period, and texts without their repeats.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) whose length is at least ``min_length`` and ``2 * q``, and that no
neighbouring word extends with that period.

Each text is searched whole by the branching-tandem test on an enhanced suffix
array (suffix array, its inverse and longest common prefixes; no tree):

1. Word numbers are sorted by prefix doubling.  Only groups that still tie are
   sorted again, and the ranks of every doubling are kept: two blocks of 2^k
   words are equal if their ranks of level k are.
2. Every interval of equal prefixes of depth d has children, cut where the
   common prefix is exactly d.  For each suffix i outside the largest child, a
   look-up of ISA[i + d] and ISA[i - d] in the interval finds the squares of
   period d that end in a mismatch: n log n look-ups in all.
3. Rotating such a square to the left, by blocks of 2^k words whose ranks agree,
   gives the run's start; its end is the mismatch.  Equal stretches are merged
   into one run with the smallest period.

A run of a short period q also has squares of the multiples of q, so intervals
shallower than :func:`least_depth` are left out and the short periods are
recovered from the runs found.

Texts never leave their row: the job is one scan without a shuffle, and a task
holds ``PART_CHARS`` of text at a time, or one longer text.

Defined results: null, empty and blank texts have no words and no runs, and
collapse to the empty text; repeated rows each get the same result; the id
passes through, null included; columns other than the id and the text are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import small_batches

WORD = r"[^\x20\x09-\x0D]+"
MIN_LENGTH = 12
PART_CHARS = 1 << 20
CHECKS = 1 << 20  # interval members looked up at once
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def least_depth(min_length: int) -> int:
    """The greatest depth D such that every period below D has a multiple in D .. min_length / 2.

    Runs of those periods then contain squares of a multiple, found at depth D or deeper.
    """
    half = max(1, min_length // 2)
    return max(d for d in range(1, half + 1) if all(-(-d // q) * q <= half for q in range(1, d)))


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words (UTF-8) of all texts, the number of the word at each place, words of each text."""
    column = pc.fill_null(column, "")
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * column.offset) if n else np.zeros(1, np.int64)
    raw = column.buffers()[2] if n else None
    data = np.frombuffer(raw, dtype=np.uint8)[ends[0]:ends[-1]] if raw is not None else np.zeros(0, np.uint8)
    begins = (ends - ends[0])[:-1]
    solid = ~_GAP[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = begins[begins < len(data)]
    first[inner] = solid[inner]
    at = np.flatnonzero(first)
    packed = data[solid]
    starts = np.r_[np.flatnonzero(first[solid]), len(packed)].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(starts), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    counts = np.diff(np.searchsorted(at, np.r_[begins, len(data)]))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


class SuffixArray:
    """Suffixes of several word sequences laid end to end; suffixes of different sequences share no prefix."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        n = len(codes)
        doc = np.repeat(np.arange(len(counts)), counts)
        ends = np.cumsum(counts)
        self.first, self.end = (ends - counts)[doc], ends[doc]   # of the sequence that holds a place
        self.word = np.r_[codes + 1, 0]                            # 0: behind the end
        width = int(codes.max()) + 2 if n else 1
        place = np.arange(n)
        key = (doc * width + self.word[:n]) * width + np.where(place + 1 < self.end, self.word[1:], 0)
        order = np.argsort(key, kind="stable")
        self.levels = [self.word[:n].astype(np.int32)]
        rank = np.empty(n, dtype=np.int32)
        heads = self._heads(key[order])
        rank[order] = np.maximum.accumulate(np.where(heads, place, 0))
        active = np.flatnonzero(~self._alone(heads))               # slots of the array that still tie
        h = 2
        while len(active):
            self.levels.append(rank.copy())
            at = order[active]
            behind = at + h
            later = np.where(behind < self.end[at], rank[np.minimum(behind, n - 1)].astype(np.int64) + 1, 0)
            key = (rank[at].astype(np.int64) << 32) | later
            again = np.argsort(key, kind="stable")
            at = at[again]
            order[active] = at
            heads = self._heads(key[again])
            rank[at] = active[np.maximum.accumulate(np.where(heads, np.arange(len(at)), 0))]
            active = active[~self._alone(heads)]
            h *= 2
        self.order, self.place = order, rank                       # the array and its inverse

    @staticmethod
    def _heads(key: np.ndarray) -> np.ndarray:
        heads = np.ones(len(key), dtype=bool)
        heads[1:] = key[1:] != key[:-1]
        return heads

    @staticmethod
    def _alone(heads: np.ndarray) -> np.ndarray:
        return heads & np.r_[heads[1:], np.ones(min(1, len(heads)), dtype=bool)]

    def word_at(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.word[np.where(at < end, at, len(self.word) - 1)]

    def prefixes(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Slots whose suffix shares at least ``depth`` words with the suffix one slot before, and how many."""
        level = min(depth.bit_length() - 1, len(self.levels) - 1)
        known = self.levels[level][self.order]
        slots = np.flatnonzero(known[1:] == known[:-1]) + 1
        a, b = self.order[slots - 1], self.order[slots]
        same = self.first[a] == self.first[b]                      # level 0 compares words of all sequences
        slots, a, b = slots[same], a[same], b[same]
        shared = np.zeros(len(slots), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + shared, b + shared
            inside = (x < self.end[a]) & (y < self.end[b])
            rank = self.levels[k]
            equal = inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 0)])
            shared += equal.astype(np.int64) << k
        deep = shared >= depth
        return slots[deep], shared[deep]

    def rotated(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How far left of ``at`` words still equal those ``period`` later: the leftmost such place."""
        first = self.first[at]
        for k in range(len(self.levels) - 1, -1, -1):
            left = at - (1 << k)
            rank, inside = self.levels[k], left >= first
            left = np.where(inside, left, at)
            at = np.where(inside & (rank[left] == rank[left + period]), left, at)
        return at


def _intervals(slots: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """Prefix intervals as (first slot, last slot, depth), and for each of ``slots`` the interval it cuts into children."""
    lows, highs, depths, owner = [], [], [], []
    open_: list[int] = []  # numbers of the intervals that hold the current slot, by growing depth
    before = -2
    for slot, depth in zip(slots.tolist(), shared.tolist()):
        low = slot - 1
        if slot != before + 1:
            for i in open_:
                highs[i] = before
            open_ = []
        while open_ and depths[open_[-1]] > depth:
            i = open_.pop()
            highs[i], low = slot - 1, lows[i]
        if not open_ or depths[open_[-1]] < depth:
            open_.append(len(lows))
            lows.append(low)
            highs.append(-1)
            depths.append(depth)
        owner.append(open_[-1])
        before = slot
    for i in open_:
        highs[i] = before
    return tuple(np.array(x, dtype=np.int64) for x in (lows, highs, depths, owner))


def _smaller_children(slots, low, high, owner) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first slot, slots, interval) of every child but the largest of each interval."""
    by = np.argsort(owner, kind="stable")  # an interval's cuts, in the order of slots
    cut, of = slots[by], owner[by]
    n = len(low)
    starts = np.concatenate([low, cut])
    of = np.concatenate([np.arange(n), of])
    by = np.lexsort((starts, of))
    starts, of = starts[by], of[by]
    last = np.r_[of[1:] != of[:-1], True]
    size = np.where(last, high[of] + 1, np.r_[starts[1:], 0]) - starts
    heads = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    # The first of the largest children of each interval is left out.
    by = np.lexsort((np.arange(len(of)), -size, of))
    keep = np.ones(len(of), dtype=bool)
    keep[by[heads]] = False
    return starts[keep], size[keep], of[keep]


def find_runs(codes: np.ndarray, counts: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, end, period) of all runs of the sequences laid end to end, sorted; places count over all."""
    none = np.zeros((0, 3), dtype=np.int64)
    if len(codes) < min_length:
        return none
    text = SuffixArray(codes, counts)
    depth = least_depth(min_length)
    slots, shared = text.prefixes(depth)
    if not len(slots):
        return none
    low, high, depths, owner = _intervals(slots, shared)
    starts, sizes, of = _smaller_children(slots, low, high, owner)
    found, total = [], np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + CHECKS, side="right")))
        size = sizes[begin:stop]
        which = np.repeat(of[begin:stop], size)
        slot = np.repeat(starts[begin:stop] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        i, d = text.order[slot], depths[which]
        first, end = text.first[i], text.end[i]
        for at, other in ((i, i + d), (i - d, i - d)):
            inside = (other >= first) & (other < end)
            rank = text.place[np.where(inside, other, 0)]
            inside &= (rank >= low[which]) & (rank <= high[which])
            a, p, e = at[inside], d[inside], end[inside]
            branching = text.word_at(a + p, e) != text.word_at(a + 2 * p, e)
            found.append(np.stack([a[branching], p[branching]], axis=1))
        begin = stop
    square = np.unique(np.concatenate(found), axis=0)
    start = text.rotated(square[:, 0], square[:, 1])
    run = np.stack([start, square[:, 0] + 2 * square[:, 1], square[:, 1]], axis=1)
    run = run[run[:, 1] - run[:, 0] >= min_length]
    run = run[np.lexsort((run[:, 2], run[:, 1], run[:, 0]))]
    run = run[np.r_[True, (run[1:, :2] != run[:-1, :2]).any(axis=1)]] if len(run) else run
    for p in range(depth, min_length // 2 + 1):  # the only periods found for runs whose smallest is below ``depth``
        rows = np.flatnonzero(run[:, 2] == p)
        for q in (x for x in range(1, depth) if p % x == 0):
            at = run[rows, 0][:, None] + np.arange(p - q)[None, :]
            short = (text.word[at] == text.word[at + q]).all(axis=1)
            run[rows[short], 2] = q
            rows = rows[~short]
    return run[np.lexsort((run[:, 2], run[:, 0]))]


def repeats(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words lie in some run after its first period."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 1], -1)
    return np.cumsum(step)[:n] > 0


_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _search(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", PART_CHARS):
            words, codes, counts = words_of(batch.column("text"))
            runs = find_runs(codes, counts, min_length)
            begins = np.r_[0, np.cumsum(counts)]
            owner = np.searchsorted(begins[1:], runs[:, 0], side="right")
            listed = pa.StructArray.from_arrays([pa.array(runs[:, 0] - begins[owner]), pa.array(runs[:, 1] - runs[:, 0]),
                                                 pa.array(runs[:, 2])], fields=list(_RUN))
            of_doc = np.searchsorted(owner, np.arange(len(counts) + 1)).astype(np.int32)
            kept = ~repeats(runs, len(codes))
            cuts = np.r_[0, np.cumsum(kept)][begins]
            texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), words.take(pa.array(codes[kept]))),
                                   pa.scalar(b" ", pa.large_binary()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(of_doc), listed),
                                              texts.cast(pa.large_string()).cast(pa.string())],
                                             names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs``.

    ``runs`` is sorted by start, then period; ``collapsed`` holds the words that
    are not the second or a later period of any run, joined by one space.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_search(min_length), _SCHEMA)


def longest(runs: Column) -> Column:
    """The run of greatest length as (length, -start, -period); ties: smallest start, then period; null without runs."""
    return F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the ids, the words from a place on repeat the words there with some period.

    With h the crc32 of the decimal id and g = h / 10: where h mod 10 is 0, each
    word from a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) / (3 + g mod 8).
    Used to measure recall on real texts; other texts stay as they are.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    planted = F.expr("""
        array_join(concat(slice(words, 1, cast(a as int)), transform(sequence(a, n - 1), i -> words[cast(a + (i - a) % p as int)])), ' ')""")
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("words", F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    rows = rows.withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    return rows.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), planted).otherwise(F.col("text")).alias("text"))
