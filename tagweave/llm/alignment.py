"""Aligning two tokenizers of the same texts by the bytes that their tokens share.

Tokenizer A is a byte-level ``tokenizers`` file, B a ``sentencepiece`` model with
byte fallback; both cover the bytes of a blank and the text.  A token is a row of
an incidence matrix in compressed sparse row form (CSR): a one in the column of
every byte it covers.  The product of A's matrix with the transpose of B's, built
row by row (Gustavson), holds for every pair of tokens the bytes they share: its
non-zero entries are the overlap links.  Bytes where tokens of both end cut the
tokens into groups; products of the group incidences give the links of tokens
that share a group.

Neither vocabulary has a token with a blank behind another sign, so both encode
the stretches between such places ("units", mostly a word with its blank)
separately, and both always end a token there.  A worker aligns each distinct
unit once and remembers it; a text is its sequence of units.

The links of an id pair are counted over all texts:

1. Texts are read once, in chunks of ``CHUNK_CHARS``.  A chunk keeps its texts as
   a packed sequence of unit numbers, the pairs of each unit, and its distinct
   pairs with their counts.
2. Distinct pairs are summed over chunks (combined per task before the shuffle);
   the highest count of each B id follows from the sums.
3. The sums are joined back to the chunks' pairs - a pair occurs at most once a
   chunk, so no key is hot - and a chunk's texts add up those of their links.

No text, and no link of a single text, is ever shuffled.

Defined results: a null or empty text, and one whose joined token bytes differ
from the blank and the text (it holds the mark by which B writes a blank), has no
tokens: zeros and an empty ``groups_sha256``; repeated rows count as often as they
occur; a null id passes through; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.bpe import _narrow, _pack, _unpack
from tagweave.llm.common import small_batches, written
from tagweave.llm.pretoken import SPACE, _classes, code_points, numbered
from tagweave.llm.tokenfile import WordEncoder
from tagweave.llm.vocabulary import BLANK_MARK, Table, byte_level_tokens, piece_tokens

CHUNK_CHARS = 8 << 20
PART_CHARS = 1 << 20
KNOWN_UNITS = 300_000  # a worker's memory of aligned units starts anew beyond this number (about 120 MB)
EXPANSION = 1 << 22    # products formed at once


# --- sparse matrices -------------------------------------------------------------------------


@dataclass(frozen=True)
class CSR:
    """A sparse matrix: row i has ``values`` in the columns ``columns``, from ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def transposed(self) -> CSR:
        order = np.argsort(self.columns, kind="stable")
        rows = np.repeat(np.arange(self.height), np.diff(self.starts))
        starts = np.r_[0, np.cumsum(np.bincount(self.columns, minlength=self.width))]
        return CSR(starts, rows[order], self.values[order], self.height)

    def rows(self, first: int, last: int) -> CSR:
        a, b = self.starts[first], self.starts[last]
        return CSR(self.starts[first:last + 1] - a, self.columns[a:b], self.values[a:b], self.width)


def incidence(ends: np.ndarray, n_bytes: int) -> CSR:
    """Tokens by bytes: token i covers the bytes from the end of the token before to its own."""
    return CSR(np.r_[0, ends].astype(np.int64), np.arange(n_bytes), np.ones(n_bytes, dtype=np.int64), n_bytes)


def membership(groups: np.ndarray, n_groups: int) -> CSR:
    """Tokens by groups: one entry a token."""
    return CSR(np.arange(len(groups) + 1), groups, np.ones(len(groups), dtype=np.int64), n_groups)


def product(a: CSR, b: CSR) -> CSR:
    """a . b by rows: the rows of ``b`` that a row of ``a`` selects are laid out, and equal columns summed."""
    sizes = (b.starts[1:] - b.starts[:-1])[a.columns]
    cost = np.r_[0, np.cumsum(sizes)][a.starts]  # of all rows before
    keys, values, row = [], [], 0
    while row < a.height:  # as many rows at once as stay within EXPANSION
        last = max(row + 1, int(np.searchsorted(cost, cost[row] + EXPANSION, side="right")) - 1)
        part = a.rows(row, last)
        n = sizes[a.starts[row]:a.starts[last]]
        at = np.repeat(b.starts[part.columns] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        of = np.repeat(np.repeat(np.arange(row, last), np.diff(part.starts)), n)
        key = of * b.width + b.columns[at]
        value = np.repeat(part.values, n) * b.values[at]
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        keys.append(key[heads])
        values.append(np.add.reduceat(value, heads) if len(heads) else value)
        row = last
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    starts = np.searchsorted(key, np.arange(a.height + 1) * b.width)
    return CSR(starts, key % max(1, b.width), np.concatenate(values) if values else key, b.width)


@dataclass(frozen=True)
class Alignment:
    """Tokens of A and B over the same bytes: their groups, and the links by overlap."""

    group_a: np.ndarray   # group of each token
    group_b: np.ndarray
    n_groups: int
    link_a: np.ndarray    # token numbers of each overlap link, in order
    link_b: np.ndarray
    shared_bytes: np.ndarray

    def in_group(self) -> CSR:
        """Links of A and B tokens that share a group: the product of the group incidences."""
        return product(membership(self.group_a, self.n_groups), membership(self.group_b, self.n_groups).transposed())

    def in_group_counts(self) -> np.ndarray:
        """Number of shared-group links of each group, without listing them (row sums times column sums)."""
        return np.bincount(self.group_a, minlength=self.n_groups) * np.bincount(self.group_b, minlength=self.n_groups)


def align_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Alignment of two divisions of the same bytes, given by where their tokens end."""
    n = int(ends_a[-1]) if len(ends_a) else 0
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    links = product(incidence(ends_a, n), incidence(ends_b, n).transposed())
    return Alignment(np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), len(cuts),
                     np.repeat(np.arange(links.height), np.diff(links.starts)), links.columns, links.values)


# --- units -----------------------------------------------------------------------------------


def unit_starts(text: str, text_starts: np.ndarray) -> np.ndarray:
    """Where units start: at each text, and at each blank behind a sign that is no white space."""
    cp = code_points(text)
    cut = np.zeros(len(cp), dtype=bool)
    cut[1:] = (cp[1:] == 32) & (_classes(cp[:-1]) != SPACE)
    cut[text_starts] = True
    return np.flatnonzero(cut)


class _Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.data, self.n = np.zeros(1 << 14, dtype=dtype), 0

    def add(self, more: np.ndarray) -> None:
        while self.n + len(more) > len(self.data):
            self.data = np.r_[self.data, np.zeros_like(self.data)]
        self.data[self.n:self.n + len(more)] = more
        self.n += len(more)


FIELDS = ["ok", "n_a", "n_b", "n_groups", "n_links", "n_shared"]


class Aligner:
    """Aligned units of a worker process."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = WordEncoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.blank = self.b.piece_to_id(BLANK_MARK)
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if BLANK_MARK in piece.lstrip(BLANK_MARK):
                raise ValueError(f"piece {i} has a blank behind another sign: texts cannot be cut there")
        self.table_a, self.table_b = Table(byte_level_tokens(self.a.tokenizer)), Table(piece_tokens(self.b))
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.fields = {f: _Grown(np.int64) for f in FIELDS}
        self.link_a, self.link_b = _Grown(np.int32), _Grown(np.int32)

    def numbers(self, units: list[bytes]) -> np.ndarray:
        """The number of each unit; new ones are aligned."""
        if len(self.known) > KNOWN_UNITS:
            self.forget()
        new = [u for u in units if u not in self.known]
        if new:
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))

    def _learn(self, units: list[bytes]) -> None:
        texts = [u.decode() for u in units]
        a, count_a = self.a.encode(texts)
        a = a.astype(np.int64)
        listed = [ids if len(u) > 1 else [self.blank] for u, ids in zip(units, self.b.encode([t[1:] for t in texts], num_threads=1))]
        count_b = np.array([len(x) for x in listed], dtype=np.int64)
        b = np.fromiter((i for x in listed for i in x), np.int64, int(count_b.sum()))
        size = np.array([len(u) for u in units], dtype=np.int64)
        raw = np.frombuffer(b"".join(units), dtype=np.uint8)
        ok = self._equal(self.table_a, a, count_a, raw, size) & self._equal(self.table_b, b, count_b, raw, size)
        a, b = a[np.repeat(ok, count_a)], b[np.repeat(ok, count_b)]
        count_a, count_b = np.where(ok, count_a, 0), np.where(ok, count_b, 0)
        found = align_tokens(np.cumsum(self.table_a.size[a]), np.cumsum(self.table_b.size[b]))

        unit_a = np.repeat(np.arange(len(units)), count_a)
        group_unit = np.zeros(found.n_groups, dtype=np.int64)
        group_unit[found.group_a] = unit_a
        link_unit = unit_a[found.link_a]
        per = {"ok": ok, "n_a": count_a, "n_b": count_b, "n_groups": np.bincount(group_unit, minlength=len(units)),
               "n_links": np.bincount(link_unit, minlength=len(units)),
               "n_shared": np.bincount(group_unit, weights=found.in_group_counts(), minlength=len(units)).astype(np.int64)}
        for f in FIELDS:
            self.fields[f].add(per[f])
        self.link_a.add(a[found.link_a])
        self.link_b.add(b[found.link_b])
        self.groups += self._written(a, b, found, np.bincount(group_unit, minlength=len(units)))
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units))))

    @staticmethod
    def _equal(table: Table, ids, counts, raw, size) -> np.ndarray:
        """Which units' joined token bytes are the unit's."""
        of = np.repeat(np.arange(len(counts)), counts)
        length = np.bincount(of, weights=table.size[ids], minlength=len(counts)).astype(np.int64)
        same = length == size
        joined = table.bytes_of(ids[np.repeat(same, counts)])
        differs = joined != raw[np.repeat(same, size)]
        owner = np.repeat(np.flatnonzero(same), size[same])
        return same & (np.bincount(owner, weights=differs, minlength=len(counts)) == 0)

    @staticmethod
    def _written(a, b, found: Alignment, groups_of_unit: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each unit."""
        def members(ids, group):
            cuts = np.searchsorted(group, np.arange(found.n_groups + 1)).tolist()
            text = list(map(str, ids.tolist()))
            return [text[x] if y == x + 1 else ",".join(text[x:y]) for x, y in zip(cuts, cuts[1:])]

        groups = [f"{x}|{y}" for x, y in zip(members(a, found.group_a), members(b, found.group_b))]
        cuts = np.r_[0, np.cumsum(groups_of_unit)].tolist()
        return [groups[x] if y == x + 1 else ";".join(groups[x:y]) for x, y in zip(cuts, cuts[1:])]


@functools.lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process: aligned units outlive a task."""
    return Aligner(a_path, b_path)


@dataclass(frozen=True)
class Part:
    """Some texts as sequences of the aligner's units; texts without tokens have no units."""

    doc_ids: list
    seq: np.ndarray
    counts: np.ndarray
    stats: np.ndarray     # per text, the sums of FIELDS[1:]
    groups: list


def _part(aligner: Aligner, doc_ids: list, texts: list, digest: bool) -> Part:
    kept = [" " + t if t else "" for t in texts]
    lengths = np.array([len(t) for t in kept], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    text = "".join(kept)
    starts = unit_starts(text, begins[lengths > 0])
    units, seq = numbered(text, starts)
    counts = np.diff(np.r_[np.searchsorted(starts, begins), len(starts)])
    counts[lengths == 0] = 0
    seq = aligner.numbers(units)[seq] if len(units) else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(kept)), counts)
    whole = np.bincount(of, weights=1 - aligner.fields["ok"].data[seq], minlength=len(kept)) == 0
    seq, of, counts = seq[whole[of]], of[whole[of]], np.where(whole, counts, 0)
    stats = np.stack([np.bincount(of, weights=aligner.fields[f].data[seq], minlength=len(kept)).astype(np.int64)
                      for f in FIELDS[1:]])
    known, groups, at = aligner.groups, [], 0
    for n in counts.tolist():
        listed = ";".join(map(known.__getitem__, seq[at:at + n].tolist()))
        groups.append(hashlib.sha256(listed.encode()).hexdigest() if digest and n else listed)
        at += n
    return Part(doc_ids, seq, counts, stats, groups)


_STATS = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
_GROUPS = "doc_id long, " + ", ".join(f"{s} long" for s in _STATS) + ", groups string"


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_shared, groups) of every row: the alignment itself, as text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", PART_CHARS):
            part = _part(_aligner(a_path, b_path), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), False)
            yield pa.RecordBatch.from_arrays([pa.array(part.doc_ids, pa.int64()), *map(pa.array, part.stats), pa.array(part.groups, pa.string())],
                                             names=["doc_id", *_STATS, "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _GROUPS)


# --- corpus counts ---------------------------------------------------------------------------

_CHUNK = ("chunk long, a array<int>, b array<int>, m array<long>, payload binary, doc_ids array<long>, counts array<long>, "
          + ", ".join(f"{s} array<long>" for s in _STATS) + ", groups array<string>")


def _chunks(a_path: str, b_path: str, chunk_chars: int):
    def row(chunk: int, parts: list[Part], aligner: Aligner) -> pa.RecordBatch:
        seq = np.concatenate([p.seq for p in parts])
        times = np.bincount(seq, minlength=1)
        used = np.flatnonzero(times)
        used = used[np.argsort(-times[used], kind="stable")]  # frequent units get small numbers, which pack well
        number = np.zeros(len(times), dtype=np.int64)
        number[used] = np.arange(len(used))
        n_links = aligner.fields["n_links"].data[:len(aligner.known)]
        begin = np.cumsum(n_links) - n_links
        n = n_links[used]
        at = np.repeat(begin[used] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        a, b = aligner.link_a.data[at].astype(np.int64), aligner.link_b.data[at].astype(np.int64)
        pairs, which = np.unique((a << 32) | b, return_inverse=True)
        m = np.bincount(which, weights=np.repeat(times[used], n), minlength=len(pairs)).astype(np.int64)
        by = np.argsort(-m, kind="stable")
        rank = np.empty(len(by), dtype=np.int64)
        rank[by] = np.arange(len(by))
        pairs, m = pairs[by], m[by]
        payload = _pack(_narrow(number[seq]), _narrow(n), _narrow(rank[which]))
        stats = np.concatenate([p.stats for p in parts], axis=1)
        values = [chunk, (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), m, payload,
                  [d for p in parts for d in p.doc_ids], np.concatenate([p.counts for p in parts]), *stats,
                  [g for p in parts for g in p.groups]]
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.list_(pa.int64())] * len(stats), pa.list_(pa.string())]
        names = [c.split()[0] for c in _CHUNK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, ordinal, chars, parts = TaskContext.get().partitionId() << 32, 0, 0, []
        for batch in small_batches(batches, "text", PART_CHARS):
            aligner, texts = _aligner(a_path, b_path), batch.column("text").to_pylist()
            if parts and len(aligner.known) > KNOWN_UNITS:  # unit numbers hold until the aligner starts anew
                yield row(base + ordinal, parts, aligner)
                parts, chars, ordinal = [], 0, ordinal + 1
            parts.append(_part(aligner, batch.column("doc_id").to_pylist(), texts, True))
            chars += sum(len(t) for t in texts if t)
            if chars >= chunk_chars:
                yield row(base + ordinal, parts, aligner)
                parts, chars, ordinal = [], 0, ordinal + 1
        if parts:
            yield row(base + ordinal, parts, _aligner(a_path, b_path))

    return run


def align(docs: DataFrame, a_path: str, b_path: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Aligned chunks of ``docs`` (doc_id, text), written to the shared folder: the input of the functions below."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(rows.mapInArrow(_chunks(a_path, b_path, chunk_chars), _CHUNK), "aligned")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a_id, b_id, links, best): how many links of all texts join the ids, and whether no other A id has more with that B id."""
    pairs = chunks.select(F.explode(F.arrays_zip("a", "b", "m")).alias("p"))
    sums = written(pairs.groupBy(F.col("p.a").alias("a_id"), F.col("p.b").alias("b_id")).agg(F.sum("p.m").alias("links")), "pair-links")
    top = sums.groupBy(F.col("b_id").alias("__b")).agg(F.max("links").alias("__top"))  # at most one row for each id of B
    return sums.join(F.broadcast(top), F.col("b_id") == F.col("__b")).select(
        "a_id", "b_id", "links", (F.col("links") == F.col("__top")).alias("best"))


_SCORED = "doc_id long, " + ", ".join(f"{s} long" for s in _STATS) + ", n_best long, count_sum long, groups_sha256 string"


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _SCORED.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):  # one chunk at a time
            def values(name):
                return batch.column(name)[i].values

            counts = values("counts").to_numpy(zero_copy_only=False)
            seq, n, which = (x.astype(np.int64) for x in _unpack(batch.column("payload")[i].as_py()))
            known = batch.column("found")[i].values
            links, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if known is not None:
                at = known.field("i").to_numpy(zero_copy_only=False)
                links, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                links[at] = known.field("links").to_numpy(zero_copy_only=False)
                best[at] = known.field("best").to_numpy(zero_copy_only=False)
            of, texts = np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(counts)), counts)
            out = []
            for per_pair in (best, links):
                per_unit = np.zeros(len(n), np.int64)
                np.add.at(per_unit, of, per_pair[which])
                per_text = np.zeros(len(counts), np.int64)
                np.add.at(per_text, texts, per_unit[seq])
                out.append(pa.array(per_text))
            yield pa.RecordBatch.from_arrays([values("doc_ids"), *map(values, _STATS), *out, values("groups")], names=names)


def scores(chunks: DataFrame, counts: DataFrame) -> DataFrame:
    """Per text: tokens, groups, links, links whose pair is the best of its B id, the sum of the links' counts, groups digest."""
    pairs = chunks.select("chunk", F.posexplode(F.arrays_zip("a", "b")).alias("i", "p")).select(
        "chunk", "i", F.col("p.a").alias("a_id"), F.col("p.b").alias("b_id"))
    found = pairs.join(counts, ["a_id", "b_id"]).groupBy("chunk").agg(  # as many as the chunk's distinct pairs
        F.collect_list(F.struct("i", "links", "best")).alias("found"))
    rows = chunks.select("chunk", "payload", "doc_ids", "counts", *_STATS, "groups").join(found, "chunk", "left")
    return rows.drop("chunk").mapInArrow(_add_up, _SCORED)
