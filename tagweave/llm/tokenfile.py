"""Token ids in binary files of patched frame-of-reference blocks.

A file holds blocks of ``BLOCK`` ids (the last may be shorter), then a footer:

    block   = minimum u4 | exceptions u2 | width u1 | count u2 | packed low bits | positions u2[] | values u4[]
    footer  = block start bytes u8[] | document ids i8[] | id-is-null u1[] | ids per document u8[]
    trailer = blocks u8 | documents u8 | ids u8 | footer start u8 | magic

Each block subtracts its minimum and packs the differences at the width that
holds ``PERCENTILE`` of them; the outliers keep their low bits in place and
their whole difference in the exception list.  The footer's block starts let a
reader seek to any id.

``write_ids`` sorts documents by id over range partitions, their number taken
from the bytes of the texts; a partition closes a file at ``FILE_IDS`` ids, which
bounds the index that a writer or reader holds.  Every task attempt writes its own file name and only the manifest
rows of successful attempts (a Parquet table) name files, so a lost executor or
a second attempt leaves at most an unnamed file.  Starts are running sums over
the manifest, one row a file.

Defined results: null or empty texts hold the end id alone; a null ``doc_id``
sorts first and is kept as null; repeated ids are ordered by a hash of their
text; columns other than the id and the text are ignored; an empty table gives
an empty manifest and no files.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import shared_path, small_batches, written
from tagweave.llm.pretoken import split_numbered

BLOCK = 4096
PERCENTILE = 95
MAGIC = b"PFORIDS1"
HEAD = np.dtype([("low", "<u4"), ("exceptions", "<u2"), ("width", "u1"), ("count", "<u2")])
PART_CHARS = 2 << 20
KNOWN_WORDS = 1_000_000  # a worker's word cache starts anew beyond this number (about 200 MB)
WORDS_A_STRING = 100     # long strings cost the tokenizer more for each word
WORDS_AT_ONCE = 5000
RANGE_BYTES = 256 << 20  # text of one range partition, where there is more than the shuffle partitions hold
FILE_IDS = 1 << 26       # a file is closed after the document that reaches this number of ids


# --- blocks ----------------------------------------------------------------------------------


def _bits(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, packed."""
    planes = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(planes[:, :width], bitorder="little").tobytes()


def _unbits(raw: np.ndarray, n: int, width: int) -> np.ndarray:
    planes = np.zeros((n, 32), dtype=np.uint8)
    if width:
        planes[:, :width] = np.unpackbits(raw, bitorder="little")[:n * width].reshape(n, width)
    return np.packbits(planes, axis=1, bitorder="little").view("<u4").reshape(-1)


def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    diff = ids.astype(np.uint32) - np.uint32(low)
    typical = int(np.partition(diff, (len(diff) - 1) * PERCENTILE // 100)[(len(diff) - 1) * PERCENTILE // 100])
    width = typical.bit_length()
    out = np.flatnonzero(diff >> width) if width < 32 else np.zeros(0, np.int64)
    head = np.array([(low, len(out), width, len(diff))], dtype=HEAD)
    return b"".join([head.tobytes(), _bits(diff, width), out.astype("<u2").tobytes(), diff[out].astype("<u4").tobytes()])


def unpack_block(raw: bytes) -> np.ndarray:
    head = np.frombuffer(raw, dtype=HEAD, count=1)[0]
    n, width, out = int(head["count"]), int(head["width"]), int(head["exceptions"])
    at = HEAD.itemsize
    size = (n * width + 7) // 8
    diff = _unbits(np.frombuffer(raw, np.uint8, size, at), n, width)
    if out:
        where = np.frombuffer(raw, "<u2", out, at + size)
        diff[where] = np.frombuffer(raw, "<u4", out, at + size + 2 * out)
    return diff + head["low"]


class FileWriter:
    """Streams ids of whole documents into one file."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0
        self.pending = np.zeros(0, dtype=np.uint32)
        self.starts: list[int] = []
        self.doc_ids, self.counts, self.n = [], [], 0

    def _put(self, raw: bytes) -> None:
        self.stream.write(raw)
        self.at += len(raw)

    def _block(self, ids: np.ndarray) -> None:
        self.starts.append(self.at)
        self._put(pack_block(ids))

    def add(self, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.counts += counts.tolist()
        self.n += len(ids)
        ids = np.concatenate([self.pending, ids.astype(np.uint32)])
        whole = len(ids) // BLOCK * BLOCK
        for i in range(0, whole, BLOCK):
            self._block(ids[i:i + BLOCK])
        self.pending = ids[whole:].copy()

    def finish(self) -> None:
        if len(self.pending):
            self._block(self.pending)
        footer = self.at
        null = np.array([d is None for d in self.doc_ids], dtype=np.uint8)
        self._put(np.array(self.starts, dtype="<u8").tobytes())
        self._put(np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes())
        self._put(null.tobytes())
        self._put(np.array(self.counts, dtype="<u8").tobytes())
        self._put(np.array([len(self.starts), len(self.doc_ids), self.n, footer], dtype="<u8").tobytes() + MAGIC)


class FileReader:
    """Reads a file's index, then any range of its ids."""

    def __init__(self, stream, size: int):
        self.stream = stream
        tail = 32 + len(MAGIC)
        stream.seek(size - tail)
        raw = stream.read(tail)
        if raw[32:] != MAGIC:
            raise ValueError("not a token-id file")
        blocks, docs, self.n, footer = np.frombuffer(raw[:32], "<u8").tolist()
        stream.seek(footer)
        raw = stream.read(size - tail - footer)
        self.starts = np.r_[np.frombuffer(raw, "<u8", blocks), np.uint64(footer)].astype(np.int64)
        ids = np.frombuffer(raw, "<i8", docs, 8 * blocks)
        null = np.frombuffer(raw, np.uint8, docs, 8 * (blocks + docs))
        self.doc_ids = [None if x else i for i, x in zip(ids.tolist(), null.tolist())]
        self.counts = np.frombuffer(raw[8 * (blocks + docs) + docs:], "<u8", docs).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only their blocks are read."""
        if stop <= start:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        self.stream.seek(int(self.starts[first]))
        raw = self.stream.read(int(self.starts[last + 1] - self.starts[first]))
        at = self.starts[first:last + 2] - self.starts[first]
        parts = [unpack_block(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return np.concatenate(parts)[start - first * BLOCK:stop - first * BLOCK]


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


# --- encoding inside a task ------------------------------------------------------------------


class WordEncoder:
    """Ids of texts by a byte-level ``tokenizers`` tokenizer, each pre-token encoded once while it is cached."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.newline = self._one("\n")
        self._forget()

    def _forget(self) -> None:
        """Words have numbers; the ids of word i are flat[begin[i]:begin[i] + size[i]]."""
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.begin, self.size = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def _one(self, text: str) -> list[int]:
        return self._each([text])[0].ids

    def _each(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)  # without offsets

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, k = len(self.known), len(words)
        while n + k > len(self.begin):
            self.begin, self.size = (np.r_[x, np.zeros_like(x)] for x in (self.begin, self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        self.flat[self.used:self.used + len(ids)] = ids
        self.begin[n:n + k] = self.used + np.cumsum(sizes) - sizes
        self.size[n:n + k] = sizes
        self.known.update(zip(words, range(n, n + k)))
        self.used += len(ids)

    def _learn(self, words: list[bytes]) -> None:
        # A line break behind each word keeps them apart, so many are encoded in one string.
        plain, texts, rest = [], [], []
        for w in words:
            text = w.decode("utf-8", "surrogatepass")
            if b"\n" in w or text.isspace() or len(self.newline) != 1:
                rest.append(w)
            else:
                plain.append(w)
                texts.append(text)
        for i in range(0, len(plain), WORDS_AT_ONCE):
            some, lines = plain[i:i + WORDS_AT_ONCE], texts[i:i + WORDS_AT_ONCE]
            strings = ["\n".join(lines[k:k + WORDS_A_STRING]) + "\n" for k in range(0, len(lines), WORDS_A_STRING)]
            ids = np.array([x for e in self._each(strings) for x in e.ids], dtype=np.uint32)
            breaks = ids == self.newline[0]
            cuts = np.flatnonzero(breaks)
            if len(cuts) == len(some):
                self._add(some, ids[~breaks], np.diff(cuts, prepend=-1) - 1)
            else:
                rest += some
        for w in rest:
            ids = np.array(self._one(w.decode("utf-8", "surrogatepass")), dtype=np.uint32)
            self._add([w], ids, np.array([len(ids)]))

    def encode(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts (each closed by ``end_id``) and the number of ids of each."""
        words, seq, counts = split_numbered(texts)
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        self._learn([w for w in words if w not in self.known])
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        place = np.int32 if self.used < 1 << 31 else np.int64
        begin, lengths = self.begin[at].astype(place)[seq], self.size[at].astype(place)[seq]
        total = np.zeros(len(seq) + 1, dtype=np.int64)
        np.cumsum(lengths, out=total[1:])
        if total[-1] >= 1 << 31:
            place = np.int64
        begin = begin - total[:-1].astype(place)
        ids = self.flat[np.repeat(begin, lengths) + np.arange(int(total[-1]), dtype=place)]
        ends = total[np.cumsum(counts)]
        counts = np.diff(np.r_[0, ends])
        if end_id is None:
            return ids, counts
        return np.insert(ids, ends, end_id), counts + 1


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One per worker process, so that its cache outlives a task."""
    return WordEncoder(path)


# --- Spark jobs ------------------------------------------------------------------------------

_MANIFEST = "part int, file int, path string, n_docs long, n_ids long, n_bytes long"
_MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                             ("n_ids", pa.int64()), ("n_bytes", pa.int64())])


def _write(folder: str, tokenizer_path: str, end_id: int | None, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, file = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], 0
        writer = stream = None

        def closed() -> pa.RecordBatch:
            writer.finish()
            stream.close()
            row = {"part": part, "file": file, "path": path, "n_docs": len(writer.doc_ids), "n_ids": writer.n,
                   "n_bytes": writer.at}
            return pa.RecordBatch.from_pylist([row], schema=_MANIFEST_ARROW)

        for batch in small_batches(batches, "text", PART_CHARS):
            if writer is None:
                path = f"{folder}/part-{part:06d}-{attempt}-{file:04d}.pfor"
                files, where = _open(path)
                files.create_dir(where.rsplit("/", 1)[0], recursive=True)
                stream = files.open_output_stream(where)
                writer = FileWriter(stream)
            ids, counts = _encoder(tokenizer_path).encode([t or "" for t in batch.column("text").to_pylist()], end_id)
            writer.add(batch.column("doc_id").to_pylist(), counts, ids)
            if writer.n >= file_ids:
                yield closed()
                writer, file = None, file + 1
        if writer is not None:
            yield closed()

    return run


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int | None = None, folder: str | None = None,
              range_bytes: int = RANGE_BYTES, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files in ascending id order; returns the manifest, one row a file.

    ``start`` is the number of ids in all files before.  The ranges follow from the
    bytes of the texts, so that a task's share does not grow with the table.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "token-files")
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // range_bytes))
    ordered = rows.repartitionByRange(ranges, "doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    manifest = written(ordered.select("doc_id", "text").mapInArrow(
        _write(folder, tokenizer_path, end_id, file_ids), _MANIFEST), "token-manifest")
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(packed: bool):
    id_type = pa.binary() if packed else pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", id_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, where = _open(row["path"])
                with files.open_input_file(where) as stream:
                    reader = FileReader(stream, row["n_bytes"])
                    ends = np.cumsum(reader.counts)
                    i = 0
                    while i < len(ends):
                        base = int(ends[i - 1]) if i else 0
                        j = max(i + 1, int(np.searchsorted(ends, base + (1 << 20), side="right")))
                        ids = reader.ids(base, int(ends[j - 1]))
                        cuts = np.r_[0, ends[i:j] - base]
                        parts = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(reader.doc_ids[i:j], pa.int64()),
                            pa.array(row["start"] + base + cuts[:-1], pa.int64()), pa.array(np.diff(cuts), pa.int64()),
                            pa.array([p.astype("<u4").tobytes() if packed else p.astype(np.int64) for p in parts], id_type),
                        ], schema=schema)
                        i = j

    return run


def read_ids(manifest: DataFrame, packed: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the manifest's files.

    ``ids`` is array<long>, or little-endian unsigned 32-bit integers when ``packed``.
    """
    kind = "binary" if packed else "array<long>"
    files = max(1, manifest.select("path").count())  # a task for each file
    tasks = manifest.select("path", "start", "n_bytes").repartition(files)
    return tasks.mapInArrow(_read(packed), f"doc_id long, start long, n_tokens long, ids {kind}")
