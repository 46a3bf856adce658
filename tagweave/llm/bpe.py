"""Byte-level BPE encoding and decoding with a global distinct-word shuffle.

Encoding (``encode``):

1. every task splits its texts into pre-tokens, a chunk of texts at a time, and
   writes for each chunk the sequence of pre-token positions (indices into the
   chunk's own list of distinct words) and that list, cut into hash buckets;
   this is the exploded (word, position) table, packed, written once to the
   shared folder;
2. the word lists are shuffled by bucket, so equal words of all chunks meet in
   one task and each distinct word is encoded once;
3. the ids go back to their chunks in a second shuffle and are laid out by
   position.  The sequences, the largest part, stay where they are: their table
   is bucketed by chunk, so the join reads it without another shuffle.

A word occurs at most once per chunk in the shuffle however frequent it is, so a
word that makes up a third of all text is no hot key.  Memory per task is one
chunk (or one text, if longer) plus the distinct words of one bucket.

Decoding (``decode``) joins the token-byte table, whose size the vocabulary
bounds, map-side.

Defined results: a null or empty text has no ids (an empty list) and decodes to
no bytes; repeated rows and null ids each keep their own row; columns other
than the id and the text are ignored; an id outside the table is an error.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import shared_path, small_batches
from tagweave.llm.pretoken import split_texts

CHUNK_CHARS = 8 << 20   # characters of a chunk
BUCKET_BYTES = 1 << 30   # text of one bucket, where there is more than the shuffle partitions hold
PART_CHARS = 1 << 20     # characters that are split at once
OUT_IDS = 1 << 20        # ids of one output batch
# Fixed value: the split pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(path: str) -> dict[bytes, int]:
    """The token-byte table of a rank file: token bytes -> id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@functools.lru_cache(maxsize=2)
def _encoding(key: int, ranks_broadcast):
    import tiktoken

    return tiktoken.Encoding(f"ranks-{key}", pat_str=PATTERN, mergeable_ranks=ranks_broadcast.value, special_tokens={})


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed payload; each is stored in byte planes, with its length and width in front."""
    parts = []
    for a in arrays:
        width = a.dtype.itemsize
        parts.append(np.array([len(a), width], dtype="<u8").tobytes())
        parts.append(a.view(np.uint8).reshape(-1, width).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(payload: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(payload), 0, []
    while at < len(raw):
        n, width = np.frombuffer(raw, dtype="<u8", count=2, offset=at).tolist()
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * width, offset=at + 16).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view({1: "u1", 2: "<u2", 4: "<u4"}[width]))
        at += 16 + n * width
    return out


def _narrow(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")


_CHUNK_SCHEMA = "chunk long, payload binary, doc_ids array<long>, counts array<long>, words array<binary>"


def _chunks(id_type: pa.DataType, buckets: int):
    schema = pa.schema([("chunk", pa.int64()), ("payload", pa.binary()), ("doc_ids", pa.list_(id_type)),
                        ("counts", pa.list_(pa.int64())), ("words", pa.list_(pa.binary()))])

    def rows(chunk: int, parts: list, number: dict) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int32)
        # Frequent words get small indices: their byte planes compress well.
        order = np.argsort(-np.bincount(ids, minlength=len(number)), kind="stable")
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        words = list(number)
        by_bucket: dict[int, list[int]] = {}
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        for i in order.tolist():
            by_bucket.setdefault(_bucket(raw[i], buckets), []).append(i)
        packed = [None] * buckets
        for b, members in by_bucket.items():
            text = b"".join(raw[i] for i in members)
            packed[b] = _pack(_narrow(np.diff(rank[members], prepend=0)),
                              _narrow(np.array([len(raw[i]) for i in members])), np.frombuffer(text, dtype=np.uint8))
        row = (chunk, _pack(_narrow(rank[ids])), pa.concat_arrays([p[0] for p in parts]).to_pylist(),
               np.concatenate([p[2] for p in parts]).tolist(), packed)
        yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        parts, number, chars, ordinal = [], {}, 0, 0
        for batch in small_batches(batches, "text", PART_CHARS):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens, counts = split_texts(texts)
            ids = np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.int32, len(tokens))
            parts.append((batch.column(0), ids, counts))
            chars += sum(map(len, texts))
            if chars >= CHUNK_CHARS:
                yield from rows(base + ordinal, parts, number)
                parts, number, chars, ordinal = [], {}, 0, ordinal + 1
        if parts:
            yield from rows(base + ordinal, parts, number)

    return run


def _bucket(word: bytes, buckets: int) -> int:
    import zlib

    return zlib.crc32(word) % buckets


def _encode_words(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(id(ranks), ranks)
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            out = []
            for payload in batch.column("payload").to_pylist():
                steps, lengths, text = _unpack(payload)
                text, ends, ids = text.tobytes(), np.cumsum(lengths.astype(np.int64)).tolist(), []
                start = 0
                for end in ends:
                    word = text[start:end]
                    found = known.get(word)
                    if found is None:
                        found = known[word] = enc.encode_ordinary(word.decode("utf-8", "surrogatepass"))
                    ids.append(found)
                    start = end
                flat = np.array([i for x in ids for i in x], dtype=np.int64)
                out.append(_pack(steps, _narrow(np.array([len(x) for x in ids])), _narrow(flat)))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(out, pa.binary())], ["chunk", "payload"])

    return run


def _reassemble(id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("ids", pa.list_(pa.int32()))])

    def texts_of(words: list, doc_ids: list, counts: list, payload: bytes) -> Iterator[pa.RecordBatch]:
        n = sum(len(w[0]) for w in words)
        begin, size, flat, at = np.zeros(n, np.int64), np.zeros(n, np.int64), [], 0
        for steps, lengths, ids in words:
            where, lengths = np.cumsum(steps.astype(np.int64)), lengths.astype(np.int64)
            begin[where] = at + np.cumsum(lengths) - lengths
            size[where] = lengths
            flat.append(ids.astype(np.int32))
            at += len(ids)
        flat = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        (seq,) = _unpack(payload)
        ends = np.cumsum(np.array(counts, dtype=np.int64))
        i = 0
        while i < len(doc_ids):  # a few texts at a time, so that the laid-out ids stay small
            base = int(ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(ends, base + OUT_IDS // 2, side="right")))
            part = seq[base:int(ends[j - 1])]
            lengths = size[part]
            total = np.cumsum(lengths)
            laid = flat[np.repeat(begin[part] - (total - lengths), lengths) + np.arange(int(total[-1]) if len(total) else 0)]
            cuts = np.r_[0, np.r_[0, total][ends[i:j] - base]].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids[i:j], id_type), pa.ListArray.from_arrays(pa.array(cuts), pa.array(laid, pa.int32()))],
                schema=schema)
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one chunk at a time
                row = batch.slice(i, 1).to_pylist()[0]
                words = [_unpack(p) for p in row["words"] or []]
                yield from texts_of(words, row["doc_ids"], row["counts"], row["payload"])

    return run


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` as a table in the shared folder, bucketed by chunk; its catalog entry goes, the files stay."""
    spark = rows.sparkSession
    path = shared_path(spark, "bpe-chunks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    (rows.write.format("parquet").option("compression", "none").option("path", path)  # payloads are packed already
     .bucketBy(buckets, "chunk").saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _laid_out(docs: DataFrame, ranks: dict[bytes, int], buckets: int | None) -> DataFrame:
    """One row a chunk: the packed ids of its words beside its sequence of word positions."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)  # bounded by the vocabulary
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if not buckets:  # a bucket is one task's work, whatever the size of the table
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    table = _bucketed(rows.mapInArrow(_chunks(pa.int64(), buckets), _CHUNK_SCHEMA), buckets)
    words = table.select("chunk", F.posexplode("words").alias("bucket", "payload")).where("payload is not null")
    words = words.repartition(buckets, "bucket")
    found = words.select("chunk", "payload").mapInArrow(_encode_words(shared), "chunk long, payload binary")
    # A chunk's packed ids: as many rows as buckets, bounded by the chunk.
    back = found.groupBy("chunk").agg(F.collect_list("payload").alias("words"))
    sequences = table.select("chunk", "payload", "doc_ids", "counts")
    together = sequences.join(back.hint("merge"), "chunk", "left")
    return together.select("words", "payload", "doc_ids", "counts")


def encode(docs: DataFrame, ranks: dict[bytes, int], buckets: int | None = None) -> DataFrame:
    """(doc_id, ids array<int>) for every row of ``docs`` (doc_id, text)."""
    return _laid_out(docs, ranks, buckets).mapInArrow(_reassemble(pa.int64()), "doc_id long, ids array<int>")


def _decode(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob, begin, size = table.value
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(size) or not size[flat].all()):
                raise ValueError("an id has no entry in the token-byte table")
            lengths = size[flat]
            total = np.r_[0, np.cumsum(lengths)]
            data = blob[np.repeat(begin[flat] - total[:-1], lengths) + np.arange(int(total[-1]))]
            cuts = np.r_[0, np.cumsum(np.array([len(x) for x in ids], dtype=np.int64))]
            out = pa.Array.from_buffers(pa.large_binary(), len(ids), [
                None, pa.py_buffer(total[cuts].astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, out.cast(pa.binary())], ["doc_id", "ids", "decoded"])

    return run


def _token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table as one byte string with the start and size of each id."""
    top = max(ranks.values(), default=-1) + 1
    size, begin = np.zeros(top, np.int64), np.zeros(top, np.int64)
    parts, at = [], 0
    for token, i in sorted(ranks.items(), key=lambda x: x[1]):
        size[i], begin[i] = len(token), at
        parts.append(token)
        at += len(token)
    return np.frombuffer(b"".join(parts), dtype=np.uint8), begin, size


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes of the ids by the token-byte table."""
    shared = encoded.sparkSession.sparkContext.broadcast(_token_bytes(ranks))
    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(
        _decode(shared), "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], buckets: int | None = None) -> DataFrame:
    """:func:`decode` of :func:`encode`, both in one pass of the same Python workers."""
    shared = docs.sparkSession.sparkContext.broadcast(_token_bytes(ranks))
    lay_out, to_bytes = _reassemble(pa.int64()), _decode(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return to_bytes(lay_out(batches))

    return _laid_out(docs, ranks, buckets).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of (doc_id, ids, decoded), and the columns ``more``."""
    return decoded.select(
        "doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
