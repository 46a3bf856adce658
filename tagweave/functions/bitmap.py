"""Uid bitmap helpers over Spark's built-in bitmap functions.

Spark's bitmaps are fixed 4096-byte blobs, one per bucket of 32768 ids:
``bitmap_bucket_number(uid)`` picks the bucket and ``bitmap_bit_position``
the bit inside it.  For uid >= 1: ``uid = (bucket - 1) * 32768 + pos + 1``;
uid 0 is bucket 0, bit 0.  Grouping by (key, bucket) keeps every aggregation
state at 4 KB, so a value held by a third of all users still spreads over
``users / 32768`` independent groups.

A stored ``us`` has the smallest of three forms, told apart by its length:

* 4096 bytes: the bitmap;
* an even number below: the sorted positions as two-byte big-endian numbers, for
  at most ``SPARSE_LIMIT`` set bits (a value held by one user takes two bytes);
* an odd number: one zero byte, then the first and last position of each run of
  consecutive positions, two bytes each (a full bucket takes five bytes).

Every function here reads all forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS_PER_BUCKET = 32768
BYTES_PER_BITMAP = BITS_PER_BUCKET // 8


def bucket(uid) -> Column:
    return F.bitmap_bucket_number(uid)


def position(uid) -> Column:
    return F.bitmap_bit_position(uid)


def uid_of(bucket_col, pos_col) -> Column:
    b = F.col(bucket_col) if isinstance(bucket_col, str) else bucket_col
    p = F.col(pos_col) if isinstance(pos_col, str) else pos_col
    return F.when(b == 0, p).otherwise((b - 1) * BITS_PER_BUCKET + p + 1)


def checked_uid(col) -> Column:
    """Text uid -> non-negative bigint; anything else fails the job.

    The bitmap holds unsigned 64-bit ids; Spark has no unsigned type, so
    negative and non-numeric ids are rejected rather than silently dropped.
    """
    c = F.col(col) if isinstance(col, str) else col
    as_long = c.cast("string").try_cast(T.LongType())
    bad = c.isNull() | as_long.isNull() | (as_long < 0)
    return F.when(bad, F.raise_error(F.concat(F.lit("uid is not a non-negative integer: "),
                                              F.coalesce(c.cast("string"), F.lit("NULL"))))
                  ).otherwise(as_long)


SPARSE_LIMIT = 1024


def build_states(key_columns: list[str], at_column: str):
    """Task function over rows sorted by key and position: each key's stored state and its users.

    A batch of rows is cut into groups with arrays.  Groups of few users, nearly
    all of them, are packed together; only groups stored as runs or as a bitmap
    are made one by one.  The last group of a batch waits for the next one.
    """
    nbytes, nbits, sparse = BYTES_PER_BITMAP, BITS_PER_BUCKET, SPARSE_LIMIT

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def states(table):
            at = table.column(at_column).to_numpy(zero_copy_only=False).astype(np.int64)
            new = np.ones(len(at), bool)   # first row of a group
            new[1:] = False
            for k in key_columns:
                column = table.column(k)
                differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
                null = pc.is_null(column).to_numpy(zero_copy_only=False)
                new[1:] |= pc.fill_null(differs, False).to_numpy(zero_copy_only=False) | (null[1:] != null[:-1])
            keep = new.copy()
            keep[1:] |= at[1:] != at[:-1]  # a repeated position counts once
            first = np.flatnonzero(new)
            keys = [table.column(k).take(pa.array(first)) for k in key_columns]
            at, new = at[keep], new[keep]
            start = np.flatnonzero(new)
            users = np.diff(np.r_[start, len(at)])
            begins = new.copy()
            begins[1:] |= at[1:] != at[:-1] + 1
            runs = np.add.reduceat(begins.astype(np.int64), start)
            small = np.where(users <= sparse, 2 * users, nbytes)
            as_runs = 4 * runs + 1 < small
            large = np.flatnonzero(as_runs | (users > sparse))
            size = small.copy()
            size[as_runs] = 4 * runs[as_runs] + 1
            ends = np.r_[0, np.cumsum(size)].astype(np.int32)
            raw = np.zeros(int(ends[-1]), np.uint8)
            few = np.ones(len(users), bool)
            few[large] = False
            which = np.repeat(few, users)
            place = (np.repeat(ends[:-1], users) + 2 * (np.arange(len(at)) - np.repeat(start, users)))[which]
            raw[place], raw[place + 1] = at[which] >> 8, at[which] & 255
            for g in large.tolist():
                own = at[start[g]:start[g] + users[g]]
                out = raw[ends[g]:ends[g + 1]]
                if as_runs[g]:
                    head = np.flatnonzero(begins[start[g]:start[g] + users[g]])
                    pairs = np.stack([own[head], own[np.r_[head[1:], len(own)] - 1]], axis=1)
                    out[1:] = pairs.astype(">u2").reshape(-1).view(np.uint8)
                else:
                    bits = np.zeros(nbits, np.uint8)
                    bits[own] = 1
                    out[:] = np.packbits(bits, bitorder="little")
            us = pa.Array.from_buffers(pa.binary(), len(users), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
            return pa.RecordBatch.from_arrays([*keys, us, pa.array(users, pa.int64())], names=[*key_columns, "us", "users"])

        held = None
        for batch in batches:
            table = batch if held is None else pa.concat_batches([held, batch])
            last = {k: table.column(k)[-1] for k in key_columns}
            same = np.ones(len(table), bool)
            for k, value in last.items():
                column = table.column(k)
                equal = pc.is_null(column) if not value.is_valid else pc.fill_null(pc.equal(column, value), False)
                same &= equal.to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0  # rows are sorted: the last group is a tail
            if cut:
                yield states(table.slice(0, cut))
            held = table.slice(cut)
            if len(held) > 2 * nbits:  # more rows than positions: repeated ones go
                at = held.column(at_column).to_numpy(zero_copy_only=False)
                held = held.take(pa.array(np.flatnonzero(np.r_[True, at[1:] != at[:-1]])))
        if held is not None and len(held):
            yield states(held)

    return run


def _number(us: Column, at: Column) -> Column:
    """The two-byte number of a stored ``us`` that starts at a byte (1-based)."""
    return F.conv(F.hex(F.substring(us, at, F.lit(2))), 16, 10).cast("int")


def _each(n: Column, value) -> Column:
    """Array of ``value(i)`` for i from 0 to n - 1."""
    return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), value)


def _run_ends(us: Column) -> Column:
    """array<struct<first, last>> of a run form."""
    return _each((F.octet_length(us) / 4).cast("int"),
                 lambda i: F.struct(_number(us, i * 4 + 2).alias("first"), _number(us, i * 4 + 4).alias("last")))


def users_in(us) -> Column:
    """Set bits of a stored bitmap."""
    c = F.col(us) if isinstance(us, str) else us
    size = F.octet_length(c)
    in_runs = F.aggregate(_run_ends(c), F.lit(0).cast("long"), lambda n, r: n + (r["last"] - r["first"] + 1))
    return (F.when(size == BYTES_PER_BITMAP, F.bitmap_count(c)).when(size % 2 == 0, (size / 2).cast("long"))
            .otherwise(in_runs))


def dense(bitmaps: DataFrame, keys: list[str], bitmap_col: str = "us") -> DataFrame:
    """``keys + [us]`` with every ``us`` as a 4096-byte bitmap; ``keys`` identify a row."""
    us = F.col(bitmap_col)
    size = F.octet_length(us)
    full = size == BYTES_PER_BITMAP
    in_runs = F.flatten(F.transform(_run_ends(us), lambda r: F.sequence(r["first"], r["last"])))
    at = F.when(size % 2 == 0, _each((size / 2).cast("int"), lambda i: _number(us, i * 2 + 1))).otherwise(in_runs)
    spread = (bitmaps.filter(~full & (size > 0)).select(*keys, F.explode(at.cast("array<long>")).alias("_at"))
              .groupBy(*keys).agg(F.bitmap_construct_agg("_at").alias(bitmap_col)))
    return bitmaps.filter(full).select(*keys, bitmap_col).unionByName(spread)


def _or_states(key_columns: list[str], bitmap_col: str):
    """Task function over rows sorted by key: the union of each key's states, in its smallest form, and its users."""
    nbytes, nbits, sparse = BYTES_PER_BITMAP, BITS_PER_BUCKET, SPARSE_LIMIT

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def add(bits, raw):
            if len(raw) == nbytes:
                bits |= np.frombuffer(raw, np.uint8)
            elif len(raw) % 2 == 0:
                at = np.frombuffer(raw, ">u2")
                np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
            else:
                step = np.zeros(nbits + 1, np.int32)
                ends = np.frombuffer(raw, ">u2", offset=1).reshape(-1, 2).astype(np.int64)
                np.add.at(step, ends[:, 0], 1)
                np.add.at(step, ends[:, 1] + 1, -1)
                bits |= np.packbits(np.cumsum(step[:-1]) > 0, bitorder="little")

        def smallest(bits):
            at = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
            first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            size = 2 * len(at) if len(at) <= sparse else nbytes
            if 4 * len(first) + 1 < size:
                ends = np.stack([at[first], at[np.r_[first[1:], len(at)] - 1]], axis=1)
                return b"\0" + ends.astype(">u2").tobytes(), len(at)
            return (at.astype(">u2").tobytes() if len(at) <= sparse else bits.tobytes()), len(at)

        current, state, kind = None, None, None
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in key_columns)))
            kind = kind or [batch.schema.field(k).type for k in key_columns]
            done = []
            for key, raw in zip(keys, batch.column(bitmap_col)):
                if state is None or key != current:
                    if state is not None:
                        done.append((*current, *smallest(state)))
                    current, state = key, np.zeros(nbytes, np.uint8)
                add(state, raw.as_py())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), [*kind, pa.binary(), pa.int64()])],
                                                 names=[*key_columns, bitmap_col, "users"])
        if state is not None:
            row = (*current, *smallest(state))
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, [*kind, pa.binary(), pa.int64()])],
                                             names=[*key_columns, bitmap_col, "users"])

    return run


def merged(bitmaps: DataFrame, keys: list[str], bitmap_col: str = "us") -> DataFrame:
    """``keys + [us, users]``: the union of all states of a key, form to form, never decoded to users.

    ``keys`` hold the bucket.  A task holds one 4 KB state; a key's rows are as many
    as the days that are merged.
    """
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (bitmaps.schema[k] for k in keys))
    rows = bitmaps.select(*keys, bitmap_col).repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(_or_states(list(keys), bitmap_col), f"{out}, `{bitmap_col}` binary, users bigint")


# Uids of one output batch of decode; one bitmap adds at most 32768 more.
_DECODE_ROWS = 1 << 18


def decode(bitmaps: DataFrame, keys: list[str], bucket_col: str = "bucket",
           bitmap_col: str = "us", uid_col: str = "uid") -> DataFrame:
    """One row per uid set in each bitmap: ``keys + [uid]``.

    Runs as ``mapInPandas``: bitmaps are unpacked one by one with numpy and
    handed on every ``_DECODE_ROWS`` uids, so a task holds its input batch and
    a bounded output.  The task function only needs numpy and pandas on the
    executors (it is shipped by value).
    """
    key_fields = [bitmaps.schema[k] for k in keys]
    out_schema = T.StructType(key_fields + [T.StructField(uid_col, T.LongType(), False)])
    limit, nbytes, nbits = _DECODE_ROWS, BYTES_PER_BITMAP, BITS_PER_BUCKET

    def expand(batches):
        import numpy as np

        def frame(pdf, rows, uids):
            out = pdf[keys].iloc[np.concatenate(rows)].reset_index(drop=True)
            out[uid_col] = np.concatenate(uids)
            return out

        for pdf in batches:
            rows, uids, n = [], [], 0
            for i, (b, raw) in enumerate(zip(pdf[bucket_col], pdf[bitmap_col])):
                raw = bytes(raw)
                if len(raw) == nbytes:
                    pos = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little"))
                elif len(raw) % 2 == 0:
                    pos = np.frombuffer(raw, ">u2")
                else:
                    ends = np.frombuffer(raw, ">u2", offset=1).reshape(-1, 2).astype(np.int64)
                    size = ends[:, 1] - ends[:, 0] + 1
                    pos = np.repeat(ends[:, 0] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                pos = pos.astype(np.int64)
                rows.append(np.full(len(pos), i))
                uids.append(pos if b == 0 else (b - 1) * nbits + pos + 1)
                n += len(pos)
                if n >= limit:
                    yield frame(pdf, rows, uids)
                    rows, uids, n = [], [], 0
            if n:
                yield frame(pdf, rows, uids)

    return bitmaps.select(*keys, bucket_col, bitmap_col).mapInPandas(expand, out_schema)
