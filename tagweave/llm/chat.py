"""Chat formatting at the token level: segments encoded on their own, reserved ids spliced in, loss masks, and back.

A turn is ``head | content | tail``.  Head and tail are reserved ids beyond the
vocabulary, so no text can ever encode to them; texts and the names of unknown
roles are encoded separately from each other and from the markers.  The template
also has a plain-text form, in which each reserved id stands for its control
string.  So that this form can be read back too, control strings that occur
inside a text are escaped: one backslash goes in after the first character of a
control string, or of one that already has backslashes there, and comes out
again on reading.

    user       <s>[INST] text [/INST]          assistant   [OUT] text </s>
    system     <<SYS>> text <</SYS>>           other       [ROLE] name [/ROLE] text [END]

Positions and masks come from prefix sums: the running sum of segment lengths
places every segment in the flat id array, and the running sum of +1 at the start
and -1 behind the end of every trained text is the loss mask.

The turns are dealt to range partitions by conversation and turn, so a
conversation with a large share of all rows is cut between turns and spreads over
many tasks.  A conversation that lies inside one partition is one row
(``whole``); one that may reach a neighbour partition, or has over
``PIECE_IDS`` ids, is a sequence of rows in the order of (part, piece).  The
output is written to the shared folder.

Defined results: a null text is empty; a null role is a role with an empty name;
a null conversation id is a conversation of its own; turns with equal numbers
are ordered by a hash of role and text, null numbers first, and repeated rows
stay repeated; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import small_batches, written
from tagweave.llm.tokenfile import WordEncoder
from tagweave.llm.vocabulary import Table, byte_level_tokens

# The template's control strings; the place in this list makes the reserved id.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[OUT]", "[ROLE]", "[/ROLE]", "[END]"]
NUMBER = {c: i for i, c in enumerate(CONTROLS)}
HEADS = {"user": ["<s>", "[INST]"], "assistant": ["[OUT]"], "system": ["<<SYS>>"]}
TAILS = {"user": ["[/INST]"], "assistant": ["</s>"], "system": ["<</SYS>>"]}
OPEN_NAME, CLOSE_NAME, END_NAMED = "[ROLE]", "[/ROLE]", "[END]"
LOSS_ROLES = ("assistant",)
PART_CHARS = 1 << 20
PIECE_IDS = 1 << 15

_CONTROL = "|".join(f"{re.escape(c[0])}(?={{}}{re.escape(c[1:])})" for c in CONTROLS)
_TO_ESCAPE = re.compile(_CONTROL.replace("{}", r"\\*"))
_ESCAPED = re.compile("|".join(f"({re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in CONTROLS))


def escape(text: str) -> str:
    """``text`` without any control string; :func:`unescape` gives it back."""
    return _TO_ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[m.lastindex], text)


@dataclass(frozen=True)
class Format:
    tokenizer_path: str
    first_reserved: int              # ids from here on are the control strings
    loss_roles: tuple = LOSS_ROLES


class Codec:
    """Encodes segments of text, and decodes ids, reserved ones to their control strings."""

    def __init__(self, path: str, first_reserved: int):
        self.encoder, self.first = WordEncoder(path), first_reserved
        tokenizer = self.encoder.tokenizer
        if tokenizer.get_vocab_size() > first_reserved:
            raise ValueError(f"reserved ids must lie beyond the vocabulary of {tokenizer.get_vocab_size()} ids")
        gap = [b""] * (first_reserved - tokenizer.get_vocab_size())
        self.table = Table([*byte_level_tokens(tokenizer), *gap, *(c.encode() for c in CONTROLS)])

    def reserved(self, names: list[str]) -> list[int]:
        return [self.first + NUMBER[n] for n in names]

    def text(self, ids) -> str:
        """Plain form of ``ids``: reserved ids as control strings, texts still escaped."""
        return self.table.bytes_of(np.asarray(ids, dtype=np.int64)).tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def _codec(path: str, first_reserved: int) -> Codec:
    """One per worker process: its word cache outlives a task."""
    return Codec(path, first_reserved)


# --- formatting ------------------------------------------------------------------------------


def assemble(codec: Codec, roles: list[str], texts: list[str], loss_roles) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat ids and loss mask of the turns, and the number of ids of each turn."""
    unknown = [i for i, r in enumerate(roles) if r not in HEADS]
    ids, sizes = codec.encoder.encode([escape(t) for t in texts] + [escape(roles[i]) for i in unknown])
    begins = np.cumsum(sizes) - sizes
    heads, tails = [codec.reserved(HEADS.get(r, [])) for r in roles], [codec.reserved(TAILS.get(r, [END_NAMED])) for r in roles]
    for k, i in enumerate(unknown):
        name = ids[begins[len(texts) + k]:][:sizes[len(texts) + k]].tolist()
        heads[i] = codec.reserved([OPEN_NAME]) + name + codec.reserved([CLOSE_NAME])
    n_head, n_tail = (np.array([len(x) for x in y], dtype=np.int64) for y in (heads, tails))
    n_text = sizes[:len(texts)]
    lengths = np.stack([n_head, n_text, n_tail], axis=1)
    places = np.cumsum(lengths.reshape(-1)).reshape(-1, 3) - lengths  # where each segment starts
    total = int(lengths.sum())
    flat, step = np.empty(total, dtype=np.int32), np.zeros(total + 1, dtype=np.int32)
    for k, parts in ((0, heads), (2, tails)):
        values = np.array([x for p in parts for x in p], dtype=np.int32)
        flat[_spread(places[:, k], lengths[:, k])] = values
    flat[_spread(places[:, 1], n_text)] = ids[:int(n_text.sum())]
    trained = np.array([r in loss_roles for r in roles], dtype=bool)
    np.add.at(step, places[trained, 1], 1)
    np.add.at(step, places[trained, 1] + n_text[trained], -1)
    return flat, np.cumsum(step[:-1]).astype(np.int8), lengths.sum(axis=1)


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... for each stretch."""
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


_FORMATTED = "conv_id long, part int, piece int, whole boolean, n_turns long, ids array<int>, loss array<byte>"


def _format(form: Format, piece_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        held: list = []       # (conv_id, turns, ids, loss) of the conversation at the end of the rows so far
        edge = True           # the next row may continue a conversation that already has rows

        def rows(some: list, whole: list) -> pa.RecordBatch:
            nonlocal piece
            n = np.array([0] + [len(x[2]) for x in some], dtype=np.int32).cumsum().astype(np.int32)
            ids, loss = (np.concatenate([x[k] for x in some]) for k in (2, 3))
            out = pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in some], pa.int64()), pa.array([part] * len(some), pa.int32()),
                pa.array(range(piece, piece + len(some)), pa.int32()), pa.array(whole), pa.array([x[1] for x in some], pa.int64()),
                pa.ListArray.from_arrays(pa.array(n), pa.array(ids)), pa.ListArray.from_arrays(pa.array(n), pa.array(loss)),
            ], names=["conv_id", "part", "piece", "whole", "n_turns", "ids", "loss"])
            piece += len(some)
            return out

        for batch in small_batches(batches, "text", PART_CHARS):
            convs = batch.column("conv_id").to_pylist()
            ids, loss, sizes = assemble(_codec(form.tokenizer_path, form.first_reserved),
                                        [r or "" for r in batch.column("role").to_pylist()],
                                        [t or "" for t in batch.column("text").to_pylist()], form.loss_roles)
            cuts = [0] + [i for i in range(1, len(convs)) if convs[i] != convs[i - 1]] + [len(convs)]
            at = np.r_[0, np.cumsum(sizes)]
            new = [(convs[a], b - a, ids[at[a]:at[b]], loss[at[a]:at[b]]) for a, b in zip(cuts, cuts[1:])]
            if held and held[0][0] == new[0][0]:
                last = held[0]
                new[0] = (last[0], last[1] + new[0][1], np.r_[last[2], new[0][2]], np.r_[last[3], new[0][3]])
            elif held and held[0][1]:
                new = held + new
            elif held:      # its pieces are out, and it ended there
                edge = False
            done, held = new[:-1], new[-1:]
            if done:
                yield rows(done, [not edge] + [True] * (len(done) - 1))
                edge = False
            if len(held[0][2]) >= piece_ids:
                yield rows(held, [False])
                held, edge = [(held[0][0], 0, ids[:0], loss[:0])], True
        if held and held[0][1]:
            yield rows(held, [False])  # it may reach into the partition behind

    return run


def format_conversations(turns: DataFrame, form: Format, piece_ids: int = PIECE_IDS) -> DataFrame:
    """(conv_id, part, piece, whole, n_turns, ids, loss) of ``turns`` (conv_id, turn, role, text), written and reread.

    The rows of a conversation that are not ``whole`` follow each other by (part, piece).
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text",
                        F.xxhash64("role", "text").alias("tie"))
    dealt = rows.repartitionByRange("conv_id", "turn", "tie").sortWithinPartitions("conv_id", "turn", "tie")
    return written(dealt.select("conv_id", "role", "text").mapInArrow(_format(form, piece_ids), _FORMATTED), "chat")


# --- reading back ----------------------------------------------------------------------------


def turns_of(codec: Codec, ids: np.ndarray, loss: np.ndarray) -> Iterator[tuple[str, str, str, int]]:
    """(role, text, text under the mask, characters of the plain form) of each turn, from ids and mask alone."""
    first, head_role = codec.first, {codec.reserved(h)[-1]: r for r, h in HEADS.items()}
    open_name, close_name = codec.reserved([OPEN_NAME])[0], codec.reserved([CLOSE_NAME])[0]
    raw = codec.table.bytes_of(ids).tobytes()
    at = np.r_[0, np.cumsum(codec.table.size[ids])].tolist()   # where the bytes of each id begin
    under_mask = np.r_[0, np.cumsum(loss)].tolist()
    role, begin, turn = None, 0, 0

    def plain_form(a: int, b: int) -> str:
        return raw[at[a]:at[b]].decode("utf-8", "replace")

    marks = np.flatnonzero(ids >= first)
    for i, mark in zip(marks.tolist(), ids[marks].tolist()):
        if mark in head_role:
            role, begin = head_role[mark], i + 1
        elif mark == open_name:
            begin = i + 1
        elif mark == close_name:
            role, begin = unescape(plain_form(begin, i)), i + 1
        elif role is not None:  # the tail
            text = plain_form(begin, i)
            plain = unescape(text)
            trained = under_mask[i + 1] - under_mask[turn]
            if not trained:
                under = ""
            elif trained == i - begin == under_mask[i] - under_mask[begin]:
                under = plain
            else:
                under = unescape(codec.text(ids[turn:i + 1][loss[turn:i + 1] > 0]))
            yield role, plain, under, len(plain_form(turn, begin)) + len(text) + len(plain_form(i, i + 1))
            role, turn = None, i + 1


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    conv, ids, loss = (batch.column(c) for c in ("conv_id", "ids", "loss"))
    for i in range(batch.num_rows):
        yield conv[i].as_py(), *(x[i].values.to_numpy(zero_copy_only=False) for x in (ids, loss))


def _read(form: Format):
    turn = pa.struct([("role", pa.string()), ("text", pa.string()), ("loss_text", pa.string()), ("chars", pa.int64())])
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("turns", pa.list_(turn))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codec = _codec(form.tokenizer_path, form.first_reserved)
            turns = [[dict(zip(("role", "text", "loss_text", "chars"), t)) for t in turns_of(codec, ids, loss)]
                     for _, ids, loss in _rows(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), batch.column("piece"),
                                              pa.array(turns, pa.list_(turn))], schema=schema)

    return run


def read_back(formatted: DataFrame, form: Format) -> DataFrame:
    """(conv_id, part, piece, turns) with the role, text, trained text and plain-form length of each turn."""
    return formatted.select("conv_id", "part", "piece", "ids", "loss").mapInArrow(
        _read(form), "conv_id long, part int, piece int, turns array<struct<role:string,text:string,loss_text:string,chars:long>>")


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(form: Format):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _DIGEST.split(", ")]
        current, state = None, None

        def row() -> tuple:
            n, turns, chars, loss, size = state
            return current, n, turns.hexdigest(), chars, loss.hexdigest(), size

        def out(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            done = []
            codec = _codec(form.tokenizer_path, form.first_reserved)
            for conv, ids, loss in _rows(batch):
                if state is None or conv != current:
                    if state is not None:
                        done.append(row())
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, under, size in turns_of(codec, ids, loss):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(under)
                    state[3].update(under.encode())
                    state[4] += size
            if done:
                yield out(done)
        if state is not None:
            yield out([row()])

    return run


def digests(formatted: DataFrame, form: Format) -> DataFrame:
    """One row a conversation, from the written ids and masks: turns, digests of turns and trained text, lengths.

    Whole conversations are read where they lie; the pieces of others meet by id
    and are read as a stream, never held together.
    """
    cols = ["conv_id", "part", "piece", "ids", "loss"]
    whole = formatted.where("whole").select(*cols).mapInArrow(_digest(form), _DIGEST)
    pieces = formatted.where("not whole").select(*cols).repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return whole.unionByName(pieces.mapInArrow(_digest(form), _DIGEST))
