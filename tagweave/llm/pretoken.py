"""Splitting text into byte-level BPE pre-tokens, many texts at once.

The split is the one of the public pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

computed from runs of character classes with numpy: a run of letters, numbers
or other signs is one pre-token; one blank in front of it joins it; the rest of
a white-space run stands alone; a lone apostrophe takes its contraction ending.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that a lone apostrophe takes.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


_PAGE = 256
_KINDS = {"L": LETTER, "N": NUMBER}
_table = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
_seen_pages: set[int] = set()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _classes(cp: np.ndarray) -> np.ndarray:
    """The class of each code point; the table is filled page by page as pages occur."""
    for page in np.flatnonzero(np.bincount(cp >> 8)).tolist():
        if page not in _seen_pages:
            span = range(page * _PAGE, (page + 1) * _PAGE)
            _table[page * _PAGE:(page + 1) * _PAGE] = [_KINDS.get(unicodedata.category(chr(c))[0], OTHER) for c in span]
            _table[[c for c in WHITE_SPACE if c in span]] = SPACE
            _seen_pages.add(page)
    return _table[cp]


def split_points(text: str, text_starts: np.ndarray) -> np.ndarray:
    """Start offsets of all pre-tokens of ``text``, a concatenation of texts that begin at ``text_starts``."""
    cp = code_points(text)
    n = len(cp)
    if not n:
        return np.zeros(0, dtype=np.int64)
    cls = _classes(cp)
    first = np.zeros(n + 1, dtype=bool)
    first[text_starts] = True
    new = np.empty(n, dtype=bool)
    new[0] = True
    new[1:] = (cls[1:] != cls[:-1]) | first[1:n]
    rs = np.flatnonzero(new)
    re = np.r_[rs[1:], n]
    rc = cls[rs]
    goes_on = np.r_[~first[rs[1:]], False]  # the next run belongs to the same text
    space = rc == SPACE
    blank_last = space & goes_on & (cp[re - 1] == 32)
    absorbed = np.r_[False, blank_last[:-1]]  # the run's pre-token began one blank earlier
    starts = np.zeros(n, dtype=bool)
    starts[rs[~absorbed]] = True
    starts[re[space & goes_on] - 1] = True
    # Contractions: an apostrophe run of length one, with no blank taken in, before a letter run.
    apo = np.flatnonzero((cp[rs] == 39) & (re - rs == 1) & ~absorbed & goes_on & np.r_[rc[1:] == LETTER, False])
    if len(apo):
        at = re[apo]
        room = re[apo + 1] - at
        taken = np.zeros(len(apo), dtype=np.int64)
        padded = np.r_[cp, 0]
        for ending in ENDINGS:
            fits = room >= len(ending)
            for k, ch in enumerate(ending):
                fits &= padded[np.minimum(at + k, n)] == ord(ch)
            taken[fits & (taken == 0)] = len(ending)
        got = taken > 0
        starts[at[got]] = False
        rest = got & (room > taken)
        starts[at[rest] + taken[rest]] = True
    return np.flatnonzero(starts)


def _laid(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    return "".join(texts), lengths, np.cumsum(lengths) - lengths


def _per_text(starts: np.ndarray, lengths: np.ndarray, begins: np.ndarray) -> np.ndarray:
    counts = np.diff(np.r_[np.searchsorted(starts, begins), len(starts)])
    counts[lengths == 0] = 0
    return counts


def split_texts(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of ``texts`` in order, and the number of pre-tokens of each text."""
    text, lengths, begins = _laid(texts)
    starts = split_points(text, begins[lengths > 0])
    ends = np.r_[starts[1:], len(text)].tolist()
    tokens = [text[a:b] for a, b in zip(starts.tolist(), ends)]
    return tokens, _per_text(starts, lengths, begins)


_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]  # of 1 / R and of R, grown as needed


def _hashes(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each piece of ``raw`` cut at ``at`` (modulo 2**64), from one running sum over all bytes."""
    with np.errstate(over="ignore"):
        if len(_powers[0]) < len(raw) + 1:
            for k, base in enumerate((pow(_R, -1, 1 << 64), _R)):
                steps = np.full(max(len(raw) + 1, 1 << 16), base, dtype=np.uint64)
                steps[0] = 1
                _powers[k] = np.cumprod(steps)
        back, forth = _powers
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * back[:len(raw)], out=sums[1:])
        return (sums[at[1:]] - sums[at[:-1]]) * forth[at[:-1]]


def numbered(text: str, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct pieces (UTF-8) of ``text`` cut at ``starts``, and the number of the piece at each place.

    Pieces meet by hash and every one is compared with the first of its number.
    """
    data = text.encode("utf-8", "surrogatepass")
    at = np.r_[starts, len(text)].astype(np.int64)
    if len(data) > len(text):
        cp = code_points(text)
        width = 1 + (cp >= 0x80).astype(np.int8) + (cp >= 0x800) + (cp >= 0x10000)
        at = np.r_[0, np.cumsum(width, dtype=np.int64)][at]
    if not len(starts):
        return [], np.zeros(0, dtype=np.int32)
    raw = np.frombuffer(data, dtype=np.uint8)
    number = pa.array(_hashes(raw, at)).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    first = np.empty(int(number.max()) + 1, dtype=np.int64)
    first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
    size, of = np.diff(at), first[number]
    if (size == size[of]).all() and (raw == raw[np.repeat(at[of] - at[:-1], size) + np.arange(len(raw))]).all():
        return [data[a:b] for a, b in zip(at[first].tolist(), at[first + 1].tolist())], number
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data)])
    coded = pieces.dictionary_encode()  # two pieces share a hash
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def split_numbered(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct pre-tokens of ``texts``, the number of the pre-token at each place, pre-tokens of each text."""
    text, lengths, begins = _laid(texts)
    starts = split_points(text, begins[lengths > 0])
    return (*numbered(text, starts), _per_text(starts, lengths, begins))
