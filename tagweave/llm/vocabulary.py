"""Bytes of the tokens of a vocabulary, as flat arrays."""

from __future__ import annotations

import numpy as np

BLANK_MARK = "▁"  # fixed value: how sentencepiece pieces write a blank


class Table:
    """Bytes of each id of a vocabulary, laid end to end."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        return self.data[np.repeat(self.begin[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def byte_letters() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable bytes stand for themselves, others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def byte_level_tokens(tokenizer) -> list[bytes]:
    """Bytes of each id of a byte-level ``tokenizers`` vocabulary; special tokens stand for their own text."""
    letters = byte_letters()
    tokens = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
    return [bytes(map(letters.__getitem__, t)) if all(c in letters for c in t) else t.encode() for t in tokens]


def piece_tokens(pieces) -> list[bytes]:
    """Bytes of each id of a ``sentencepiece`` model with byte fallback."""
    names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace(BLANK_MARK, " ").encode() for i, p in enumerate(names)]
