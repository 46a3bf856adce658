import hashlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tagweave.llm import bpe
from tagweave.llm.pretoken import split_texts

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
ENC = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = ["'", " ", "  ", "\n", "\t", "s", "t", "re", "ve", "ll", "d", "m", "x", "A", "é", "1", "²", "Ⅷ", "!", "#", " ",
          "　", "​", "漢", "😀", "\x00", "\x1c", "\x85", "'s", "'re", " '", "<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=6))
def test_split_matches_the_library(texts):
    tokens, counts = split_texts(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        mine = tokens[at:at + n]
        at += n
        assert "".join(mine) == text
        assert [i for w in mine for i in ENC.encode_ordinary(w)] == ENC.encode_ordinary(text)
    assert at == len(tokens)


def expected(docs):
    out = Counter()
    for r in docs.collect():
        ids = ENC.encode_ordinary(r["text"] or "")
        out[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("buckets", [None, 3])
def test_round_trip(spark, real_docs, edge_docs, empty_docs, buckets):
    for docs in (real_docs.limit(60), edge_docs, empty_docs):
        apart = bpe.digests(bpe.decode(bpe.encode(docs, RANKS, buckets), RANKS))
        got = bpe.digests(bpe.round_trip(docs, RANKS, buckets))
        assert Counter(tuple(r) for r in apart.collect()) == expected(docs)
        assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert Counter(tuple(r) for r in got.collect()) == expected(docs)


def test_many_chunks_share_words(spark, real_docs):
    docs = real_docs.limit(40).repartition(5)
    assert Counter(tuple(r) for r in bpe.digests(bpe.decode(bpe.encode(docs, RANKS), RANKS)).collect()) == expected(docs)


def test_unknown_id_is_an_error(spark):
    bad = spark.createDataFrame([(1, [999_999])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="token-byte table"):
        bpe.decode(bad, RANKS).collect()
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(none, RANKS).first()["decoded"]) == b""
