import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagweave.llm import alignment as al
from tagweave.llm.vocabulary import byte_letters
from tagweave.llm.queries import FILE_TOKENIZER, PIECE_MODEL, queries, tokenizer_path

A, B = tokenizer_path(FILE_TOKENIZER), tokenizer_path(PIECE_MODEL)
ODD = [
    "a ", " ", "  ", "   x", "a  b\n c\t d", "x \n y", "▁mark", "one ▁ two", "é😀 漢字 naïve \x00 text", "it's we'll  'tis",
    "<s> </s> <unk> <0x41> <|endoftext|>", "trail   \n ", "\n", " \n ", "no break   wide", "1 22 333 4444,5", "ſ ﬁ Å é",
    "\u0085 next   line", "tab\t tab", "﻿bom", "aaaa" * 50, "ab" * 3000 + " " + "ab" * 3000, "\x7f\x01 \x1c \x1f", "..  ..   ..",
]


def csr(m):
    starts = np.r_[0, np.cumsum((m != 0).sum(axis=1))]
    r, c = np.nonzero(m)
    return al.CSR(starts, c, m[r, c], m.shape[1])


def dense(m):
    out = np.zeros((m.height, m.width), dtype=np.int64)
    out[np.repeat(np.arange(m.height), np.diff(m.starts)), m.columns] = m.values
    return out


@pytest.mark.parametrize("expansion", [1, 7, 1 << 22])
def test_products_and_transposes_equal_dense_ones(monkeypatch, expansion):
    monkeypatch.setattr(al, "EXPANSION", expansion)
    rng = np.random.default_rng(expansion)
    for _ in range(60):
        h, k, w = rng.integers(1, 9, 3)
        a, b = (rng.integers(0, 4, s) * (rng.random(s) < 0.4) for s in ((h, k), (k, w)))
        assert np.array_equal(dense(al.product(csr(a), csr(b))), a @ b)
        assert np.array_equal(dense(csr(a).transposed()), a.T)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(1, n)), st.sets(st.integers(1, n)))))
def test_links_and_groups_of_any_two_divisions(case):
    n, x, y = case
    ends = [sorted({*s, n}) for s in (x, y)]
    got = al.align_tokens(*(np.array(e) for e in ends))
    spans = [list(zip([0, *e], e)) for e in ends]
    over = [(i, j, min(b, d) - max(a, c)) for i, (a, b) in enumerate(spans[0]) for j, (c, d) in enumerate(spans[1])
            if min(b, d) > max(a, c)]
    assert list(zip(got.link_a.tolist(), got.link_b.tolist(), got.shared_bytes.tolist())) == over
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups = [[sum(c < e for c in cuts) for e in es] for es in ends]
    assert [got.group_a.tolist(), got.group_b.tolist()] == groups
    shared = [[int(g == h) for h in groups[1]] for g in groups[0]]
    assert dense(got.in_group()).tolist() == shared
    assert int(got.in_group_counts().sum()) == sum(map(sum, shared))


def brute(texts):
    """Whole texts by the libraries, then every pair of tokens and a count over all."""
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = byte_letters()
    rows, count = [], Counter()
    for t in texts:
        row = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_shared": 0, "links": [], "sha": ""}
        rows.append(row)
        if not t:
            continue
        a, b = tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
        bytes_a = [bytes(letters[c] for c in tok.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            continue
        ends = [np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b)]
        i = j = 0
        listed, ga, gb = [], [], []
        while i < len(a) or j < len(b):
            at_a, at_b = (ends[0][i] if i < len(a) else 1 << 60), (ends[1][j] if j < len(b) else 1 << 60)
            row["links"].append((a[i], b[j]))
            if at_a <= at_b:
                ga.append(a[i])
                i += 1
            if at_b <= at_a:
                gb.append(b[j])
                j += 1
            if at_a == at_b:
                listed.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                row["n_shared"] += len(ga) * len(gb)
                ga, gb = [], []
        row.update(n_a=len(a), n_b=len(b), n_groups=len(listed), sha=hashlib.sha256(";".join(listed).encode()).hexdigest())
        count.update(row["links"])
    top = Counter()
    for (_, y), c in count.items():
        top[y] = max(top[y], c)
    return [(r["n_a"], r["n_b"], r["n_groups"], len(r["links"]), sum(count[x] == top[x[1]] for x in r["links"]),
             sum(count[x] for x in r["links"]), r["sha"], r["n_shared"]) for r in rows]


COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]


@pytest.mark.parametrize("chunk_chars, known", [(1 << 22, 300_000), (2000, 50)])
def test_equals_brute_force(spark, tmp_path, real_texts, edge_docs, monkeypatch, chunk_chars, known):
    monkeypatch.setattr(al, "KNOWN_UNITS", known)
    monkeypatch.setattr(al, "PART_CHARS", 3000)
    rows = [(i, t) for i, t in enumerate(ODD + list(real_texts.values())[:60])]
    rows += [(x["doc_id"], x["text"]) for x in edge_docs.select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' chunk", "'x' a", "'x' groups", "'x' payload")
    chunks = al.align(docs.repartition(3), A, B, chunk_chars)
    got = al.scores(chunks, al.pair_counts(chunks)).collect()
    want = [(d, *r) for (d, _), r in zip(rows, brute([t for _, t in rows]))]
    assert Counter((r["doc_id"], *(r[c] for c in COLS)) for r in got) == Counter(want)


def test_query_and_groups_of_real_texts(spark, real_docs):
    got = {r["doc_id"]: r for r in queries()["op11_tokenizer_alignment"](spark, "/root/testdata/sf0.001").collect()}
    texts = {r["doc_id"]: r["text"] for r in real_docs.collect()}
    want = dict(zip(texts, brute(texts.values())))
    assert {d: tuple(r[c] for c in COLS) for d, r in got.items()} == want
    for r in al.groups(real_docs, A, B).collect():
        assert (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") == got[r["doc_id"]]["groups_sha256"]


def test_empty_table(spark, empty_docs):
    chunks = al.align(empty_docs, A, B)
    assert al.scores(chunks, al.pair_counts(chunks)).count() == 0
    assert al.groups(empty_docs, A, B).count() == 0
