import hashlib
import sys
from collections import Counter
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as cp  # noqa: E402

from tagweave.llm import decontaminate, pii, simhash  # noqa: E402

from .test_bpe import ENC  # noqa: E402
from .test_decontaminate import slow_tiles  # noqa: E402
from .test_pii import brute as spans_of  # noqa: E402
from .test_quality import brute as measures  # noqa: E402
from .test_simhash import slow_components  # noqa: E402


def accepted(text):
    n, chars, symbols, dup, repeat = measures(text)
    text = text or ""
    if n < 50 or 100 * repeat > 50 * n or 10 * symbols > n:
        return False
    lines = sum(1 for x in text.split("\n") if x.strip(" \t\r\v\f"))
    words = text.encode().split()
    alpha = sum(1 for w in words if any(c >= 0x80 or chr(c).isalpha() for c in w))
    soft = [10 * dup > 3 * lines, 10 * text.count("!") > 3 * n,
            sum("A" <= c <= "Z" for c in text) > sum("a" <= c <= "z" for c in text), 10 * alpha < 8 * n,
            chars > 15 * n or chars < 2 * n]
    return sum(soft) <= 1


def masked(text):
    out, at = [], 0
    for k, a, b in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if b > at:
            out += [text[at:a], f"[{pii.KINDS[k].upper()}]"] if a >= at else []
            at = b
    return "".join([*out, text[at:]])


def slow_run(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = sorted((d for d in docs if accepted(d[1])), key=lambda d: d[0])
    root = slow_components(np.array([simhash.fingerprint(t) for _, t in docs], dtype=np.uint64))
    docs = [d for i, d in enumerate(docs) if root[i] == i]
    items = [decontaminate.words_of(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = []
    for doc_id, text in docs:
        words = decontaminate.words_of(text)
        grams = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        bad = False
        for w in items:
            if any(tuple(w[i:i + 5]) in grams for i in range(len(w) - 4)):
                covered = {i + k for i in range(len(w) - 4) if tuple(w[i:i + 5]) in grams for k in range(5)}
                few = len(covered) < 0.5 * len(w)  # tiles cover no more than the shared seeds do
                bad = bad or not few and sum(t[2] for t in slow_tiles(w, words, 5)) >= 0.5 * len(w)
        if not bad:
            kept.append((doc_id, masked(text)))
    out = Counter()
    for doc_id, text in kept:
        ids = ENC.encode_ordinary(text)
        out[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def test_run_matches_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = cp.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == slow_run(spark, sf_dir)
    assert all(len(r["ids"]) == r["n_tokens"] for r in got)


def test_stages_keep_columns_on_odd_and_empty_tables(spark, edge_docs, empty_docs):
    sf_dir = "/root/testdata/sf0.001"
    for docs in (edge_docs, empty_docs):
        for _, stage in cp.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
            assert stage(spark, docs, sf_dir).count() <= docs.count()
        assert cp.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
