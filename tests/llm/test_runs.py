import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tagweave.llm import runs as r
from tagweave.llm.queries import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(w):
    return next(p for p in range(1, len(w) + 1) if all(w[i] == w[i + p] for i in range(len(w) - p)))


def brute(w, least):
    """All maximal stretches by trying every period at every place."""
    out, n = set(), len(w)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            e = i + p
            if e - s >= max(least, 2 * p) and smallest_period(w[s:e]) == p:
                out.add((s, e, p))
    return sorted(out, key=lambda x: (x[0], x[2]))


def kept_words(w, found):
    gone = {i for s, e, p in found for i in range(s + p, e)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sequences(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n, k = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 6])
        w = [rng.randint(0, k) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 4:
                a, p = rng.randrange(n), rng.randint(1, 9)
                for i in range(a + p, min(n, a + p * rng.randint(2, 8))):
                    w[i] = w[i - p]
        yield w


@pytest.mark.parametrize("least", [2, 4, 6, 12, 15])
def test_all_runs_of_many_sequences(least):
    many = list(sequences(least))
    counts = np.array([len(w) for w in many])
    got = r.find_runs(np.array([x for w in many for x in w], dtype=np.int64), counts, least)
    begins = np.cumsum(counts) - counts
    want = [(int(b) + s, int(b) + e, p) for b, w in zip(begins, many) for s, e, p in brute(w, least)]
    assert [tuple(x) for x in got.tolist()] == want


def test_long_periodic_and_constant_sequences(monkeypatch):
    monkeypatch.setattr(r, "CHECKS", 1000)
    a = list(range(300)) * 40
    b = [7] * 20_000
    found = r.find_runs(np.array(a + b), np.array([len(a), len(b)]))
    assert found.tolist() == [[0, 12_000, 300], [12_000, 32_000, 1]]


def test_fibonacci_word_has_every_run():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    got = r.find_runs(np.array(b), np.array([len(b)]), 4)
    assert [tuple(x) for x in got.tolist()] == brute(b, 4)


def test_least_depth_covers_shorter_periods():
    for m in range(2, 60):
        d = r.least_depth(m)
        assert all(any(x % q == 0 for x in range(d, max(1, m // 2) + 1)) for q in range(1, d))
    assert r.least_depth(12) == 4


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    return w


def expected(doc_id, text):
    w = planted(doc_id, text)
    found = brute(w, 12)
    best = min(found, key=lambda x: (x[0] - x[1], x[0], x[2]), default=None)
    lines = "".join(f"{s},{e - s},{p}\n" for s, e, p in found)
    top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept_words(w, found).encode()).hexdigest())


def test_query_equals_brute_force(spark, tmp_path, edge_docs):
    rows = [(i, " ".join(map(str, w))) for i, w in enumerate(sequences(99))]
    rows += [(x["doc_id"], x["text"]) for x in edge_docs.select("doc_id", "text").collect() if len(x["text"] or "") < 5000]
    rows += [(1000 + i, f"tab\tand  blanks \n{'la li lu ' * i}\x0bend of é😀") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, (tuple(x[c] for c in cols) for x in got))) == sorted(map(str, (expected(*x) for x in rows)))


def test_edges_and_real_texts(spark, edge_docs, empty_docs, real_docs):
    assert r.periodic_runs(empty_docs).count() == 0
    out = r.periodic_runs(edge_docs).collect()
    assert len(out) == edge_docs.count()
    assert all(x["collapsed"] == "" and not x["runs"] for x in out if x["n_words"] == 0)
    whole = r.periodic_runs(real_docs.where("doc_id < 40")).collect()
    texts = {x["doc_id"]: x["text"] for x in real_docs.where("doc_id < 40").collect()}
    for x in whole:
        w = WORD.findall(texts[x["doc_id"]])
        found = brute(w, 12) if len(w) < 800 else None
        if found is not None:
            assert [(y["start"], y["start"] + y["length"], y["period"]) for y in x["runs"]] == found
            assert x["collapsed"] == kept_words(w, found)


def test_one_pass_without_shuffle(real_docs):
    plan = r.periodic_runs(r.with_planted_repeats(real_docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1
