from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tagweave.llm import simhash as s


def slow_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values):
    f = np.array(values, dtype=np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 3
    root = np.arange(len(f))
    while True:
        new = np.where(near, root[None, :], len(f)).min(axis=1)
        if np.array_equal(new, root):
            return root
        root = new


def planted(seed, n_far=300, n_near=400):
    """Random fingerprints, plus chains of near ones around a few centres."""
    rng = np.random.default_rng(seed)
    out = rng.integers(0, 1 << 63, n_far, dtype=np.uint64).tolist()
    for _ in range(4):
        at = int(rng.integers(0, 1 << 63))
        for _ in range(n_near // 4):
            for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
                at ^= 1 << int(b)
            out.append(at)
    return list(dict.fromkeys(out))


def test_fingerprints(real_texts, edge_docs):
    for text in [*list(real_texts.values())[:40], *(r["text"] for r in edge_docs.collect() if len(r["text"] or "") < 2000)]:
        assert s.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("segments,tile", [(None, s.TILE), (4, 8), (5, 16), (6, s.TILE)])
def test_components_are_exact_for_any_tiling(spark, segments, tile):
    values = planted(3)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    docs = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in s.classes(docs, segments=segments, tile=tile).collect()}
    want = slow_components(values)
    assert [got[i] for i in range(len(values))] == want.tolist()


def test_large_blocks_and_forest():
    values = np.array(planted(9, 500, 2400), dtype=np.uint64)
    values = values[np.argsort(np.bitwise_count(values), kind="stable")]
    key, side = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    a, b = s._compare(key, side, values, 3)
    root = slow_components(values.tolist())
    at = {v: i for i, v in enumerate(values.tolist())}
    assert len(a) == len(values) - len(set(root.tolist()))  # a spanning forest, not all pairs
    assert all(root[at[x]] == root[at[y]] for x, y in zip(a.tolist(), b.tolist()))


def test_near_duplicates_and_edges(spark, real_docs, real_texts, edge_docs, empty_docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in s.near_duplicates(real_docs).collect()}
    ids = sorted(real_texts)
    values = [s.fingerprint(real_texts[i]) for i in ids]
    root = slow_components(values)
    assert got == {i: (f"{v:016x}", ids[r]) for i, v, r in zip(ids, values, root)}
    out = s.near_duplicates(edge_docs).collect()
    assert len(out) == edge_docs.count()
    zero = [r for r in out if r["fingerprint"] == "0" * 16]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {0}
    assert s.near_duplicates(empty_docs).count() == 0


def test_one_per_group(spark, edge_docs, empty_docs):
    kept = s.one_per_group(edge_docs)
    assert kept.columns == edge_docs.columns
    groups = s.classes(s.fingerprints(edge_docs)).select("root").distinct().count()
    assert kept.count() == groups
    assert Counter(r["doc_id"] for r in kept.where(F.col("text").startswith("Just a few")).collect()) == {4: 1}
    assert s.one_per_group(empty_docs).count() == 0
