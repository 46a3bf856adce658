import random

import pytest

from tagweave.llm import decontaminate as d


def slow_tiles(p, t, least):
    used_p, used_t, tiles = [False] * len(p), [False] * len(t), []
    while True:
        best, found = least - 1, []
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not used_p[i + k] and not used_t[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best and k >= least:
                    found.append((i, j))
        if not found:
            return tiles
        for i, j in found:
            if not any(used_p[i:i + best]) and not any(used_t[j:j + best]):
                tiles.append((i, j, best))
                used_p[i:i + best] = used_t[j:j + best] = [True] * best


@pytest.mark.parametrize("seed", range(4))
def test_tiles_match_plain_greedy_tiling(seed):
    rnd = random.Random(seed)
    for _ in range(300):
        p = [rnd.randint(1, 3) for _ in range(rnd.randint(1, 25))]
        t = [rnd.randint(1, 3) for _ in range(rnd.randint(1, 25))]
        got = d.greedy_tiles(p, t, 2)
        assert sum(x[2] for x in got) == sum(x[2] for x in slow_tiles(p, t, 2))
        assert all(p[i:i + n] == t[j:j + n] for i, j, n in got)


def test_rolling_hash_forms_agree():
    import numpy as np
    ids = np.array([random.Random(1).randint(0, 9) for _ in range(200)], dtype=np.uint64)
    long = d.window_hashes(ids, 12)
    same = {}
    for i, h in enumerate(long.tolist()):
        same.setdefault(h, set()).add(tuple(ids[i:i + 12].tolist()))
    assert all(len(v) == 1 for v in same.values()) and len(long) == 189


ITEMS = [(1, "One two three four five six seven eight nine ten, eleven twelve."),
         (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (3, "too short"), (None, None), (4, "")]
DOCS = [
    (10, "prefix words ONE two three four five six seven eight nine ten eleven twelve suffix"),
    (11, "seven eight nine ten eleven twelve and then one two three four five six"),          # reordered
    (12, "one two three four five only"), (13, "nothing to see here at all"), (14, None), (15, ""),
    (16, "too short"), (10, "prefix words ONE two three four five six seven eight nine ten eleven twelve suffix"),
]


def test_contaminated_pairs(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS + ITEMS[:1], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["n_tiles"], r["covered_words"], r["coverage"])
                 for r in d.contaminated_pairs(docs, items).collect())
    assert got == [(10, 1, 1, 12, 1.0), (10, 1, 1, 12, 1.0), (11, 1, 2, 12, 1.0)]
    assert sorted(r["doc_id"] for r in d.clean(docs, d.contaminated_pairs(docs, items)).collect()) == [12, 13, 14, 15, 16]


def test_blocks_of_the_benchmark_change_nothing(spark, real_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = sorted(map(tuple, d.overlaps(real_docs, items).collect()))
    assert one and one == sorted(map(tuple, d.overlaps(real_docs, items, block_chars=2000).collect()))
    texts = {r["doc_id"]: d.words_of(r["text"]) for r in real_docs.collect()}
    for item_id, text in items.collect():
        w = d.words_of(text)
        seeds = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        for doc_id, x in texts.items():
            if seeds & {tuple(x[i:i + 5]) for i in range(len(x) - 4)}:
                row = next(r for r in one if r[0] == doc_id and r[2] == item_id)
                assert row[5] == sum(t[2] for t in slow_tiles(w, x, 5)) if len(x) < 300 else row[5] >= 5


def test_edges(spark, edge_docs, empty_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.contaminated_pairs(empty_docs, items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    kept = d.clean(edge_docs, d.contaminated_pairs(edge_docs, none))
    assert kept.count() == edge_docs.count() and kept.columns == edge_docs.columns
    assert d.contaminated_pairs(edge_docs, items).count() == 0


def test_repeated_words_take_no_pair_of_places_at_a_time():
    import time
    began = time.time()
    tiles = d.greedy_tiles([1] * 100, [1] * 32_000)
    assert tiles == [(0, 0, 100)]
    tiles = d.greedy_tiles([1, 2] * 50, ([1, 2] * 30 + [3]) * 500)
    assert sum(x[2] for x in tiles) == 100
    assert time.time() - began < 5


def test_many_blocks_give_the_rows_of_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = sorted(map(str, d.overlaps(docs, items).collect()))
    assert one and sorted(map(str, d.overlaps(docs, items, block_chars=20_000).collect())) == one
