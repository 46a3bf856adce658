import itertools
from collections import Counter

import numpy as np

from tagweave.llm import langid as lang


def brute(e, t):
    n, k = e.shape
    out, total = np.zeros_like(e), 0.0
    for y in itertools.product(range(k), repeat=n):
        w = np.exp(sum(e[i, y[i]] for i in range(n)) + sum(t[y[i], y[i + 1]] for i in range(n - 1)))
        total += w
        for i in range(n):
            out[i, y[i]] += w
    return out / total


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    lengths = np.array([4, 0, 5, 1, 5])
    e, t = rng.normal(size=(int(lengths.sum()), 3)) * 2, rng.normal(size=(3, 3))
    got, both = lang.forward_backward(e, lengths, t, pairs=True)
    ends = np.cumsum(lengths)
    want = np.concatenate([brute(e[b - n:b], t) for b, n in zip(ends, lengths) if n])
    assert np.allclose(got, want)
    assert np.isclose(both.sum(), sum(max(0, n - 1) for n in lengths))
    # Pair marginals sum to the marginals of the left words.
    left = np.concatenate([np.arange(b - n, b - 1) for b, n in zip(ends, lengths) if n > 1])
    assert np.allclose(both.sum(axis=1), got[left].sum(axis=0))


def test_features_do_not_depend_on_neighbours():
    words = ["straße", "a", "naïve", "", "été"][:3]
    alone = [Counter(lang.features([w], {"a": 0})[0].tolist()) for w in words]
    number, owner = lang.features(words, {"a": 0})
    assert [Counter(number[owner == i].tolist()) for i in range(len(words))] == alone
    assert lang.BUCKETS in alone[1]


def test_held_out_accuracy_and_code_switching(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang.fit(docs)
    out = lang.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 150 and sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)
    (words, marginal), = lang.label_words(model, ["the thing with this is that le ouaux mentre pour les der und nicht die"])
    best = [model.langs[i] for i in marginal.argmax(axis=1)]
    assert best[0] == "en" and best[-1] == "de" and "fr" in best
    assert np.all(np.diag(model.transitions) > model.transitions.max(axis=1) - 1e-9)


def test_held_out_and_unlabelled_rows_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spoiled = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 4 = 2 then 'xx' else lang end lang",
                              "'src' source", "n_chars")
    a, b = lang.fit(docs), lang.fit(spoiled)
    assert a.langs == b.langs and np.array_equal(a.weights, b.weights)


def test_edges(spark, edge_docs, empty_docs):
    model = lang.fit(edge_docs)
    out = lang.predict(edge_docs, model)
    assert out.count() == edge_docs.count()
    und = {r["doc_id"] for r in out.where("lang_pred = 'und'").collect()}
    assert {0, 1, 2, 5, 8} <= und
    assert lang.fit(empty_docs) is None and lang.predict(empty_docs, None).count() == 0
    assert {r["lang_pred"] for r in lang.predict(edge_docs, None).collect()} == {"und"}


def test_one_long_text_beside_short_ones_takes_the_space_of_its_words():
    import tracemalloc
    lengths = np.array([20_000] + [3] * 120)
    e = np.random.default_rng(2).normal(size=(int(lengths.sum()), 4))
    t = np.eye(4)
    tracemalloc.start()
    got = lang.forward_backward(e, lengths, t)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * e.nbytes  # laid out by lanes it would take 120 times the words
    assert np.allclose(got[-3:], lang.forward_backward(e[-3:], np.array([3]), t))


def test_jobs_of_a_fit_do_not_grow_with_the_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    many = docs.selectExpr("doc_id", "text", "concat(lang, doc_id % 10) lang")
    sc = spark.sparkContext

    def jobs_of(df, name):
        sc.setJobGroup(name, name)
        lang.fit(df)
        n = len(sc.statusTracker().getJobIdsForGroup(name))
        sc.setLocalProperty("spark.jobGroup.id", None)
        return n

    assert jobs_of(many, "many") <= jobs_of(docs, "few") + 2
