import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tagweave.llm import toxicity as tox

SF = "/root/testdata/sf0.1"


def test_risk_stays_corrected():
    """With the class prior known, unlabelled positives are recovered."""
    rng = np.random.default_rng(1)
    rows = [(True, [0] if rng.random() < 0.8 else [1]) for _ in range(300)]
    rows += [(False, [0] if rng.random() < 0.16 else [2]) for _ in range(3000)]  # a fifth of them toxic
    w, b = tox.train(rows, 3, 0.2)
    score = 1 / (1 + np.exp(-(w + b)))
    assert score[0] > 0.8 and score[2] < 0.2


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = tox.fit(docs, labels)
    out = tox.scores(docs, model).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in out)
    assert hit / sum(r["toxic"] == 1 for r in out) > 0.7
    assert sum(r["predicted"] == 1 and r["toxic"] == 0 for r in out) <= 0.01 * len(out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                               1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tox.fit(docs, labels), tox.fit(docs, turned)
    assert a.bias == b.bias and a.weights == b.weights


def test_sample_bound_counts_documents(spark, monkeypatch):
    """Repeated rows and many texts of one id neither fill the sample nor exceed its bound."""
    docs = [(i, f"plain text number {i}") for i in range(60)] + [(i, f"vile slur {i}") for i in range(100, 130)]
    docs = [r for r in docs for _ in range(20)] + [(7, f"other text {i}") for i in range(50)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i in [*range(30), *range(100, 130)]], "doc_id long, toxic int")
    seen, train = [], tox.train
    monkeypatch.setattr(tox, "train", lambda rows, *a: seen.append(rows) or train(rows, *a))
    tox.fit(docs, labels, max_positive=10, max_unlabelled=40)
    tox.fit(docs, labels, max_unlabelled=10_000)
    one, two = seen
    assert sum(p for p, _ in one) <= 10 and sum(not p for p, _ in one) == 40
    n_ids = docs.where(tox.fold_of(F.col("doc_id")) != tox.HELD_OUT).distinct().count()
    assert sum(not p for p, _ in two) == n_ids


def test_toxic_counts_cover_all_texts(spark):
    """A word of few confirmed toxic texts is a feature however small the sample; copies of a text count once."""
    train = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != tox.HELD_OUT]
    toxic, clean = train[:400], train[400:2400]
    docs = [(i, f"vile slur number{i}" + (" rareword" if n >= 380 else "")) for n, i in enumerate(toxic)]
    docs += [(i, f"plain words number{i}") for i in clean]
    docs += [(i, "vile copied") for i in train[2400:2420]]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in [*toxic, *train[2400:2420]]] + [(i, 0) for i in clean[:400]],
                                   "doc_id long, toxic int")
    model = tox.fit(docs, labels, max_positive=40)
    assert set(model.weights) == {"vile", "slur", "rareword"}


def test_edges(spark, edge_docs, empty_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in tox.scores(edge_docs, tox.fit(edge_docs, none)).collect()} == {0.0}
    odd = spark.createDataFrame([(4, 1, 1), (4, None, 0), (None, 0, 1), (3, 0, None), (3, 0, 0), (5, 1, 0)],
                                "doc_id long, quality int, toxic int")
    model = tox.fit(edge_docs, odd)
    out = tox.scores(edge_docs, model)
    assert out.count() == edge_docs.count() and out.where("score is null or score < 0 or score > 1").count() == 0
    assert tox.scores(empty_docs, model).count() == 0 and tox.fit(empty_docs, none).bias == float("-inf")


def test_step_is_the_gradient_of_the_corrected_risk():
    """Finite differences of the risk where the negative part is one, of minus that part where it is below zero."""
    rng = np.random.default_rng(3)
    positive = rng.random(40) < 0.4
    seen = set()
    for shift, prior in ((0.0, 0.2), (-6.0, 0.6), (4.0, 0.5), (-3.0, 0.9)):
        f = rng.normal(size=40) + np.where(positive, -shift, shift)

        def parts(x):
            lo = np.logaddexp(0, x)
            hi = np.logaddexp(0, -x)
            inner = lo[~positive].mean() - prior * lo[positive].mean()
            return prior * hi[positive].mean(), inner

        inner, step = tox.slopes(f, positive, prior)
        assert np.isclose(inner, parts(f)[1])
        seen.add(inner >= 0)
        for i in range(40):
            d = np.zeros(40)
            d[i] = 1e-5
            up, down = parts(f + d), parts(f - d)
            want = (sum(up) - sum(down)) if inner >= 0 else (down[1] - up[1])
            assert np.isclose(step[i], want / 2e-5, atol=1e-6)
    assert seen == {True, False}


def test_feature_words_equal_plain_counts(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary[:40], 12)) for _ in range(400)] + [" ".join(rng.choice(vocabulary[20:], 6)) for _ in range(90)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    toxic = spark.createDataFrame([(t,) for t in sorted(set(texts[400:]))], "text string")
    p, u = Counter(), Counter()
    for t in set(texts[400:]):
        p.update(tox.words_of(t))
    for t in texts:
        u.update(tox.words_of(t))
    n_p, n_u = len(set(texts[400:])), len(texts)
    want = {}
    for w in p:
        share = (p[w] + u[w]) / (n_p + n_u)
        z = (p[w] / n_p - u[w] / n_u) / (share * (1 - share) * (1 / n_p + 1 / n_u)) ** 0.5
        if p[w] >= tox.MIN_TOXIC_TEXTS and z >= tox.MIN_Z:
            want[w] = z
    got = {r["word"]: r["z"] for r in tox.feature_words(toxic, rows).collect()}
    assert got.keys() == want.keys() and len(want) > 5
    assert all(np.isclose(got[w], want[w]) for w in want)


def test_no_word_that_stands_out_is_left_out(spark):
    """Far more toxic words than any fixed number of places."""
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != tox.HELD_OUT]
    many = " ".join(f"slur{k}" for k in range(7000))
    docs = spark.createDataFrame([(i, many if n % 2 else f"plain{n}") for n, i in enumerate(train)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "if(text like 'slur%', concat(text, ' t', doc_id), text) text")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(train)], "doc_id long, toxic int")
    assert len(tox.fit(docs, labels).weights) == 7000
