"""Toxicity scores by non-negative positive-unlabelled learning.

``fit`` takes confirmed toxic documents and unlabelled ones and trains a linear
logistic model in numpy under the class-prior-corrected risk

    pi * R_P(+) + max(0, R_U(-) - pi * R_P(-))

where a negative inner part is stepped back instead of down (so the flexible
model cannot drive the estimate below zero).  Features are the distinct words
of a text; a word becomes a feature if confirmed toxic texts hold it more often
than all training text does, counted over every training document and every
distinct confirmed toxic training text.

Bounds of the fit, all parameters: ``MAX_POSITIVE`` and ``MAX_UNLABELLED``
sampled training documents (smallest id hashes); the words are all that stand out.
Counts cover all rows and scoring covers every row and whole texts.

Defined results: null and empty texts get the score of a text without any
feature; repeated label rows count once per id (the largest label), null labels
never; without a confirmed toxic document every score is 0; repeated rows each
get their own score; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import fold_of, small_batches, written

MAX_POSITIVE = 4000
MAX_UNLABELLED = 12000
MIN_TOXIC_TEXTS = 5   # confirmed toxic texts that hold a feature word
MIN_Z = 4.0           # how far above the training corpus its share must lie
HELD_OUT = 2
THRESHOLD = 0.3
ROUNDS = 400
L2 = 1e-3
PART_CHARS = 1 << 20
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> set[str]:
    """The distinct words of a text, lower-cased."""
    return set(_WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, words: set[str]) -> float:
        f = self.bias + sum(self.weights[w] for w in self.weights.keys() & words)
        return float(1.0 / (1.0 + np.exp(-np.clip(f, -40, 40)))) if self.bias > -np.inf else 0.0


def slopes(f: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The part of the risk that negatives would have, and the step direction by each row's score ``f``.

    The risk is prior * mean l(+) of positives plus that part, mean l(-) of unlabelled
    rows less prior * mean l(-) of positives.  Where the part is negative, which no
    true risk is, the step takes it back up instead.
    """
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    s = 1.0 / (1.0 + np.exp(-f))
    # Logistic loss: l(+) = softplus(-f), slope s - 1; l(-) = softplus(f), slope s.
    inner = np.logaddexp(0.0, f[~positive]).sum() / n_u - prior * np.logaddexp(0.0, f[positive]).sum() / n_p
    up = np.where(positive, prior * (s - 1) / n_p, 0.0)
    down = np.where(positive, -prior * s / n_p, s / n_u)
    return float(inner), (up + down if inner >= 0 else -down)


def train(rows: list[tuple[bool, list[int]]], n_features: int, prior: float,
          rounds: int = ROUNDS, l2: float = L2) -> tuple[np.ndarray, float]:
    """Weights and bias from (is confirmed toxic, feature numbers) rows."""
    positive = np.array([p for p, _ in rows], dtype=bool)
    row = np.repeat(np.arange(len(rows)), [len(x) for _, x in rows])
    col = np.array([i for _, x in rows for i in x], dtype=np.int64)
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, rounds + 1):
        _, g = slopes(b + np.bincount(row, w[col], len(rows)), positive, prior)
        grad = np.r_[np.bincount(col, g[row], n_features) + l2 * w, g.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each word, summed over a whole task part before anything is shuffled."""
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          ["word", "n"])

    for batch in batches:
        for text in batch.column("text"):
            counts.update(words_of(text.as_py()))
            if len(counts) > 400_000:
                yield out()
                counts.clear()
    if counts:
        yield out()


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [sorted(words_of(t.as_py())) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("role"), batch.column("doc_id"), batch.column("text_hash"),
                                          pa.array(words, pa.list_(pa.string()))], ["role", "doc_id", "text_hash", "words"])


def _with_words(rows: DataFrame, name: str) -> DataFrame:
    return written(rows.mapInArrow(_distinct_words, "role string, doc_id long, text_hash long, words array<string>"), name)


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """word and, as ``name``, the number of ``rows`` whose text holds it."""
    return rows.select("text").mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias(name))


def feature_words(toxic: DataFrame, rows: DataFrame) -> DataFrame:
    """(word, z): every word whose share of the ``toxic`` texts lies far enough above its share of all ``rows``.

    Words in few toxic texts, or of like shares, never get this far: what comes back
    is the toxic vocabulary, which is also what the model holds.
    """
    n_toxic, n_rows = toxic.count(), rows.count()
    in_toxic = _counted(toxic, "p").where(F.col("p") >= MIN_TOXIC_TEXTS)
    share = (F.col("p") + F.col("u")) / (n_toxic + n_rows)
    z = (F.col("p") / n_toxic - F.col("u") / n_rows) / F.sqrt(share * (1 - share) * (1.0 / n_toxic + 1.0 / n_rows))
    return in_toxic.join(_counted(rows, "u"), "word").select("word", z.alias("z")).where(F.col("z") >= MIN_Z)


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
        max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """A model from all rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) outside the held-out fold."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text").where(fold_of(F.col("doc_id")) != HELD_OUT)
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(
        (fold_of(F.col("doc_id")) != HELD_OUT) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    if prior <= 0.0:
        return Model({}, float("-inf"))
    prior = min(prior, 0.99)

    order = F.xxhash64("doc_id")
    # Copies of one toxic text are one piece of evidence; every distinct text counts.
    toxic_ids = written(known.where("toxic = 1").select("doc_id"), "tox-known")
    toxic = written(rows.join(toxic_ids, "doc_id", "left_semi").groupBy(F.xxhash64("text").alias("text_hash")).agg(
        F.min(order).alias("place"), F.first("text").alias("text")), "tox-texts")
    if toxic.isEmpty():
        return Model({}, float("-inf"))
    words = [r["word"] for r in feature_words(toxic, rows).orderBy(F.desc("z"), "word").collect()]
    features = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, i int")

    # The rows of the fit: bounded broadcasts of ids and hashes.  Repeated rows are one document.
    ids = F.broadcast(written(rows.select("doc_id").where("doc_id is not null").distinct().orderBy(
        order, "doc_id").limit(max_unlabelled), "tox-ids"))
    near = rows.join(ids, "doc_id").select(F.lit("U").alias("role"), "doc_id", F.xxhash64("text").alias("text_hash"),
                                           "text").dropDuplicates(["doc_id", "text_hash"])
    near = _with_words(near, "tox-sample")
    # An id may have several texts; the bound is on (id, text).
    within = near.select("doc_id", "text_hash").orderBy(order, "doc_id", "text_hash").limit(max_unlabelled)
    unlabelled = near.join(F.broadcast(within), ["doc_id", "text_hash"])
    some_toxic = toxic.select("text_hash", "place").orderBy("place", "text_hash").limit(max_positive).select("text_hash")
    positive = _with_words(toxic.join(F.broadcast(some_toxic), "text_hash").select(
        F.lit("P").alias("role"), F.lit(None).cast("long").alias("doc_id"), "text_hash", "text"), "tox-positive")

    # Only feature numbers of the bounded sample come to the driver.
    used = unlabelled.unionByName(positive).select("role", "text_hash", F.monotonically_increasing_id().alias("r"), "words")
    used = written(used, "tox-used")
    hit = used.select("r", F.explode("words").alias("word")).join(F.broadcast(features), "word").groupBy("r").agg(
        F.array_sort(F.collect_list("i")).alias("hits"))
    # Sorted, so that a fit adds its numbers in one order.
    table = sorted(used.select("r", "role", "text_hash").join(hit, "r", "left").collect(),
                   key=lambda r: (r["role"], r["text_hash"]))
    w, b = train([(r["role"] == "P", r["hits"] or []) for r in table], len(words), prior)
    return Model(dict(zip(words, w.tolist())), b)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", PART_CHARS):
            scores = [model.value.score(words_of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_score(shared), "doc_id long, score double")
    return out.select("doc_id", (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
