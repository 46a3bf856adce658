"""Language labels of words by a linear-chain conditional random field.

Every word of a text gets a language label distribution: its emission sums
learned weights of its affixes, character n-grams and (for words seen in
training) the word itself, learned transitions tie neighbours together, and
forward-backward gives the marginals, so code-switched text gets several
languages.  A text's prediction is the language with the largest summed
marginal, its score that share.

``fit`` trains in numpy on a bounded sample, all bounds parameters:
``DOCS_PER_LANG`` training documents of each language (smallest id hashes), cut
into segments of ``SEGMENT`` words, of which ``SEGMENTS_PER_LANG`` are taken.
Training sequences chain segments of different languages, which is what teaches
the transitions.  Prediction reads whole texts and only the text.

Defined results: a null text or one without a letter is ``und`` with score 0;
repeated rows each get their own; rows with a null lang, or in the held-out
fold, are never learned from; with nothing to learn from every text is ``und``;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import fold_of, small_batches, written

HELD_OUT = 2
DOCS_PER_LANG = 400
SEGMENT = 16
SEGMENTS_PER_LANG = 2500
MIN_LEXICON = 2       # occurrences in the sample that make a word a lexicon word
BUCKETS = 1 << 17     # hashed features
GRAMS = (1, 2, 3, 4)
EPOCHS = 3
SWITCH = 0.3          # chance that the next training segment changes its language
KNOWN_WORDS = 400_000  # a worker's word scores start anew beyond this number (about 60 MB)
PART_CHARS = 4 << 20
LANES = 1024          # texts that forward-backward handles at once
_WORD = re.compile(r"[^\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return [w for w in _WORD.findall((text or "").lower()) if w.isalpha() or any(c.isalpha() for c in w)]


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Flat feature numbers of all words, and the word each belongs to.

    N-grams run over the word with a mark at both ends; those that hold a mark
    are its affixes.  Lexicon words have a feature of their own after the
    hashed ones.
    """
    marked = "".join(f"\x02{w}\x03" for w in words)
    cp = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    numbers, owners = [], []
    h = np.zeros(len(cp), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(GRAMS) + 1):
            h = (h[:len(cp) - n + 1] if n > 1 else h) * np.uint64(0x100000001B3) + cp[n - 1:]
            if n not in GRAMS:
                continue
            inside = owner[:len(h)] == owner[n - 1:]
            if n == 1:
                inside &= (cp != 2) & (cp != 3)
            mixed = ((h[inside] + np.uint64(n)) * _MIX) >> np.uint64(40)
            numbers.append((mixed % np.uint64(BUCKETS)).astype(np.int64))
            owners.append(owner[:len(h)][inside])
    own = [(BUCKETS + lexicon[w], i) for i, w in enumerate(words) if w in lexicon]
    if own:
        numbers.append(np.array([x for x, _ in own], dtype=np.int64))
        owners.append(np.array([i for _, i in own], dtype=np.int64))
    if not numbers:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(numbers), np.concatenate(owners)


@dataclass
class Model:
    langs: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray = field(repr=False)      # features x languages
    transitions: np.ndarray = field(repr=False)  # languages x languages, log scale

    def __post_init__(self):
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.empty((1 << 12, len(self.langs)))

    def remembered(self, words: list[str]) -> np.ndarray:
        """:meth:`emissions` of distinct words; a worker computes each word once while it remembers it."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        new = [w for w in words if w not in self.known]
        if new:
            n = len(self.known)
            while n + len(new) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
            self.scores[n:n + len(new)] = self.emissions(new)
            self.known.update(zip(new, range(n, n + len(new))))
        return self.scores[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log-scale scores, words x languages."""
        number, owner = features(words, self.lexicon)
        out = np.empty((len(words), len(self.langs)))
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(owner, self.weights[number, k], len(words))
        return out


def forward_backward(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Marginals of sequences laid out one after another in ``emissions`` (words x labels, log scale).

    Also the summed label-pair marginals if ``pairs``.  ``LANES`` sequences of
    similar length go through the recursions side by side.
    """
    begins = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    e = np.exp(emissions - emissions.max(axis=1, keepdims=True)) if len(emissions) else emissions
    t = np.exp(transitions)
    out = np.zeros_like(emissions)
    both = np.zeros_like(transitions)
    for at in range(0, len(order), LANES):
        lanes = order[at:at + LANES]
        begin, length = begins[lanes], lengths[lanes]
        top = int(length[0])
        alive = np.searchsorted(-length, -np.arange(top), side="left")  # lanes longer than t, a prefix
        row = np.r_[0, np.cumsum(alive)]  # step i has a row for each living lane: as many rows as words
        alpha = np.empty((int(row[-1]), e.shape[1]))
        a = e[begin]
        alpha[:len(lanes)] = a = a / a.sum(axis=1, keepdims=True)
        for i in range(1, top):
            n = alive[i]
            a = (a[:n] @ t) * e[begin[:n] + i]
            a /= a.sum(axis=1, keepdims=True)
            alpha[row[i]:row[i + 1]] = a
        beta = np.ones((len(lanes), e.shape[1]))
        for i in range(top - 1, -1, -1):
            n = alive[i]
            if i < top - 1:
                m = alive[i + 1]
                eb = e[begin[:m] + i + 1] * beta[:m]
                if pairs:
                    joint = alpha[row[i]:row[i] + m, :, None] * t[None] * eb[:, None, :]
                    both += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b = eb @ t.T
                beta[:m] = b / b.sum(axis=1, keepdims=True)
            g = alpha[row[i]:row[i + 1]] * beta[:n]
            out[begin[:n] + i] = g / g.sum(axis=1, keepdims=True)
    return (out, both) if pairs else out


def train(segments: list[tuple[str, list[str]]], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """A model from (language, words) segments; conditional likelihood by AdaGrad over code-switched chains."""
    langs = sorted({lang for lang, _ in segments})
    number = {lang: i for i, lang in enumerate(langs)}
    seen = Counter(w for _, words in segments for w in words)
    lexicon = {w: i for i, w in enumerate(sorted(w for w, n in seen.items() if n >= MIN_LEXICON))}
    k = len(langs)
    model = Model(langs, lexicon, np.zeros((BUCKETS + len(lexicon), k)), np.zeros((k, k)))
    vocabulary = {w: i for i, w in enumerate(seen)}
    f_number, f_owner = features(list(vocabulary), lexicon)
    by_word = np.argsort(f_owner, kind="stable")
    f_number = f_number[by_word]
    f_begin = np.searchsorted(f_owner[by_word], np.arange(len(vocabulary) + 1))
    by_lang = [[np.array([vocabulary[w] for w in words]) for lang, words in segments if lang == x] for x in langs]
    rng = np.random.default_rng(seed)
    g_w, g_t = np.full_like(model.weights, 1e-6), np.full_like(model.transitions, 1e-6)
    chains = max(1, len(segments) // 4)
    for _ in range(epochs):
        for start in range(0, chains, 64):
            seq, gold, lengths = [], [], []
            for _ in range(min(64, chains - start)):
                lang, n = int(rng.integers(k)), 0
                for _ in range(4):
                    words = by_lang[lang][int(rng.integers(len(by_lang[lang])))]
                    seq.append(words)
                    gold.append(np.full(len(words), lang))
                    n += len(words)
                    if rng.random() < SWITCH:
                        lang = int(rng.integers(k))
                lengths.append(n)
            seq, gold, lengths = np.concatenate(seq), np.concatenate(gold), np.array(lengths)
            counts = f_begin[seq + 1] - f_begin[seq]
            total = np.cumsum(counts)
            owner = np.repeat(np.arange(len(seq)), counts)
            flat = f_number[np.repeat(f_begin[seq] - (total - counts), counts) + np.arange(int(total[-1]))]
            emissions = np.stack([np.bincount(owner, model.weights[flat, j], len(seq)) for j in range(k)], axis=1)
            marginal, both = forward_backward(emissions, lengths, model.transitions, pairs=True)
            slope = marginal.copy()
            slope[np.arange(len(seq)), gold] -= 1
            ends = np.zeros(len(seq), dtype=bool)
            ends[np.cumsum(lengths) - 1] = True
            inner = np.flatnonzero(~ends)
            np.subtract.at(both, (gold[inner], gold[inner + 1]), 1)
            used, place = np.unique(flat, return_inverse=True)
            grad = np.stack([np.bincount(place, slope[owner, j], len(used)) for j in range(k)], axis=1) / len(lengths)
            both /= len(lengths)
            g_w[used] += grad ** 2
            g_t += both ** 2
            model.weights[used] -= 0.2 * grad / np.sqrt(g_w[used])
            model.transitions -= 0.2 * both / np.sqrt(g_t)
    return model


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, parts = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            for i in range(0, len(words), SEGMENT):
                langs.append(lang)
                parts.append(words[i:i + SEGMENT])
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.list_(pa.string()))],
                                         ["lang", "words"])


def fit(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, segments_per_lang: int = SEGMENTS_PER_LANG) -> Model | None:
    """A model from the training fold of ``docs`` (doc_id, text, lang); None if it has nothing to learn from."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang").where(
        (fold_of(F.col("doc_id")) != HELD_OUT) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # Both rankings take all languages at once; the first is cut to its ranks in the map tasks.
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = rows.select("lang", "doc_id").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= docs_per_lang)
    ids = F.broadcast(written(ids.select("doc_id"), "lang-ids"))  # at most docs_per_lang ids a language
    sample = written(rows.join(ids, "doc_id").select("lang", "text").mapInArrow(
        _segments, "lang string, words array<string>"), "lang-segments")
    shuffled = Window.partitionBy("lang").orderBy(F.xxhash64("words"), "words")
    some = sample.withColumn("rank", F.row_number().over(shuffled)).where(F.col("rank") <= segments_per_lang)
    segments = [(r["lang"], r["words"]) for r in some.orderBy("lang", "rank").collect()]
    return train(segments) if segments else None


def label_words(model: Model, texts: list[str | None]) -> list[tuple[list[str], np.ndarray]]:
    """The words of each text with their label marginals (words x languages)."""
    words = [words_of(t) for t in texts]
    number: dict[str, int] = {}
    seq = np.array([number.setdefault(w, len(number)) for ws in words for w in ws], dtype=np.int64)
    lengths = np.array([len(ws) for ws in words], dtype=np.int64)
    if not len(seq):
        return [(ws, np.zeros((0, len(model.langs)))) for ws in words]
    marginal = forward_backward(model.remembered(list(number))[seq], lengths, model.transitions)
    ends = np.cumsum(lengths)
    return [(ws, marginal[e - n:e]) for ws, e, n in zip(words, ends.tolist(), lengths.tolist())]


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value

        for batch in small_batches(batches, "text", PART_CHARS):
            pred, score, shares = [], [], []
            texts = batch.column("text").to_pylist()
            for words, marginal in (label_words(model, texts) if model else [([], None)] * len(texts)):
                if not words:
                    pred.append("und")
                    score.append(0.0)
                    shares.append(0)
                    continue
                mean = marginal.mean(axis=0)
                best = int(mean.argmax())
                pred.append(model.langs[best])
                score.append(min(1.0, float(mean[best])))
                shares.append(len(np.unique(marginal.argmax(axis=1))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(shares, pa.int32())], ["doc_id", "lang_pred", "score", "n_langs"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_langs (labels among its words) of every row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _predict(shared), "doc_id long, lang_pred string, score double, n_langs int")
    return out.select("doc_id", (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"), "lang_pred", "score", "n_langs")
