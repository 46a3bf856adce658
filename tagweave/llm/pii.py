"""Personal data: strict patterns, and identifiers that their contexts give away.

``scan`` reads every text once.  It finds the strict spans (email, ip, card,
phone) and, as candidates, all other tokens with a digit or an at sign; each
strict span and candidate carries its lexical patterns, the words around it.
The strict spans are the first seeds of a bootstrap over the pattern-instance graph:

* a pattern's confidence for a kind is the summed score of its instances over
  their number (smoothed), if at least ``MIN_SEEDS`` different seeds support it;
* a candidate instance's score for a kind is the noisy-or of its patterns;
* an instance whose best score reaches ``INSTANCE_SCORE`` is accepted: a seed of
  that kind in the next round;
* all are grouped sums over the whole graph in Spark, repeated ``ROUNDS`` times,
  so patterns that a round discovers support further instances in the next.

Occurrences of an accepted instance next to a confident pattern become spans.
All aggregates combine map-side and all joins are on (pattern) or (instance)
keys that skew splitting can cut; nothing is collected.

Defined results: null and empty texts have no spans; repeated rows each get
their own; found spans never overlap strict ones; spans count code points, end
exclusive; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import cut, small_batches, whole_rows, written

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
MIN_SEEDS = 5        # different seed instances a pattern needs
SMOOTH = 1.0         # added to a pattern's number of instances
PATTERN_SCORE = 0.8  # confidence of a pattern that may discover
INSTANCE_SCORE = 0.8
PART_CHARS = 1 << 20

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9@._%+-]*+")
_MARK = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^\W\d_]+")
_EDGE = "._%+-"


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern, found from their at signs so that long runs cost linear time."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        start = at
        if m:
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, m.end()))
                end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def strict_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the strict patterns, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def _context(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a span: the two words before it, and the words on both sides."""
    before = _WORD.findall(text[max(0, start - 60):start].lower())[-2:]
    after = _WORD.findall(text[end:end + 40].lower())[:1]
    out = []
    if len(before) == 2:
        out.append("l:" + " ".join(before))
    if before and after:
        out.append(f"s:{before[-1]}|{after[0]}")
    return out


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens with a digit or at sign that no strict span touches."""
    taken = sorted((a, b) for _, a, b in spans)
    out, i, at = [], 0, 0
    while m := _MARK.search(text, at):
        # The token around the mark: back to its start, on to its end.
        start = m.start()
        while start > at and text[start - 1] in _LOCAL:
            start -= 1
        end = _TOKEN.match(text, m.start()).end()
        at = end
        while start < end and text[start] in _EDGE:
            start += 1
        while end > start and text[end - 1] in _EDGE:
            end -= 1
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if end > start and not (i < len(taken) and taken[i][0] < end):
            out.append((start, end))
    return out


_MENTION = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()),
                      ("patterns", pa.list_(pa.string()))])
_SPAN_SQL = "array<struct<kind:int,start:int,end:int>>"
_MENTION_SQL = "array<struct<kind:int,start:int,end:int,instance:string,patterns:array<string>>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", PART_CHARS):
        mentions = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = strict_spans(text)
            rows = [(k, a, b) for k, a, b in spans] + [(-1, a, b) for a, b in candidates(text, spans)]
            mentions.append([{"kind": k, "start": a, "end": b, "instance": text[a:b].lower(),
                              "patterns": _context(text, a, b)} for k, a, b in rows])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(mentions, pa.list_(_MENTION))],
            ["doc_id", "text_hash", "mentions"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, mentions) of every row; kind -1 marks a candidate.  Written to the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return written(rows.mapInArrow(_scan, f"doc_id long, text_hash long, mentions {_MENTION_SQL}"), "pii-mentions")


def bootstrap(scanned: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end) of the spans that confident patterns discover."""
    mentions = scanned.select("doc_id", "text_hash", F.explode("mentions").alias("m")).select(
        "doc_id", "text_hash", "m.*")
    edges = written(mentions.select("kind", "instance", F.explode("patterns").alias("pattern")).distinct(), "pii-graph")
    strict = edges.where("kind >= 0").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    # The number of instances of a pattern never changes; with fewer than MIN_SEEDS no round can find that many seeds.
    sizes = written(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_SEEDS), "pii-sizes")
    strict = cut(strict.join(sizes, "pattern").select("pattern", "kind", "seeds", "n"))
    open_edges = written(edges.where("kind = -1").select("pattern", "instance").join(sizes, "pattern"), "pii-open")
    support = strict.withColumn("gained", F.col("seeds").cast("double"))
    for _ in range(ROUNDS):
        patterns = cut(support.where(F.col("seeds") >= MIN_SEEDS).select(
            "pattern", "kind", (F.col("gained") / (F.col("n") + F.lit(SMOOTH))).alias("conf")))
        noisy_or = 1 - F.exp(F.sum(F.log(1 - F.least("conf", F.lit(0.999)))))
        scores = cut(open_edges.join(patterns, "pattern").groupBy("instance", "kind").agg(noisy_or.alias("score")))
        best = scores.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("low"))).alias("b")).select(
            "instance", F.col("b.score").alias("score"), (-F.col("b.low")).alias("kind")).where(
            F.col("score") >= INSTANCE_SCORE)
        # Support of the next round: strict seeds, accepted instances, and the scores of all.
        seen = scores.join(best.select("instance", "kind", F.lit(1).alias("accepted")), ["instance", "kind"], "left")
        gained = open_edges.join(seen, "instance").groupBy("pattern", "kind").agg(
            F.count("accepted").alias("seeds"), F.first("n").alias("n"), F.sum("score").alias("gained"))
        support = strict.withColumn("gained", F.col("seeds").cast("double")).unionByName(gained).groupBy("pattern", "kind").agg(
            F.sum("seeds").alias("seeds"), F.first("n").alias("n"), F.sum("gained").alias("gained"))
    sure = patterns.where(F.col("conf") >= PATTERN_SCORE)
    found = mentions.where("kind = -1").drop("kind").withColumn("pattern", F.explode("patterns"))
    found = found.join(best, "instance").join(sure, ["pattern", "kind"], "left_semi")
    return found.select("doc_id", "text_hash", "kind", "start", "end").distinct()


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, strict, found) of every row of ``docs``; both are sorted arrays of (kind, start, end)."""
    scanned = scan(docs)
    extra = written(bootstrap(scanned).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("found")).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "found"), "pii-found")
    strict = F.transform(F.filter("mentions", lambda m: m["kind"] >= 0),
                         lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    rows = scanned.select("doc_id", "text_hash", strict.alias("strict"))
    same = rows["doc_id"].eqNullSafe(extra["__id"]) & (rows["text_hash"] == extra["__hash"])
    return rows.join(extra, same, "left").select(
        "doc_id", "text_hash", "strict", F.coalesce("found", F.array().cast(_SPAN_SQL)).alias("found"))


def listed(array: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(array, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every strict and found span of ``text`` replaced by ``[KIND]``; all columns stay."""
    extra = written(bootstrap(scan(docs)).groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("found")), "pii-found")

    @F.pandas_udf("string")
    def masked(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for text, more in zip(texts, found):
            if text is None:
                out.append(None)
                continue
            marks = strict_spans(text)
            if more is not None:
                marks += [(x["kind"], x["start"], x["end"]) for x in more]
            parts, at = [], 0
            for k, a, b in sorted(marks, key=lambda s: (s[1], -s[2])):
                if b <= at:
                    continue  # inside a span that is already masked
                parts += [text[at:a], f"[{KINDS[k].upper()}]"] if a >= at else []
                at = b
            out.append("".join([*parts, text[at:]]))
        return pd.Series(out, dtype=object)

    rows = whole_rows(docs)
    same = rows["row_id"].eqNullSafe(extra["doc_id"]) & (rows["row_hash"] == extra["text_hash"])
    return rows.join(extra, same, "left").select(
        F.col("row").withField("text", masked(F.col("row.text"), F.col("found"))).alias("row")).select("row.*")
