"""Secret scanning that links the parts of a credential; DataFrame and SQL functions only.

Every text is searched for parts: strict secrets and access ids, and weak
candidates (user names, short passwords, random-looking tokens, endpoints) that
mean little alone.  Parts get their character intervals; weak ones are joined
with the parts of the same document whose interval lies within ``SCOPE``
characters (an equi-join on document and position bucket plus the interval
condition), and are reported only if the complementary parts co-occur there.

Intervals come from the text between matches: ``split`` and
``regexp_extract_all`` with one pattern give gaps and matches in turn, and a
running sum over their lengths gives offsets.  Only documents that pass one
cheap search leave the scan, with their matches, not their texts.

Defined results: null and empty texts have no parts; repeated rows each get
the same result; intervals count code points, end exclusive; weak candidates
that overlap a strict match are dropped; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import written

SCOPE = 200  # characters between linked parts
IDENTIFIER, SECRET, ENDPOINT = 1, 2, 4


@dataclass(frozen=True)
class Part:
    kind: str
    role: int
    strict: bool
    pattern: str
    keep: str = "true"   # SQL over ``hit``, the matched text
    needs: str = "true"  # SQL over ``near``, the roles close by; for weak parts
    linear: str = ""     # the same matches for a backtracking matcher, in linear time and bounded stack
    before: str = ""     # what ``linear`` matches in front of the part itself


# Fixed value: the keywords of an assigned secret.
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_WEAK = r"""((?i:pwd|passphrase|credential|pin))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_NAME = r"""((?i:username|user|login|client_?id|account|access_?key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]+)"""
_HOST = r"""((?i:host|endpoint|server|base_?url))["']?\x20*[:=]\x20*["']?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?)"""
# A matcher recurses for each repeat of a group that it may give up again; nothing behind these could use that.
_HOST_LINEAR = _HOST.replace(r"(?:\.[A-Za-z0-9-]+)+", r"(?:\.[A-Za-z0-9-]++)++")
_URL = r"""[a-z][a-z0-9+.-]*://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+"""
# A run of scheme signs is tried once, from its start; a match never ends inside one, as its own signs include them.
_URL_BEFORE = r"[0-9+.-]*+"
_URL_LINEAR = r"(?<![a-z0-9+.-])" + _URL_BEFORE + _URL.replace("[a-z0-9+.-]*:", "[a-z0-9+.-]*+:")


def _group2(pattern: str) -> str:
    return "regexp_extract(hit, r'" + pattern.replace("'", "\\x27") + "', 2)"


# The order is the order of equal starts in results; strict kinds come first.
PARTS = [
    Part("assign", SECRET, True, _ASSIGN, f"length({_group2(_ASSIGN)}) >= 6"),
    # Shorter runs fail the length rule and nothing inside a run can pass it, so the length stands in the pattern.
    Part("access", IDENTIFIER, True, r"AKIA[A-Z0-9]{16,}"),
    Part("hex", SECRET, True, r"[0-9a-f]{24,}"),
    Part("weak_secret", SECRET, False, _WEAK, f"length({_group2(_WEAK)}) >= 4",
         f"(near & {IDENTIFIER | ENDPOINT}) <> 0"),
    Part("random", SECRET, False, r"[A-Za-z0-9+/]{32,}={0,2}",
         "hit rlike '[A-Z]' and hit rlike '[a-z]' and hit rlike '[0-9]'", f"(near & {IDENTIFIER | ENDPOINT}) <> 0"),
    Part("name", IDENTIFIER, False, _NAME, f"length({_group2(_NAME)}) >= 3", f"(near & {SECRET}) <> 0"),
    Part("url", ENDPOINT, False, _URL, "true", f"(near & {IDENTIFIER | SECRET}) = {IDENTIFIER | SECRET}",
         _URL_LINEAR, _URL_BEFORE),
    Part("host", ENDPOINT, False, _HOST, "true", f"(near & {IDENTIFIER | SECRET}) = {IDENTIFIER | SECRET}", _HOST_LINEAR),
]
KINDS = [p.kind for p in PARTS]
# A text without any of these has no part.
GATE = (r"""AKIA|[0-9a-f]{24}|://|[A-Za-z0-9+/]{32}|(?i:password|passwd|secret|token|api_?key|pwd|passphrase|credential|pin"""
        r"""|username|user|login|client_?id|account|access_?key_?id|host|endpoint|server|base_?url)["']?\x20*[:=]""")


def parts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind number, start, end) of every part; equal rows of ``docs`` count once."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").where(
        F.col("text").rlike(GATE))
    found = F.array(*[F.struct(F.lit(i).alias("kind"),
                               F.regexp_extract_all("text", F.lit(p.linear or p.pattern), F.lit(0)).alias("hits"))
                      for i, p in enumerate(PARTS)])
    each = rows.select("doc_id", "text_hash", "text", F.explode(F.filter(found, lambda x: F.size(x["hits"]) > 0)).alias("f"))
    gaps, before = F.lit(None).cast("array<string>"), F.lit("")
    for i, p in enumerate(PARTS):  # only kinds that were found are searched again
        gaps = F.when(F.col("f.kind") == i, F.split("text", p.linear or p.pattern, -1)).otherwise(gaps)
        if p.before:
            before = F.when(F.col("kind") == i, F.regexp_extract("g.hit", "^" + p.before, 0)).otherwise(before)
    laid = each.select("doc_id", "text_hash", F.col("f.kind").alias("kind"),
                       F.posexplode(F.arrays_zip(gaps.alias("gap"), F.col("f.hits").alias("hit"))).alias("i", "g"))
    laid = laid.where("g.hit is not null").withColumn("before", F.length(before)).groupBy("doc_id", "text_hash", "kind", "i").agg(
        F.first(F.length("g.gap") + F.col("before")).alias("gap"), F.first(F.expr("substr(g.hit, before + 1)")).alias("hit"))
    so_far = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("i")
    ends = F.sum(F.col("gap") + F.length("hit")).over(so_far).alias("end")
    keep = F.lit(False)
    for i, p in enumerate(PARTS):
        keep = F.when(F.col("kind") == i, F.expr(p.keep)).otherwise(keep)
    return laid.select("doc_id", "text_hash", "kind", "hit", ends).where(keep).select(
        "doc_id", "text_hash", "kind", (F.col("end") - F.length("hit")).cast("long").alias("start"),
        F.col("end").cast("long").alias("end"))


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The rows of ``found`` that are strict, or weak with complementary parts in scope."""
    number = {p.kind: i for i, p in enumerate(PARTS)}
    strict = [number[p.kind] for p in PARTS if p.strict]
    role = F.array(*[F.lit(p.role) for p in PARTS])[F.col("kind")]
    weak = found.where(~F.col("kind").isin(strict))
    # A part meets those that start within scope or reach into it: buckets of its whole widened interval.
    left = weak.select("*", F.explode(F.sequence(
        F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))).alias("bucket"))
    right = found.select(
        F.col("doc_id").alias("d2"), F.col("text_hash").alias("h2"), F.col("kind").alias("k2"),
        F.col("start").alias("s2"), F.col("end").alias("e2"), role.alias("role"),
        F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("b2"))
    meets = (F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("text_hash") == F.col("h2")) & (F.col("bucket") == F.col("b2"))
             & (F.col("s2") <= F.col("end") + scope) & (F.col("e2") >= F.col("start") - scope))
    over = (F.col("s2") < F.col("end")) & (F.col("e2") > F.col("start"))
    near = left.join(right, meets).groupBy("doc_id", "text_hash", "kind", "start", "end").agg(
        F.bit_or(F.when(over, F.lit(0)).otherwise(F.col("role"))).alias("near"),
        F.max(over & F.col("k2").isin(strict)).alias("inside"))
    needs = F.lit(False)
    for i, p in enumerate(PARTS):
        if not p.strict:
            needs = F.when(F.col("kind") == i, F.expr(p.needs)).otherwise(needs)
    linked = near.where(~F.col("inside") & needs).drop("near", "inside")
    return found.where(F.col("kind").isin(strict)).unionByName(linked)


def listed(array: Column) -> Column:
    """``kind:start:end`` of each (start, kind, end), comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(array, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, spans) of every row of ``docs``; spans is an array of (start, kind number, end), sorted."""
    found = written(parts(docs), "secret-parts")
    by_doc = link(found, scope).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "spans")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"))
    same = rows["doc_id"].eqNullSafe(by_doc["__id"]) & (rows["text_hash"] == by_doc["__hash"])
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return rows.join(by_doc, same, "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
