"""Quality rules as a bitmask ledger.

``ledger`` measures every text once and evaluates every rule once: one row per
document with the measurements and a ``fail_bits`` long (bit i set = rule i
failed).  Policies are versioned sets of masks over those bits and are applied
later with bitwise operators, so a new policy version, or an ablation of one
rule, never reads a text again.

Defined results: a null or empty text has no words (every measure 0) and fails
``min_words``; repeated rows each get their own ledger row; columns other than
``doc_id`` and ``text`` are ignored.  A text of any length is one row's work.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_marks", "n_upper", "n_lower", "n_alpha_words"]
_SYMBOL = re.compile(r"[#*$%&|<>]")
_UPPER = re.compile(r"[A-Z]")
_LOWER = re.compile(r"[a-z]")
_ALPHA_WORD = re.compile(rb"[A-Za-z\x80-\xff]")
SPACES = " \t\n\v\f\r"


def repeated_positions(words: list) -> int:
    """Words that lie in a 3-word window found at least twice in ``words``."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    # Pair ids are renumbered below n, so the second product stays far below 2**63.
    _, pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, inverse, counts = np.unique(pair[:-1] * np.int64(len(number)) + ids[2:],
                                   return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift:shift + n] |= twice
    return int(covered.sum())


def measure_text(text: str | None) -> tuple:
    """The measurements of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() cuts at exactly the six ASCII white-space characters
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        len(_SYMBOL.findall(text)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_positions(words),
        text.count("!"),
        len(_UPPER.findall(text)),
        len(_LOWER.findall(text)),
        sum(1 for w in words if _ALPHA_WORD.search(w)),
    )


def measure(text: Column) -> Column:
    """Struct of the measures of a text column."""
    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure_text(t) for t in texts], columns=MEASURES, dtype="int64")

    return run(text)


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measures, whole numbers only, true = failed


# The order is the bit order of stored ledgers: append new rules, never reorder.
RULES = [
    Rule("min_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbol_ratio", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("exclamation_ratio", "10 * n_marks > 3 * n_words"),
    Rule("upper_case", "n_upper > n_lower"),
    Rule("alphabetic_words", "10 * n_alpha_words < 8 * n_words"),
    Rule("mean_word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
]
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Reject when a hard rule failed, or more than ``soft_allowed`` of the soft rules did."""

    name: str
    version: int
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    soft_allowed: int = 0

    @property
    def hard_mask(self) -> int:
        return sum(BIT[r] for r in self.hard)

    @property
    def soft_mask(self) -> int:
        return sum(BIT[r] for r in self.soft)


BASE = Policy("base", 1, hard=("min_words", "repeated_windows"))
POLICIES = [
    BASE,
    Policy("production", 1, hard=(*BASE.hard, "symbol_ratio")),
    # One soft failure alone is common in good texts (a short text with a repeated line).
    Policy("production", 2, hard=(*BASE.hard, "symbol_ratio"),
           soft=("duplicate_lines", "exclamation_ratio", "upper_case", "alphabetic_words",
                 "mean_word_length"), soft_allowed=1),
]


def policy(name: str, version: int | None = None) -> Policy:
    """The given version, or the newest."""
    found = [p for p in POLICIES if p.name == name and version in (None, p.version)]
    if not found:
        raise ValueError(f"no policy {name!r} version {version}")
    return max(found, key=lambda p: p.version)


def fail_bits() -> Column:
    """The failure bits as one long, from the measure columns."""
    total = F.lit(0).cast("long")
    for rule in RULES:
        bit = F.when(F.expr(rule.fails), F.lit(BIT[rule.name])).otherwise(F.lit(0))
        total = total.bitwiseOR(bit.cast("long"))
    return total


def accepted(p: Policy, bits: Column, without: int = 0) -> Column:
    """Whether ``bits`` pass the policy when the rules of mask ``without`` are ablated."""
    hard, soft = p.hard_mask & ~without, p.soft_mask & ~without
    return (bits.bitwiseAND(F.lit(hard).cast("long")) == 0) & (
        F.bit_count(bits.bitwiseAND(F.lit(soft).cast("long"))) <= p.soft_allowed)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measures and ``fail_bits`` of every row of ``docs``; no shuffle."""
    measured = docs.select("doc_id", measure(F.col("text")).alias("m")).select("doc_id", "m.*")
    return measured.withColumn("fail_bits", fail_bits())


def apply_policy(rows: DataFrame, p: Policy, out: str = "kept") -> DataFrame:
    return rows.withColumn(out, accepted(p, F.col("fail_bits")))


def rescue_bits(p: Policy, bits: Column) -> Column:
    """Of a rejected row, the rules any one of which would keep it if it were dropped from the policy; else 0."""
    total = F.lit(0).cast("long")
    for r in (*p.hard, *p.soft):
        saved = F.when(~accepted(p, bits) & accepted(p, bits, BIT[r]), F.lit(BIT[r])).otherwise(F.lit(0))
        total = total.bitwiseOR(saved.cast("long"))
    return total


def keep(docs: DataFrame, p: Policy) -> DataFrame:
    """The rows of ``docs`` that pass the policy, with all their columns."""
    wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), measure(F.col("text")).alias("__m"))
    return wrapped.select("__doc", "__m.*").where(accepted(p, fail_bits())).select("__doc.*")


def ablation(rows: DataFrame, p: Policy) -> DataFrame:
    """Per rule of the policy: rows that failed it, rows rejected, and rows that dropping it would keep.

    The ledger collapses to its distinct bit patterns first (at most
    2**len(RULES) rows, combined map-side), so all ablations cost one small
    shuffle.  An empty ledger gives zero counts for every rule.
    """
    spark = rows.sparkSession
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    names = [r for r in (*p.hard, *p.soft)]
    bits = F.col("fail_bits")
    counts = []
    for r in names:
        counts.append(F.struct(
            F.lit(r).alias("rule"),
            F.when(bits.bitwiseAND(F.lit(BIT[r]).cast("long")) != 0, F.col("n")).otherwise(0).alias("n_failed"),
            F.when(~accepted(p, bits), F.col("n")).otherwise(0).alias("n_rejected"),
            F.when(~accepted(p, bits) & accepted(p, bits, BIT[r]), F.col("n")).otherwise(0).alias("n_rescued")))
    each = patterns.select(F.explode(F.array(*counts)).alias("c")).select("c.*")
    sums = each.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("n_failed", "n_rejected", "n_rescued")])
    rules = spark.createDataFrame([(i, r) for i, r in enumerate(names)], "pos int, rule string")
    return (rules.join(sums, "rule", "left").select(
        F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), "rule",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_failed", "n_rejected", "n_rescued")]))


def rule_summary(rows: DataFrame) -> DataFrame:
    """One row: bits failed by any document, bits failed by all, and the number of documents."""
    return rows.agg(F.bit_or("fail_bits").alias("failed_by_any"), F.bit_and("fail_bits").alias("failed_by_all"),
                    F.count("*").alias("n_docs"))
