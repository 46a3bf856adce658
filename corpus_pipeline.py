"""A corpus pipeline: quality rules, near-duplicate removal, decontamination, PII masking, tokenisation.

``STAGES`` lists (name, function) in order.  Each function takes
``(spark, docs, sf_dir)`` and returns a DataFrame over all rows its predecessor
kept; all but the last return the columns of ``docs``.  ``run`` writes each
stage's result as Parquet to the shared folder and reads it again as the next
one's ``docs``, so a lost executor costs one stage's tasks, never a recomputed
chain.

Nulls, empty texts, repeated rows, empty tables and further columns are handled
as each operator states; further columns of ``documents`` pass through every
filtering stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import bpe, decontaminate, pii, quality, simhash
from tagweave.llm.common import documents, workers_can_import, written
from tagweave.llm.queries import BPE_RANKS, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the newest production policy accepts."""
    return quality.keep(docs, quality.policy("production"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, decontaminate.contaminated_pairs(docs, items))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in ``text`` replaced by its kind; ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the digests of ids and decoded bytes."""
    ranks = bpe.load_ranks(tokenizer_path(BPE_RANKS))
    return bpe.digests(bpe.round_trip(docs, ranks), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mask_pii", mask_pii),
    ("tokenise", tokenise),
]

# Fingerprints (XXH64), tiling and byte-pair merges are outside SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_can_import(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
