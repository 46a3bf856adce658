"""The registered ``opN_<name>`` queries with their production parameters, and the SQL of those that SQL can express.

Each query reads whole tables, gets its rows through its operator and only
derives the contract's columns here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import (
    alignment,
    bpe,
    chat,
    decontaminate,
    langid,
    licenses,
    pii,
    quality,
    runs,
    secrets,
    simhash,
    tokenfile,
    toxicity,
)
from tagweave.llm.common import documents, workers_can_import, written

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
FILE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
CHAT_RESERVED = 50257  # first id beyond the vocabulary of FILE_TOKENIZER


def tokenizer_path(name: str) -> str:
    import public_tokenizers  # vocabulary files installed beside the library

    return public_tokenizers.path(name)


def _spans_of(array: str, kind: int) -> Column:
    return F.size(F.filter(array, lambda s: s["kind"] == kind)).cast("long")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest, first = quality.policy("production"), quality.policy("production", 1)
    # Every rule is evaluated once; the policies and the ablation read the stored bits.
    rows = written(quality.ledger(documents(spark, sf_dir)), "quality-ledger")
    rows = quality.apply_policy(quality.apply_policy(rows, newest), first, "kept_version_1")
    base = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), "kept", "fail_bits", "kept_version_1",
                       quality.rescue_bits(newest, F.col("fail_bits")).alias("rescue_bits"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.fit(docs))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(tokenizer_path(BPE_RANKS))
    return bpe.digests(bpe.round_trip(documents(spark, sf_dir), ranks))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated_pairs(documents(spark, sf_dir), benchmark).drop("text_hash")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.spans(documents(spark, sf_dir))
    counts = [_spans_of("strict", i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    both = F.array_sort(F.concat("strict", "found"))
    return rows.select("doc_id", *counts, F.sha2(pii.listed(F.col("strict")).cast("binary"), 256).alias("base_sha256"),
                       pii.listed(both).alias("spans"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfile.write_ids(documents(spark, sf_dir), tokenizer_path(FILE_TOKENIZER), end_id=2)
    return tokenfile.read_ids(manifest, packed=True).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan(documents(spark, sf_dir))
    strict = F.filter("spans", lambda s: s["kind"] < 3)
    counts = [_spans_of("spans", i).alias(f"n_{secrets.KINDS[i]}") for i in range(3)]
    return rows.select("doc_id", *counts, F.sha2(secrets.listed(strict).cast("binary"), 256).alias("base_sha256"),
                       secrets.listed(F.col("spans")).alias("spans"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scores(docs, model)


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = alignment.align(documents(spark, sf_dir), tokenizer_path(FILE_TOKENIZER), tokenizer_path(PIECE_MODEL))
    return alignment.scores(chunks, alignment.pair_counts(chunks))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(runs.with_planted_repeats(documents(spark, sf_dir)))
    top = runs.longest(F.col("runs"))
    lines = F.concat_ws("", F.transform("runs", lambda x: F.concat_ws(
        "", F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))))
    return found.select("doc_id", "n_words", "runs", "collapsed", top.alias("top")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words")


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "</s>[INST] ok [/INST]"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    form = chat.Format(tokenizer_path(FILE_TOKENIZER), CHAT_RESERVED)
    return chat.digests(chat.format_conversations(turns.unionByName(extra), form), form)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_license_scan": op2_license_scan,
    "op3_language_id": op3_language_id,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_decontamination": op5_decontamination,
    "op6_pii": op6_pii,
    "op7_token_files": op7_token_files,
    "op8_secret_scan": op8_secret_scan,
    "op9_toxicity": op9_toxicity,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_chat_format": op13_chat_format,
}


def _ready(run: Callable) -> Callable:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_can_import(spark)
        return run(spark, sf_dir)

    return call


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _ready(f) for k, f in QUERIES.items()}


# The measures and rules again in DuckDB SQL; op1 is the one operator whose whole result SQL can state.
_OP1 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT rid, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM w),
g AS (SELECT rid, i, word, lead(word, 1) OVER q AS w2, lead(word, 2) OVER q AS w3 FROM p WINDOW q AS (PARTITION BY rid ORDER BY i)),
t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, word, w2, w3) AS n FROM g WHERE w3 IS NOT NULL),
c AS (SELECT rid, count(DISTINCT i + s) AS n_repeat_words FROM t, (SELECT unnest([0, 1, 2]) AS s) WHERE n > 1 GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
n AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(regexp_extract_all(text, '!')) AS n_marks,
    len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[a-z]')) AS n_lower,
    len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS n_alpha_words
  FROM w LEFT JOIN c USING (rid) LEFT JOIN n USING (rid)),
b AS (
  SELECT *, (n_words < 50)::BIGINT AS r0, (100 * n_repeat_words > 50 * n_words)::BIGINT AS r1,
    (10 * n_symbols > n_words)::BIGINT AS r2, (10 * n_dup_lines > 3 * n_lines)::BIGINT AS r3,
    (10 * n_marks > 3 * n_words)::BIGINT AS r4, (n_upper > n_lower)::BIGINT AS r5,
    (10 * n_alpha_words < 8 * n_words)::BIGINT AS r6,
    (word_chars > 15 * n_words OR word_chars < 2 * n_words)::BIGINT AS r7
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 + r1 > 0 AS base_failed,
  r0 + r1 + r2 = 0 AND r3 + r4 + r5 + r6 + r7 <= 1 AS kept,
  r0 + 2 * r1 + 4 * r2 + 8 * r3 + 16 * r4 + 32 * r5 + 64 * r6 + 128 * r7 AS fail_bits,
  r0 + r1 + r2 = 0 AS kept_version_1,
  CASE WHEN r0 + r1 + r2 = 1 AND r3 + r4 + r5 + r6 + r7 <= 1 THEN r0 + 2 * r1 + 4 * r2
    WHEN r0 + r1 + r2 = 0 AND r3 + r4 + r5 + r6 + r7 = 2 THEN 8 * r3 + 16 * r4 + 32 * r5 + 64 * r6 + 128 * r7
    ELSE 0 END AS rescue_bits
FROM b
"""



def _op8() -> str:
    """Parts by the stated patterns, offsets by summed lengths, weak parts by an interval self-join."""
    keep = {
        "assign": "length(regexp_extract(hit, '{rx}', 2)) >= 6", "weak_secret": "length(regexp_extract(hit, '{rx}', 2)) >= 4",
        "name": "length(regexp_extract(hit, '{rx}', 2)) >= 3",
        "random": "regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[0-9]')",
    }
    found, roles, needs = [], [], []
    for i, p in enumerate(secrets.PARTS):
        rx = p.pattern.replace("'", "''")
        found.append(f"""SELECT rid, {i} AS kind, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap
  FROM (SELECT rid, regexp_extract_all(text, '{rx}') AS hits, regexp_split_to_array(text, '{rx}') AS gaps FROM d)""")
        roles.append(f"WHEN kind = {i} THEN ({keep.get(p.kind, 'true').format(rx=rx)})")
        if not p.strict:
            needs.append(f"kind = {i} AND {p.needs}")
    names = ", ".join(f"'{k}'" for k in secrets.KINDS)
    role = "[" + ", ".join(str(p.role) for p in secrets.PARTS) + "]"
    strict = sum(p.strict for p in secrets.PARTS)
    scope, union = secrets.SCOPE, " UNION ALL ".join(found)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({union}),
e AS (SELECT rid, kind, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY i) AS e FROM f),
p AS (SELECT rid, kind, CAST(e - length(hit) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, {role}[kind + 1] AS role
  FROM e WHERE CASE {' '.join(roles)} END),
n AS (SELECT a.rid, a.kind, a.s, a.e, bit_or(CASE WHEN b.s < a.e AND b.e > a.s THEN 0 ELSE b.role END) AS near,
    bool_or(b.kind < {strict} AND b.s < a.e AND b.e > a.s) AS inside
  FROM p a JOIN p b ON a.rid = b.rid AND b.s <= a.e + {scope} AND b.e >= a.s - {scope}
  WHERE a.kind >= {strict} GROUP BY ALL),
x AS (SELECT rid, kind, s, e FROM p WHERE kind < {strict}
  UNION ALL SELECT rid, kind, s, e FROM n WHERE NOT inside AND ({' OR '.join(f'({c})' for c in needs)})),
t AS (SELECT rid, kind, s, e, [{names}][kind + 1] || ':' || s || ':' || e AS span FROM x),
g AS (SELECT rid, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
    count(*) FILTER (WHERE kind = 2) AS n_hex, string_agg(span, ',' ORDER BY s, kind, e) FILTER (WHERE kind < {strict}) AS base,
    string_agg(span, ',' ORDER BY s, kind, e) AS spans FROM t GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


ORACLES: dict[str, str] = {"op1_quality_rules": _OP1, "op8_secret_scan": _op8()}
