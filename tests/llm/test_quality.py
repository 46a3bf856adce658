import re
from collections import Counter

from tagweave.llm import quality as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    twice = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(twice))


def test_measures_match_brute_force(spark, real_docs, edge_docs):
    for docs in (real_docs, edge_docs):
        want = Counter((r["doc_id"], *brute(r["text"])) for r in docs.collect())
        got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                      for r in q.ledger(docs).collect())
        assert got == want


def test_policies_apply_to_stored_bits(spark, real_docs):
    rows = q.ledger(real_docs).cache()
    for p in q.POLICIES:
        got = {r["doc_id"]: r["kept"] for r in q.apply_policy(rows, p).collect()}
        for r in rows.collect():
            hard = r["fail_bits"] & p.hard_mask
            soft = bin(r["fail_bits"] & p.soft_mask).count("1")
            assert got[r["doc_id"]] == (hard == 0 and soft <= p.soft_allowed)
    assert q.policy("production").version == 2
    rows.unpersist()


def test_ablation_matches_recount(spark, real_docs):
    rows = q.ledger(real_docs).cache()
    p = q.policy("production")
    bits = [r["fail_bits"] for r in rows.collect()]

    def ok(b, out=0):
        return b & p.hard_mask & ~out == 0 and bin(b & p.soft_mask & ~out).count("1") <= p.soft_allowed

    for r in q.ablation(rows, p).collect():
        bit = q.BIT[r["rule"]]
        assert r["n_failed"] == sum(1 for b in bits if b & bit)
        assert r["n_rejected"] == sum(1 for b in bits if not ok(b))
        assert r["n_rescued"] == sum(1 for b in bits if not ok(b) and ok(b, bit))
    total = q.rule_summary(rows).first()
    assert total["n_docs"] == len(bits)
    rows.unpersist()


def test_edges(spark, edge_docs, empty_docs):
    assert q.ledger(empty_docs).count() == 0
    assert {r["n_failed"] for r in q.ablation(q.ledger(empty_docs), q.BASE).collect()} == {0}
    kept = q.keep(edge_docs, q.BASE)
    assert kept.columns == edge_docs.columns
    good = Counter(r["doc_id"] for r in edge_docs.collect()
                   if brute(r["text"])[0] >= 50 and 2 * brute(r["text"])[4] <= brute(r["text"])[0])
    assert Counter(r["doc_id"] for r in kept.collect()) == good


def test_rescue_bits_name_the_rules_whose_removal_keeps_a_row(spark):
    p = q.policy("production")
    rows = spark.range(1 << len(q.RULES)).withColumnRenamed("id", "fail_bits")
    kept = {r["fail_bits"]: r["kept"] for r in q.apply_policy(rows, p).collect()}
    for r in rows.select("fail_bits", q.rescue_bits(p, rows["fail_bits"]).alias("rescue")).collect():
        want = 0
        if not kept[r["fail_bits"]]:
            for name in (*p.hard, *p.soft):
                bits = r["fail_bits"] & ~q.BIT[name]
                # Dropping a rule is passing it, for a policy that counts failures.
                want |= q.BIT[name] if r["fail_bits"] & q.BIT[name] and kept[bits] else 0
        assert r["rescue"] == want
