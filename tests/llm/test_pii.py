import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tagweave.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def brute(t):
    t = t or ""
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(t) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "1", "2", "9", "0", ".", "@", "-", "+", " ", "(", ")", "_", "%", "@a.b", "+1 ",
                                 "4111 1111 1111 1111", "é"]), max_size=30).map("".join))
def test_strict_spans(text):
    assert pii.strict_spans(text) == brute(text)


def test_strict_spans_of_tables(spark, real_docs, edge_docs):
    for docs in (real_docs, edge_docs):
        want = Counter((r["doc_id"], tuple(brute(r["text"]) if len(r["text"] or "") < 40_000 or "@" in r["text"] else ()))
                       for r in docs.collect())
        got = Counter((r["doc_id"], tuple(tuple(s) for s in r["strict"])) for r in pii.spans(docs).collect())
        assert got == want


def contextual(spark):
    """Seeds: 30 emails after 'write to'.  Unseen: numeric handles in the same place.  Noise: numbers elsewhere."""
    rows = [(i, f"please write to user{i}@mail.example.com today ok") for i in range(60)]
    rows += [(100, "please write to agent007 today ok"), (101, "room number 4242 is free now")]
    rows += [(200 + i, f"chapter {i + 500} ends here") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_confident_patterns_discover(spark):
    docs = contextual(spark)
    found = {r["doc_id"]: [tuple(s) for s in r["found"]] for r in pii.spans(docs).collect() if r["found"]}
    assert found == {100: [(0, 16, 24)]}
    masked = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert masked[100] == "please write to [EMAIL] today ok"
    assert masked[0] == "please write to [EMAIL] today ok"
    assert masked[101] == "room number 4242 is free now"


def test_discovered_patterns_discover(spark):
    """Handles found after 'write to' also stand after 'my handle is', which no strict seed supports."""
    rows = [(i, f"please write to user{i}@mail.example.com today ok") for i in range(300)]
    rows += [(1000 + i, f"please write to agent{i} today ok") for i in range(30)]
    rows += [(2000 + i, f"well my handle is agent{i} by now") for i in range(30)]
    rows += [(3000, "well my handle is zebra77 by now"), (3001, "room number 4242 is free now")]
    rows += [(4000 + i, f"chapter {i + 500} ends here") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [s["kind"] for s in r["found"]] for r in pii.spans(docs).collect() if r["found"]}
    assert found == {i: [0] for i in [*range(1000, 1030), *range(2000, 2030), 3000]}
    masked = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert masked[3000] == "well my handle is [EMAIL] by now"
    assert masked[3001] == "room number 4242 is free now"


def test_edges(spark, edge_docs, empty_docs):
    assert pii.spans(empty_docs).count() == 0 and pii.redact(empty_docs).count() == 0
    masked = pii.redact(edge_docs)
    assert masked.columns == edge_docs.columns and masked.count() == edge_docs.count()
    assert sum(r["text"] is None for r in masked.collect()) == 2
    assert masked.where("text = 'call [PHONE] or [IP] card [CARD]'").count() == 1
