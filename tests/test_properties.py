"""Property tests (Hypothesis): random small inputs against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tagweave.functions.bitmap import decode
from tagweave.operators.bitmap import build_bitmaps, cardinality
from tagweave.operators.merge import merge_tags

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

uids = st.integers(min_value=0, max_value=70_000).map(str)
values = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d,e", "Ω"]))
tag_rows = st.lists(st.tuples(uids, values), min_size=1, max_size=40)


@SETTINGS
@given(a=tag_rows, b=tag_rows, preaggregate=st.booleans())
def test_wide_merge_matches_brute_force(spark, a, b, preaggregate):
    frames = [("TAG_A", spark.createDataFrame(a, "uid string, tag_value string")),
              ("TAG_B", spark.createDataFrame(b, "uid string, tag_value string"))]
    want = {}
    for col, rows in (("tag_a", a), ("tag_b", b)):
        for uid, v in rows:
            want.setdefault(uid, {"tag_a": [], "tag_b": []})
            if v is not None:
                want[uid][col].append(v)
    want = {u: (",".join(sorted(c["tag_a"])), ",".join(sorted(c["tag_b"]))) for u, c in want.items()}
    for method in ("pivot", "map"):
        got = {r.uid: (r.tag_a, r.tag_b)
               for r in merge_tags(frames, preaggregate=preaggregate, method=method).collect()}
        assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["t1", "t2"]), st.sampled_from(["x", "y"]),
                               st.integers(min_value=0, max_value=200_000)), min_size=1, max_size=60))
def test_bitmaps_decode_to_distinct_uids(spark, rows):
    long = spark.createDataFrame([(str(u), c, v) for c, v, u in rows],
                                 "uid string, tag_code string, tag_value string")
    bitmaps = build_bitmaps(long)
    want = {}
    for c, v, u in rows:
        want.setdefault((c, v), set()).add(u)
    got = {}
    for r in decode(bitmaps, ["tag_code", "tag_value"]).collect():
        got.setdefault((r.tag_code, r.tag_value), set()).add(r.uid)
    assert got == want
    assert {(r.tag_code, r.tag_value): r.users for r in cardinality(bitmaps).collect()} == \
        {k: len(v) for k, v in want.items()}
