import io

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagweave.llm import tokenfile as t

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=400))
def test_block_round_trip(values):
    ids = np.array(values, dtype=np.uint32)
    assert t.unpack_block(t.pack_block(ids)).tolist() == values


def test_outliers_are_patched_not_widened():
    ids = np.r_[np.arange(1000) % 100, [2**31]].astype(np.uint32)
    assert len(t.pack_block(ids)) < 1001 * 7 / 8 + 64


def test_file_seeks_any_range():
    rng = np.random.default_rng(0)
    stream, docs = io.BytesIO(), []
    w = t.FileWriter(stream)
    for i in range(30):
        ids = rng.integers(0, 50_000, int(rng.integers(0, 2000)), dtype=np.uint32)
        docs.append(ids)
        w.add([None if i == 3 else i], np.array([len(ids)]), ids)
    w.finish()
    r = t.FileReader(stream, w.at)
    flat = np.concatenate(docs)
    assert r.doc_ids[3] is None and r.doc_ids[4] == 4 and r.n == len(flat)
    for a, b in [(0, 10), (t.BLOCK - 1, t.BLOCK + 1), (5000, 13000), (0, len(flat)), (7, 7)]:
        assert np.array_equal(r.ids(a, b), flat[a:b])


def test_files_hold_the_library_s_ids_in_order(spark, real_docs, edge_docs, empty_docs):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    for docs in (real_docs.limit(60), edge_docs):
        want = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, tok.encode(r["text"] or "", add_special_tokens=False).ids + [2])
                       for r in docs.collect()))
        manifest = t.write_ids(docs, PATH, end_id=2)
        got = sorted(t.read_ids(manifest).collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in got] == [d if k else None for k, d, _ in want]
        assert sorted((r["doc_id"] or 0, list(r["ids"])) for r in got) == sorted((d, ids) for _, d, ids in want)
        at = 0
        for r in got:
            assert r["start"] == at and r["n_tokens"] == len(r["ids"])
            at += r["n_tokens"]
        packed = {(r["start"], bytes(r["ids"])) for r in t.read_ids(manifest, packed=True).collect()}
        assert packed == {(r["start"], np.array(r["ids"], dtype="<u4").tobytes()) for r in got}
    assert t.read_ids(t.write_ids(empty_docs, PATH, end_id=2)).count() == 0


def test_small_word_cache_changes_nothing(monkeypatch, real_texts):
    texts = list(real_texts.values())[:20]
    one = t.WordEncoder(PATH).encode(texts, 2)
    monkeypatch.setattr(t, "KNOWN_WORDS", 50)
    enc = t.WordEncoder(PATH)
    parts = [enc.encode([x], 2) for x in texts]
    assert np.array_equal(one[0], np.concatenate([p[0] for p in parts]))
    assert one[1].tolist() == [int(p[1][0]) for p in parts]


def test_files_roll_and_ranges_follow_bytes(spark, real_docs):
    docs = real_docs.limit(80)
    one = {r["doc_id"]: (r["start"], list(r["ids"])) for r in t.read_ids(t.write_ids(docs, PATH, end_id=2)).collect()}
    manifest = t.write_ids(docs, PATH, end_id=2, range_bytes=10_000, file_ids=2000)
    files = manifest.collect()
    assert len(files) > 20 and all(f["n_docs"] == 1 or f["n_ids"] < 2000 + 20_000 for f in files)
    assert {r["doc_id"]: (r["start"], list(r["ids"])) for r in t.read_ids(manifest).collect()} == one


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=8))
def test_numbered_pieces_are_the_pieces(texts):
    from tagweave.llm import pretoken
    words, seq, counts = pretoken.split_numbered(texts)
    tokens, want = pretoken.split_texts(texts)
    assert [words[i].decode("utf-8", "surrogatepass") for i in seq] == tokens
    assert counts.tolist() == want.tolist() and len(set(words)) == len(words)


def test_pieces_with_one_hash_stay_apart(monkeypatch):
    from tagweave.llm import pretoken
    monkeypatch.setattr(pretoken, "_hashes", lambda raw, at: np.zeros(len(at) - 1, np.uint64))
    words, seq, _ = pretoken.split_numbered(["one two one three", " two"])
    assert [words[i] for i in seq] == [b"one", b" two", b" one", b" three", b" two"]
