import random
import re

from tagweave.llm import licenses as lic


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def places(words, phrases):
    return sorted((i, k) for k, p in enumerate(phrases) for i in range(len(words))
                  if words[i:i + len(p.split())] == p.split())


def test_phrases_and_whole_templates_on_random_words():
    rnd = random.Random(4)
    for _ in range(300):
        phrases = {" ".join(rnd.choice("abcd") for _ in range(rnd.randint(2, 3))): f"p{i}" for i in range(3)}
        templates = [(f"t{i}", " ".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 10)))) for i in range(3)]
        s = lic.Scanner(phrases, templates)
        text = [rnd.choice("abcdz") for _ in range(rnd.randint(0, 30))]
        words, base, _ = s.scan(" ".join(text))
        assert len(words) == len(text) and sorted(base) == places(text, phrases)
        for i, (_, t) in enumerate(templates):
            found = [c for c in s.scan(f"z {t} z")[2] if c[0] == len(phrases) + i]
            assert found and found[0][1:3] == (1, 1 + len(t.split()))


def test_matching_runs_are_maximal():
    rnd = random.Random(5)
    seqs = [[rnd.choice("abc") for _ in range(12)] for _ in range(3)]
    sam = lic.Automaton()
    for i, q in enumerate(seqs):
        sam.add(i, [w.encode() for w in q])
    sam.close()
    for _ in range(200):
        q = [rnd.choice("abc") for _ in range(rnd.randint(1, 6))]
        v = 0
        for w in q:
            v = sam.next[v].get(w.encode(), -1)
            if v < 0:
                break
        ends = [(i, j + len(q)) for i, s in enumerate(seqs) for j in range(len(s)) if s[j:j + len(q)] == q]
        assert (v < 0 and not ends) or sam.places[v] == sorted(ends)


def test_contract_columns(spark, real_docs, edge_docs, empty_docs):
    phrases = list(lic.BASE_PHRASES)
    for docs in (real_docs, edge_docs):
        texts = docs.select("doc_id", "text").collect()
        got = lic.scan(docs).collect()
        assert len(got) == len(texts)
        key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], str(r[3]))
        want = []
        for doc_id, text in texts:
            words = plain_words(text)
            at = places(words, phrases)
            starts = [i for i, _ in at]
            want.append((doc_id, len(words), len(at), min(starts, default=None), max(starts, default=None),
                         sorted({lic.BASE_PHRASES[phrases[k]] for _, k in at})))
        mine = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got]
        assert sorted(mine, key=key) == sorted(want, key=key)
        assert all(set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1 for r in got)
    assert lic.scan(empty_docs).count() == 0


def test_cut_and_edited_notice(spark):
    s = lic.Scanner()
    edited = ("Permission is hereby granted, FREE of charge, to any person\n obtaining a copy of this software and its "
              "associated documentation files (the Software), to deal in the Software without limitation")
    row = lic.scan_text(s, "some text before " + edited + " after")
    assert row[5] == ["mit"] and row[1] == 0 and 0.75 <= row[6] < 1
    assert lic.scan_text(s, "permission to use the software for a copy of the files")[5] == []


def test_stray_run_does_not_break_a_chain():
    s = lic.Scanner({}, [("t", "a b c d e f g h i j k l m n o p")])
    for text in ("a b c d e f g h b c d i j k l m n o p", "b c d a b c d e f g h n o p i j k l m n o p"):
        (found,) = s.scan(text)[2]
        assert found[3] == 16 and text.split()[found[1]:found[2]][-1] == "p" and text.split()[found[1]] == "a"


def every_chain(matches, gap):
    """Most words that any chain of the matches covers, by trying all chains."""
    def go(last, covered):
        yield covered
        for j in range(last + 1, len(matches)):
            s, e, a, b, n = matches[j]
            _, pe, _, pb, _ = matches[last]
            if e > pe and b > pb and s - pe <= gap and a - pb <= gap:
                yield from go(j, covered + min(b - pb, e - pe, n))

    return max((c for i, m in enumerate(matches) for c in go(i, m[4])), default=0)


def test_best_chains_equal_exhaustive_search():
    rnd = random.Random(8)
    seen = 0
    for _ in range(250):
        words = [rnd.choice("abcdefgh") for _ in range(rnd.randint(6, 14))]
        pieces = []
        for _ in range(rnd.randint(1, 4)):  # cut, repeated, reordered and stray stretches of the template
            a = rnd.randrange(len(words) - 2)
            pieces += words[a:a + rnd.randint(2, 7)] + [rnd.choice("abz") for _ in range(rnd.randint(0, 3))]
        s = lic.Scanner({}, [("t", " ".join(words))])
        captured = []
        s._chains = lambda runs: captured.append(runs) or []
        s.scan(" ".join(pieces))
        matches = [(end - n, end, t - n, t, n) for end, n, state in captured[0] for _, t in s.sam.places[state] if t >= n]
        best = max((c for c, *_ in lic.best_chains(matches)), default=0)
        assert best == every_chain(matches, lic.MAX_GAP)
        seen += best > 5
        spans = lic.Scanner({}, [("t", " ".join(words))]).scan(" ".join(pieces))[2]
        assert bool(spans) == (best >= lic.MIN_COVER * len(words))
        assert all(x[2] <= y[1] for x, y in zip(spans, spans[1:]))
    assert seen > 50


def test_whole_license_texts(spark):
    mit = next(t for label, t in lic.TEMPLATES if label == "mit" and len(t) > 800)
    row = lic.scan_text(lic.Scanner(), "Copyright (c) 2020 somebody\n" + mit.replace("AUTHORS OR COPYRIGHT", "AUTHORS, OWNERS OR COPYRIGHT"))
    assert "mit" in row[5] and any(s["end"] - s["start"] > 150 for s in row[7])
