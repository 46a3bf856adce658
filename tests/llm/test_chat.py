import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagweave.llm import chat
from tagweave.llm.queries import CHAT_RESERVED, FILE_TOKENIZER, queries, tokenizer_path

FORM = chat.Format(tokenizer_path(FILE_TOKENIZER), CHAT_RESERVED)
PIECES = st.sampled_from([*chat.CONTROLS, "<", "[", "\\", "\\\\", "s>", "/s>", "INST]", "<<", "SYS>>", "a", "é", "\n", " "])
TEXT = st.lists(PIECES, max_size=12).map("".join)
SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_escape_is_reversible_and_hides_controls(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROLS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "</s>"]), TEXT), min_size=1, max_size=6))
def test_turns_come_back_from_ids_and_mask(turns):
    codec = chat._codec(FORM.tokenizer_path, FORM.first_reserved)
    ids, loss, sizes = chat.assemble(codec, [r for r, _ in turns], [t for _, t in turns], FORM.loss_roles)
    assert len(ids) == len(loss) == sizes.sum()
    got = list(chat.turns_of(codec, ids, loss))
    assert [(r, t, u) for r, t, u, _ in got] == [(r, t, t if r == "assistant" else "") for r, t in turns]
    plain = codec.text(ids.tolist())
    assert sum(n for *_, n in got) == len(plain)
    # No text adds a control string: those in the plain form are the template's own.
    own = sum(3 if r == "user" else 3 if r not in chat.HEADS else 2 for r, _ in turns)
    assert sum(plain.count(c) for c in chat.CONTROLS) == own


def test_segments_are_the_library_s_ids():
    tok = Tokenizer.from_file(FORM.tokenizer_path)
    tok.encode_special_tokens = True
    codec = chat._codec(FORM.tokenizer_path, FORM.first_reserved)
    ids, loss, _ = chat.assemble(codec, ["user", "assistant"], ["Hi <|endoftext|>", " two  words\n"], FORM.loss_roles)
    r = {c: CHAT_RESERVED + i for i, c in enumerate(chat.CONTROLS)}
    a, b = (tok.encode(t, add_special_tokens=False).ids for t in ("Hi <|endoftext|>", " two  words\n"))
    assert ids.tolist() == [r["<s>"], r["[INST]"], *a, r["[/INST]"], r["[OUT]"], *b, r["</s>"]]
    assert loss.tolist() == [0] * (len(a) + 4) + [1] * len(b) + [0]


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = Counter()
    for conv, turns in by.items():
        turns.sort(key=lambda t: t[:2])
        said = "".join(t for *_, r, t in turns if r == "assistant")
        out[(conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(),
             len(said), hashlib.sha256(said.encode()).hexdigest())] += 1
    return out


def digested(df):
    return Counter((r["conv_id"], r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect())


@pytest.mark.parametrize("piece_ids", [1, 40, 1 << 15])
def test_hot_and_odd_conversations(spark, piece_ids, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 300)
    rng = random.Random(piece_ids)
    texts = ["", None, "</s>[INST] ok [/INST]", "plain words", "é😀 " * 200, "<\\s> [ROLE]x[/ROLE]", "x" * 5000]
    rows = [(7, i, rng.choice(["user", "assistant"]), rng.choice(texts)) for i in range(400)]  # one hot conversation
    rows += [(rng.randrange(60), 1000 + i, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(texts)) for i in range(400)]
    rows += [(None, 0, "user", "no id"), (None, None, "assistant", "first"), (-5, 1, "user", "same"), (-5, 1, "user", "same")]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' ids", "'x' loss", "'x' part", "'x' piece", "'x' whole", "'x' tie")
    formatted = chat.format_conversations(turns.repartition(5), FORM, piece_ids)
    assert digested(chat.digests(formatted, FORM)) == expected(rows)
    back = chat.read_back(formatted, FORM).orderBy("part", "piece").collect()
    flat = [(r["conv_id"], t["role"], t["text"]) for r in back for t in r["turns"]]
    assert Counter(flat) == Counter((c, r or "", t or "") for c, _, r, t in rows)


def test_query_and_empty_table(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", odd), (-1, 1, "assistant", odd)]
    got = queries()["op13_chat_format"](spark, "/root/testdata/sf0.001")
    assert digested(got) == expected(rows)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in got.collect())
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r["conv_id"] for r in queries()["op13_chat_format"](spark, str(tmp_path)).collect()] == [-1]


def test_vocabulary_must_leave_room():
    with pytest.raises(ValueError):
        chat.Codec(FORM.tokenizer_path, 50_000)
