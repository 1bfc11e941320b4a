"""Chat formatting: round trips, masks, odd rows; fill-in-middle against a plain version."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from check_queries import compare, open_oracle
from gridtally.llm import chat, fim, queries

FOLDER = "/root/testdata/sf0.01"
PIECES = [*chat._STRINGS, "\\", " ", "a", "<", "[", "]", ">", "</", "<\\s>", "[\\\\INST]", "\n", "é", "\x00"]
said = st.lists(st.sampled_from(PIECES), max_size=9).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), said)


@pytest.mark.parametrize("name", ["op11_chat_format", "op13_fill_in_middle"])
def test_queries_equal_sql(spark, name):
    assert compare(spark, open_oracle(FOLDER), FOLDER, name) is None


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(roles, said), max_size=5))
def test_turns_come_back(turns):
    written = [chat.render_turn(*t) for t in turns]
    text = "".join(w for w, _, _ in written)
    found = list(chat.parse(text))
    assert [(r, t) for r, t, _, _ in found] == turns
    assert [chat.unescape(w[a:b]) for w, a, b in written] == [t for _, t in turns]
    # control strings only where the template has them
    assert len(chat.CONTROL.findall(text)) == sum(2 if r in chat.FRAMES else 3 for r, _ in turns)


def test_escape_only_where_needed():
    assert chat.render_turn("user", "a [b] <c> \\[") == ("[INST] a [b] <c> \\[ [/INST]", 7, 19)
    assert chat.render_turn("user", "</s>")[0] == "[INST] <\\/s> [/INST]"
    assert chat.render_turn("user", "<\\/s>")[0] == "[INST] <\\\\/s> [/INST]"


@pytest.mark.parametrize(
    "text", ["x", "[INST] a", "[INST]a[/INST]", "[INST] a </s>", "[/INST]", "[INST] a [/INST] ", "[INST] [/INST]"]
)
def test_text_outside_of_the_grammar_is_refused(text):
    with pytest.raises(chat.FormatError):
        list(chat.parse(text))


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


LONG = "lorem </s> ipsum " * 40_000
TURNS = [
    (1, 1, "assistant", "yes"), (1, 0, "user", None), (1, None, "system", "first"),
    (2, 0, None, "no role"), (2, 1, "tool [SEP]", "x [SEP] y"),
    (3, 0, "assistant", LONG), (3, 1, "assistant", ""), (3, 2, "user", LONG),
    (None, 0, "user", "no id"), (None, 0, "user", "no id"),
    (4, 0, "user", "b"), (4, 0, "user", "a"), (4, 0, "assistant", "c"),
]


@pytest.mark.parametrize("part_chars", [1, 60, 1_000_000])
def test_odd_conversations(spark, part_chars):
    rows = [(*t, "f", 1) for t in TURNS] + [(9, i, "user", f"turn {i}", "f", 1) for i in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, written string, part int")
    formatted = chat.format_conversations(frame.repartition(5), part_chars)
    found = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    again = {r.conv_id: r for r in chat.read_back(formatted, arranged=True).collect()}
    assert found == again and set(found) == {1, 2, 3, 4, 9, None}
    for conv, row in found.items():
        turns = [(t, r or "", x or "") for c, t, r, x, _, _ in rows if c == conv]
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, chat.render_turn(*t[1:])[0]))
        learned = [x for _, r, x in turns if r == "assistant"]
        assert row.n_turns == len(turns) and row.loss_chars == sum(map(len, learned))
        assert row.turns_sha256 == digest(f"{r}\n{x}\n" for _, r, x in turns)
        assert row.loss_sha256 == digest(learned)
        assert row.formatted_chars == sum(len(chat.render_turn(r, x)[0]) for _, r, x in turns)
    parts = formatted.where("conv_id = 9").count()
    assert parts == {1: 300, 60: 100, 1_000_000: 1}[part_chars]
    assert chat.read_back(chat.format_conversations(frame.limit(0))).collect() == []


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.sampled_from("\na\x0b\x8aé你😀")).map("".join), *[st.integers(0, 2**32 - 1)] * 2),
        max_size=7,
    )
)
def test_cuts_equal_plain_cuts(rows):
    raw = [t.encode() for t, _, _ in rows]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    draws = np.array([r[1:] for r in rows], np.int64).reshape(-1, 2)
    found = fim.cut_places(np.frombuffer(b"".join(raw), np.uint8), offsets, draws[:, 0], draws[:, 1])
    for (text, h1, h2), (n, left, right, before, between) in zip(rows, zip(*found)):
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
        prefix, middle = "".join(lines[:a]), "".join(lines[a:b])
        assert n == len(lines) and (before, between) == (len(prefix), len(middle))
        assert (left, right) == (len(prefix.encode()), len((prefix + middle).encode()))


def plain_fim(key, text, percent=100, spm=50):
    text = text or ""
    digits = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    x, y, z = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


@pytest.mark.parametrize("percent, piece", [(100, 8_000_000), (40, 10)])
def test_odd_texts(spark, monkeypatch, percent, piece):
    monkeypatch.setattr(fim, "PIECE_BYTES", piece)
    texts = [None, "", "one", "a\n", "\n", "\n\n<", "é\n你\n😀\n", "x<P>y\n", "<S>", "P>\nS>\nM>\n<", "a\r\nb\x0bc\x00\n",
             "line\n" * 100_000, "x" * 200_000, "same\nsame\n"]
    rows = [(k * len(texts) + i, t) for k in range(4) for i, t in enumerate(texts)]
    rows += [(None, "no\nid\n"), (None, "no\nid\n"), (5, "again\nagain"), (5, "again\nagain")]
    frame = spark.createDataFrame([(*r, "o", 1) for r in rows], "doc_id long, text string, output string, h1 int")
    made = fim.fill_in_middle(frame.repartition(3), percent=percent)
    found = made.withColumn("restored", fim.restored(made.output, made.form)).collect()
    key = lambda r: repr(r)
    wanted = [(i, *plain_fim(i, t, percent), t or "") for i, t in rows]
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)
    assert fim.fill_in_middle(frame.limit(0)).collect() == []
    assert len({r.form for r in found}) == 3
