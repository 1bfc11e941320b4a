"""Tokens, packing, secrets: against plain versions, with odd rows."""

import hashlib
import json
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from gridtally.llm import bpe, packing, queries, secrets

RANKS = queries.MULTILINGUAL_RANKS
LONG = "lorem ipsum 12,5 " * 20_000 + "x" * 50_000
ODD = [
    (1, "Hello world's  end\n\n  naïve 你好 <|endoftext|>"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, LONG),
    (6, "same same"),
    (6, "same same"),
    (None, "no id"),
    (None, None),
    (7, "emoji 👩‍👩‍👧 \x00 İ token='abcdefghijkl' \x1c"),
]
SCHEMA = "doc_id long, text string, block string, ids string, part int, data int, spans int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*row, "b", "i", 1, 2, 3) for row in ODD], SCHEMA).repartition(3)


def own_encoding(path):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={}
    )


@pytest.mark.parametrize("block_chars", [10, 16_000_000])
def test_ids_equal_the_library_and_decode_to_the_text(odd, block_chars):
    reference = own_encoding(RANKS)
    encoded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN, block_chars=block_chars, groups=5)
    found = bpe.decode(encoded, RANKS).collect()
    wanted = [(i, reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in ODD]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in found), key=key) == sorted(wanted, key=key)


def test_no_word_is_encoded_twice(spark, monkeypatch):
    """All words of all blocks through the tasks' own code, with a count of what is encoded."""
    texts = [" ".join(f"word{(i * j) % 97}" for j in range(200)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    blocks = docs.mapInArrow(bpe._cutter(public_tokenizers.PATTERN, 6, 3_000), "block long, parts array<binary>").collect()
    rows = sorted(
        (part, r.block, bytes(data)) for r in blocks for part, data in enumerate(r.parts) if part and len(data)
    )
    encoded = []

    class Counted:
        def __init__(self, *args, **kwargs):
            self._core_bpe = self

        def encode_single_piece(self, word):
            encoded.append(word)
            return [0]

    monkeypatch.setattr(bpe.tiktoken, "Encoding", Counted)
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([r[1] for r in rows[at : at + 7]]), pa.array([r[0] for r in rows[at : at + 7]], pa.int32()),
             pa.array([r[2] for r in rows[at : at + 7]], pa.binary())], names=["block", "part", "data"])
        for at in range(0, len(rows), 7)
    ]
    list(bpe._word_encoder(RANKS, public_tokenizers.PATTERN)(iter(batches)))
    words = {w.encode() for t in texts for w in regex.findall(public_tokenizers.PATTERN, t)}
    assert len(blocks) > 4 and sorted(encoded) == sorted(words)


def test_encoding_of_no_rows(spark, odd):
    assert bpe.encode(odd.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_op1_columns(spark):
    folder = "/root/testdata/sf0.001"
    reference = own_encoding(RANKS)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op1_byte_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = reference.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def checked_packing(rows, wanted, capacity):
    """Every id lies in one piece, pieces fill sequences without a gap; returns the padding."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for key, pieces in docs.items():
        pieces.sort(key=lambda r: r.start)
        assert [i for r in pieces for i in r.ids] == wanted[key]
        assert [r.start for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
        assert {r.doc_tokens for r in pieces} == {len(wanted[key])}
    padding = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in pieces])
        assert [r.offset for r in pieces] == [0, *ends[:-1]]
        assert ends[-1] <= capacity
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else capacity - ends[-1]
    assert set(docs) == set(wanted)
    return padding


def test_added_tokens_get_the_ids_of_the_tokenizer_as_loaded(spark, tmp_path):
    tokenizer = Tokenizer.from_file(queries.PACKING_TOKENIZER)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> \n<|endoftext|><|endoftext|>y  ", "<|endoftext|", *(t or "" for _, t in ODD)]
    wanted = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert wanted[0] == [64, 50256, 65]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    rows = queries.op4_cost_packing(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {i: len(ids) + 1 for i, ids in wanted.items()}
    for r in rows:
        assert r.ids_crc32 == crc([*wanted[r.doc_id], 0][r.start : r.start + r.length])
    for r in corpus_pipeline.pack(spark, docs, str(tmp_path)).collect():
        assert r.ids == [*wanted[r.doc_id], 0][r.start : r.start + r.length]


def test_the_longest_added_token_is_taken(tmp_path):
    content = json.loads(open(queries.PACKING_TOKENIZER, encoding="utf-8").read())
    token = content["added_tokens"][0]
    content["added_tokens"] += [token | {"id": 50257, "content": "<|end"}, token | {"id": 50258, "content": "of <|"}]
    path = tmp_path / "own.json"
    path.write_text(json.dumps(content), encoding="utf-8")
    text = "a <|endoftext|> <|end of <|endoftext|>"
    found = packing.encoder(str(path), public_tokenizers.PATTERN, added=True)(text)
    assert found == Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids
    content["added_tokens"][0]["lstrip"] = True
    path.write_text(json.dumps(content), encoding="utf-8")
    with pytest.raises(ValueError):
        packing.encoder(str(path), public_tokenizers.PATTERN, added=True)


@pytest.mark.parametrize(("capacity", "block_chars"), [(64, 100), (1024, 8_000_000)])
def test_packing_of_odd_rows(odd, capacity, block_chars):
    tokenizer = Tokenizer.from_file(queries.PACKING_TOKENIZER)
    tokenizer.encode_special_tokens = True
    rows = packing.pack(
        odd.where("doc_id <> 6"), queries.PACKING_TOKENIZER, public_tokenizers.PATTERN, capacity,
        block_chars=block_chars,
    ).collect()
    wanted = {
        i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for i, t in ODD if i is not None and i != 6
    }
    assert checked_packing(rows, wanted, capacity) == 0


def test_packing_keeps_repeated_and_nameless_rows(odd):
    rows = packing.pack(odd, queries.PACKING_TOKENIZER, public_tokenizers.PATTERN).collect()
    assert sum(r.length for r in rows if r.doc_id == 6) == 2 * 3
    assert sum(r.length for r in rows if r.doc_id is None) == 3 + 1
    assert packing.pack(odd.limit(0), queries.PACKING_TOKENIZER, public_tokenizers.PATTERN).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=60), st.sampled_from([1, 8, 64]))
def test_dealt_pieces(lengths, capacity):
    pieces = packing.deal(lengths, capacity)
    own = {}
    for doc, start, n, seq, offset in pieces:
        own.setdefault(doc, []).append((start, n))
        assert 0 < n <= capacity and offset + n <= capacity
    for doc, n in enumerate(lengths):
        parts = sorted(own.get(doc, []))
        assert sum(p[1] for p in parts) == n
        assert all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:], strict=False))
    filled = {}
    for _, _, n, seq, _ in pieces:
        filled[seq] = filled.get(seq, 0) + n
    assert all(n & (n - 1) == 0 for n in filled.values())


def test_long_pieces_are_spread_by_cost():
    # two heavy documents do not share a sequence while a lighter one has room
    placed = {p[0]: p[3] for p in packing.deal([500, 500, 24, 500, 500, 24], 1024)}
    assert len({placed[0], placed[1]}) == 2


def test_op4_checksums(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pieces = packing.pack(docs, queries.PACKING_TOKENIZER, public_tokenizers.PATTERN)
    wanted = {
        (r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in pieces.collect()
    }
    found = {(r.doc_id, r.start): r.ids_crc32 for r in queries.op4_cost_packing(spark, folder).collect()}
    assert found == wanted


def plain_spans(text):
    """The base kinds by scanning each pattern over the whole text."""
    found = [(m.start(), m.end(), "assign") for m in secrets.ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), "access") for m in secrets.ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), m.end(), "hex") for m in secrets.HEX.finditer(text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


WORDS = ["password", "PassWd", "api_key", "APIKEY", "token", "secret", "=", ":", '"', " ", "AKIA", "akia",
         "0123456789abcdef", "ABCDEF", "deadbeef", "zz", "İ", "K", "ſecret", "a", "X9", "\n", "é", "ghp_"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=30).map("".join))
def test_base_kinds_equal_a_plain_scan(text):
    automaton = secrets.keyword_automaton.cached = getattr(
        secrets.keyword_automaton, "cached", None
    ) or secrets.keyword_automaton()
    found = [s for s in secrets.scan(text, automaton) if s[2] in secrets.BASE_KINDS]
    assert found == plain_spans(text)


def test_tokens_with_checksum():
    automaton = secrets.keyword_automaton()
    body = "aB3" * 10
    good = "ghp_" + body + secrets.checksum62(body)
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert secrets.scan(f"x {good} y", automaton) == [(2, 2 + len(good), "github")]
    assert secrets.scan(f"x {bad} y", automaton) == []
    assert [s[2] for s in secrets.scan("npm_" + good[4:], automaton)] == ["npm"]


def test_secrets_of_odd_rows(spark, odd):
    found = {(r.doc_id, len(r.spans)) for r in secrets.find_secrets(odd).collect()}
    assert found == {(i, len(plain_spans(t or ""))) for i, t in ODD}
    assert secrets.find_secrets(odd.limit(0)).collect() == []
    clean = secrets.redact(odd)
    assert clean.schema == odd.schema and clean.count() == odd.count()
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[2] is None and texts[5] == LONG
    assert "abcdefghijkl" not in texts[7] and "[SECRET]" in texts[7]


def test_op10_columns(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in queries.op10_secret_scan(spark, folder).collect():
        spans = plain_spans(texts[row.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert row.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(s[2] == k for s in spans) for k in secrets.BASE_KINDS
        ]
        assert set(filter(None, line.split(","))) <= set(row.spans.split(","))


def test_patterns_stay_linear():
    assert re.search(secrets.ASSIGN, "token" + " " * 100_000) is None
