"""Sequence packing balanced by attention cost.

A piece of n tokens costs ``n + n * n / quadratic``: a linear part and the
attention inside its document.  Pieces are dealt in descending length, each to
the sequence of lowest cost that still has room.  Sequences of a block are as
many as its tokens fill exactly; what is left over makes sequences whose lengths
are powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, texts

#: Characters of text that are packed together; bounds the memory of a task.
BLOCK_CHARS = 8_000_000
#: The length at which attention costs as much as the linear part.
QUADRATIC = 1024


def json_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level tokenizer file as bytes and ids.

    The file writes bytes as printable characters: those that print stand for
    themselves, the others follow from code point 256 on.
    """
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letter = {chr(b): b for b in shown}
    letter |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content.get("added_tokens", [])}
    vocab = content["model"]["vocab"]
    return {bytes(letter[c] for c in t): i for t, i in vocab.items() if t not in special}


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a tokenizer file with their ids."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens", [])
    if any(t.get(flag) for t in tokens for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on their surroundings are not supported")
    return {t["content"]: t["id"] for t in tokens}


def encoder(path: str, pattern: str, added: bool) -> Callable[[str], list[int]]:
    """Text to ids; with ``added``, an added token of the file in a text is that token."""
    encode = tiktoken.Encoding(
        "own", pat_str=pattern, mergeable_ranks=json_ranks(path), special_tokens={}
    ).encode_ordinary
    tokens = added_tokens(path) if added else {}
    if not tokens:
        return encode
    # the longest of those that begin at the same place
    split = re.compile(f"({'|'.join(map(re.escape, sorted(tokens, key=len, reverse=True)))})").split

    def with_added(text: str) -> list[int]:
        ids = []
        for i, part in enumerate(split(text)):
            if i % 2:
                ids.append(tokens[part])
            else:
                ids += encode(part)
        return ids

    return with_added


def deal(lengths: list[int], capacity: int, quadratic: int = QUADRATIC) -> list[tuple]:
    """Pack documents of the given token counts: (document, start, length, sequence, offset).

    Every sequence is full: to ``capacity``, or to a power of two below it.  A
    document is cut only if no sequence has room for it whole.
    """
    pieces, total = [], sum(lengths)
    full = 0
    rest = []
    for doc, n in enumerate(lengths):
        for at in range(0, n - n % capacity, capacity):
            pieces.append((doc, at, capacity, full, 0))
            full += 1
        if n % capacity:
            rest.append((n % capacity, doc, n - n % capacity))
    left = total - full * capacity
    room = [capacity] * (left // capacity)
    room += [1 << b for b in range(capacity.bit_length(), -1, -1) if left % capacity >> b & 1]
    size = list(room)
    room, size = np.array(room), np.array(room)
    cost = np.zeros(len(room))
    rest.sort(key=lambda r: (-r[0], r[1]))
    for n, doc, at in rest:
        while n:
            fits = np.where(room >= n, cost, np.inf)
            seq = int(fits.argmin())
            if fits[seq] == np.inf:
                # no room for it whole: fill the roomiest sequence
                seq = int(room.argmax())
            take = min(n, int(room[seq]))
            pieces.append((doc, at, take, full + seq, int(size[seq] - room[seq])))
            room[seq] -= take
            cost[seq] += take + take * take / quadratic
            n, at = n - take, at + take
    return pieces


def _packer(
    tokenizer_path: str, pattern: str, capacity: int, end_id: int, block_chars: int, added: bool
):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.list_(pa.int32())),
            ("doc_tokens", pa.int64()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
        ]
    )

    def packed(keys: list, docs: list, pieces: list, first: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(pieces), 2000):
            part = pieces[at : at + 2000]
            lists = [docs[d][s : s + n] for d, s, n, _, _ in part]
            yield batch(
                schema,
                [
                    [keys[p[0]] for p in part],
                    [p[1] for p in part],
                    [p[2] for p in part],
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, lists)]), pa.int32()),
                        pa.array(np.concatenate(lists), pa.int32()),
                    ),
                    [len(docs[p[0]]) for p in part],
                    [first + p[3] for p in part],
                    [p[4] for p in part],
                ],
            )

    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, pattern, added)
        first = TaskContext.get().partitionId() << 40
        keys, docs, chars = [], [], 0
        for rows in batches:
            for key, text in zip(rows.column(0).to_pylist(), texts(rows.column(1)), strict=True):
                keys.append(key)
                docs.append(np.array([*encode(text), end_id], np.int32))
                chars += len(text) + 1
                if chars >= block_chars:
                    pieces = deal([len(d) for d in docs], capacity)
                    yield from packed(keys, docs, pieces, first)
                    first += 1 + max(p[3] for p in pieces)
                    keys, docs, chars = [], [], 0
        if keys:
            yield from packed(keys, docs, deal([len(d) for d in docs], capacity), first)

    return pack_rows


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    capacity: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    added: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Tokens follow the given byte-level tokenizer, to which no special tokens are
    added; every document ends with ``end_id``, so that a NULL or empty text is
    one token.  With ``added``, the added tokens of the file that a text holds
    get their own ids, as by the tokenizer as loaded; else they are ordinary text.
    ``capacity`` is a power of two.  Repeated rows are packed each; a NULL id
    stays NULL; an empty table gives no piece.  Blocks of documents are packed
    where they are read, without a shuffle; sequence ids are unique, not dense.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity is a power of two")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        _packer(tokenizer_path, pattern, capacity, end_id, block_chars, added),
        "doc_id long, start long, length long, ids array<int>, doc_tokens long, "
        "sequence_id long, offset long",
    )


def with_crc32(pieces: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``, over unsigned 32-bit little-endian ids."""
    names = [c for c in pieces.columns if c != "ids"]
    fields = ", ".join(f"`{n}` {pieces.schema[n].dataType.simpleString()}" for n in names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            column = rows.column("ids")
            crc = [
                zlib.crc32(column[i].values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
                for i in range(len(column))
            ]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(n) for n in names), pa.array(crc, pa.int64())],
                names=[*names, "ids_crc32"],
            )

    return pieces.mapInArrow(digest, f"{fields}, ids_crc32 long")
