"""Byte-level BPE: every distinct word of the corpus is encoded once.

Documents are cut into pre-tokens.  A block of documents keeps its sequence of
word numbers, which are the positions; its distinct words go, in groups dealt by
the word's hash, through one shuffle in which equal words of all blocks meet and
are encoded once.  The ids are joined back to the block, and the sequence puts them
in place.  Rows of the shuffles carry a group of words, not one word, so that they
stay compact; there are more groups where there is more text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, pack_ints, runs, texts, unpack_ints

#: Characters of one block; bounds the memory of a task.
BLOCK_CHARS = 6_000_000
#: Characters of the corpus per group of words; bounds the words that a task remembers.
GROUP_CHARS = 16_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The token-byte table: one line per token, base64 bytes and id."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _pack_words(words: list[bytes]) -> bytes:
    lengths = np.array([len(w) for w in words], dtype="<u4")
    return zstandard.compress(
        np.uint32(len(words)).tobytes() + lengths.tobytes() + b"".join(words), 3
    )


def _unpack_words(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4)).tolist()
    body, starts = raw[4 + 4 * n :], [0, *ends[:-1]]
    return [body[a:b] for a, b in zip(starts, ends, strict=True)]


def _cutter(pattern: str, groups: int, block_chars: int):
    schema = pa.schema([("block", pa.int64()), ("parts", pa.list_(pa.binary()))])

    def block_row(number: int, ids: list, seqs: list, known: dict[str, int]) -> pa.RecordBatch:
        words = [w.encode() for w in known]
        group = np.fromiter(
            (xxhash.xxh32_intdigest(w) % groups for w in words), np.int64, len(words)
        )
        sequence = np.concatenate(seqs) if seqs else np.empty(0, np.uint32)
        head = [
            np.array([i if i is not None else 0 for i in ids], "<i8").tobytes(),
            np.array([i is None for i in ids], np.uint8).tobytes(),
            pack_ints(np.array([len(s) for s in seqs], np.uint32)),
            pack_ints(group.astype(np.uint32)),
            pack_ints(sequence),
        ]
        parts = [_pack_words(head)] + [b""] * groups
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(groups + 1))
        for g in range(groups):
            if cuts[g] < cuts[g + 1]:
                parts[g + 1] = _pack_words([words[i] for i in order[cuts[g] : cuts[g + 1]]])
        return batch(schema, [[number], [parts]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        number = TaskContext.get().partitionId() << 32
        ids, seqs, known, chars = [], [], {}, 0
        for rows in batches:
            for key, text in zip(rows.column(0).to_pylist(), texts(rows.column(1)), strict=True):
                words = find(text)
                ids.append(key)
                seqs.append(
                    np.fromiter(
                        (known.setdefault(w, len(known)) for w in words), np.uint32, len(words)
                    )
                )
                chars += len(text)
                if chars >= block_chars or len(ids) >= 100_000:
                    yield block_row(number, ids, seqs, known)
                    number += 1
                    ids, seqs, known, chars = [], [], {}, 0
        if ids:
            yield block_row(number, ids, seqs, known)

    return cut


def _word_encoder(ranks_path: str, pattern: str):
    schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("data", pa.binary())])

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={}
        )._core_bpe
        known: dict[bytes, list[int]] = {}
        now = None
        for rows in batches:
            out = []
            for part, data in zip(rows.column(1).to_pylist(), rows.column(2)):
                # a word is in one group, and the rows of a group come one after the other
                if part != now:
                    now, known = part, {}
                ids = []
                for word in _unpack_words(data.as_py()):
                    if word not in known:
                        known[word] = bpe.encode_single_piece(word)
                    ids.append(known[word])
                counts = np.array([len(x) for x in ids], np.uint32)
                flat = np.array([i for x in ids for i in x], np.uint32)
                out.append(_pack_words([pack_ints(counts), pack_ints(flat)]))
            yield batch(schema, [rows.column(0), rows.column(1), out])

    return encode_words


def _reassembler():
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for head, found in zip(rows.column(0), rows.column(1), strict=True):
                keys, absent, lengths, group, sequence = _unpack_words(head.as_py())
                lengths, group, sequence = map(unpack_ints, (lengths, group, sequence))
                places = np.argsort(group, kind="stable")
                counts, starts = (np.zeros(len(group), np.int64) for _ in range(2))
                flat, filled, tokens = [], 0, 0
                for piece in sorted(found.as_py() or [], key=lambda p: p["part"]):
                    n, ids = map(unpack_ints, _unpack_words(piece["data"]))
                    own = places[filled : filled + len(n)]
                    counts[own] = n
                    starts[own] = tokens + np.cumsum(n, dtype=np.int64) - n
                    flat.append(ids)
                    filled, tokens = filled + len(n), tokens + len(ids)
                if filled != len(group):
                    raise RuntimeError("a block's words and their ids differ in number")
                table = np.concatenate(flat).astype(np.int32) if flat else np.empty(0, np.int32)
                each = counts[sequence]
                ids = table[runs(starts[sequence], each)]
                ends = np.concatenate([[0], np.cumsum(each)])[
                    np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                ]
                key = pa.array(
                    np.frombuffer(keys, "<i8"), pa.int64(), mask=np.frombuffer(absent, np.uint8) > 0
                )
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(ids, pa.int32())
                )
                for at in range(0, len(lengths), 500):
                    yield batch(schema, [key[at : at + 500], lists[at : at + 500]])

    return reassemble


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    groups: int | None = None,
) -> DataFrame:
    """One row per document: ``doc_id`` and its ``ids`` (array of int).

    A NULL or empty text has no ids; NULL and repeated document ids are kept
    row by row; an empty table gives an empty result.  Other columns are not
    read.  ``groups`` is the number of word groups that are dealt out; by default it
    grows with the corpus, one per ``GROUP_CHARS``, and no word is encoded twice.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if groups is None:
        chars = docs.agg(F.sum(F.length(F.col(text_col)).cast("long"))).first()[0] or 0
        groups = max(partitions, -(-chars // GROUP_CHARS))
    blocks = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        _cutter(pattern, groups, block_chars), "block long, parts array<binary>"
    )
    # one shuffle for both uses; the plan reuses it
    dealt = blocks.repartition("block")
    parts = dealt.select("block", F.posexplode("parts").alias("part", "data"))
    words = parts.where((F.col("part") > 0) & (F.length("data") > 0))
    words = words.repartition(min(groups, 8 * partitions), "part").sortWithinPartitions("part")
    ids = (
        words.mapInArrow(
            _word_encoder(ranks_path, pattern), "block long, part int, data binary"
        )
        .groupBy("block")
        .agg(F.collect_list(F.struct("part", "data")).alias("found"))
    )
    heads = parts.where("part = 0").select("block", "data")
    return (
        heads.join(ids, "block", "left")
        .select("data", "found")
        .mapInArrow(_reassembler(), "doc_id long, ids array<int>")
    )


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Add ``decoded``, the bytes of ``ids``: a join with the token-byte table.

    The table is bounded by the vocabulary, so every task holds it whole and
    looks up by id.  NULL ids decode to no bytes; an id outside the table is an
    error.
    """
    fields = list(encoded.columns)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in encoded.schema)}"

    def decode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        for rows in batches:
            column = rows.column(fields.index("ids"))
            decoded = []
            for at in range(len(column)):
                ids = column[at].values
                own = [] if ids is None else ids.to_numpy(zero_copy_only=False).tolist()
                decoded.append(b"".join(map(tokens.__getitem__, own)))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(decoded, pa.binary())], names=[*fields, "decoded"]
            )

    return encoded.mapInArrow(decode_rows, f"{schema}, decoded binary")
