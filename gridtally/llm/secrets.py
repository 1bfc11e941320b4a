"""Secret scan: keyword automaton, anchored patterns near its hits, checksums.

One pass of an Aho-Corasick automaton over the lower-cased text finds keywords;
a pattern is tried only at the place a hit names.  Runs of hex digits have no
keyword, so all four-digit hex strings are keywords for them: a run of four or
more starts at its first hit.  Tokens that carry a checksum are reported only if
it holds.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, texts

KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]

ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

# Prefixes of tokens that end in a checksum of their body.
CHECKED = {"gho_": "github", "ghp_": "github", "ghr_": "github", "ghs_": "github",
           "ghu_": "github", "npm_": "npm"}
CHECKED_TOKEN = re.compile(r"(?:gh[oprsu]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """CRC-32 of the body in base 62, six digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def keyword_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for digits in itertools.product("0123456789abcdef", repeat=4):
        automaton.add_word("".join(digits), ("hex", 4))
    for word in ASSIGN_WORDS:
        automaton.add_word(word, ("assign", len(word)))
    automaton.add_word("akia", ("access", 4))
    for prefix, kind in CHECKED.items():
        automaton.add_word(prefix, (kind, len(prefix)))
    automaton.make_automaton()
    return automaton


def _lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def scan(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """The (start, end, kind) of all secrets, by start, then kind."""
    hits: dict[str, list[int]] = {}
    found, hex_end = [], 0
    for last, (kind, length) in automaton.iter(_lowered(text)):
        start = last + 1 - length
        if kind != "hex":
            hits.setdefault(kind, []).append(start)
        elif start >= hex_end and (match := HEX.match(text, start)):
            hex_end = match.end()
            if hex_end - start >= MIN_HEX:
                found.append((start, hex_end, "hex"))
    end = 0
    for start in sorted(hits.get("assign", ())):
        if start >= end and (match := ASSIGN.match(text, start)):
            end = match.end()
            if len(match[2]) >= MIN_ASSIGN:
                found.append((start, end, "assign"))
    end = 0
    for start in hits.get("access", ()):
        if start >= end and (match := ACCESS.match(text, start)):
            end = match.end()
            if end - start >= MIN_ACCESS:
                found.append((start, end, "access"))
    for kind in KINDS[3:]:
        for start in hits.get(kind, ()):
            match = CHECKED_TOKEN.match(text, start)
            if match and checksum62(match[1]) == match[2]:
                found.append((start, match.end(), kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of (kind, start, end).

    Places count code points, the end is exclusive.  The base kinds are found as
    a left-to-right scan of each pattern over the whole text would; a match that
    is too short still uses up its text.  NULL and empty texts have no spans;
    repeated rows are scanned each; NULL ids stay; an empty table gives an empty
    result.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("spans", pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
            ))),
        ]
    )

    def scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = keyword_automaton()
        for rows in batches:
            spans = [
                [{"kind": k, "start": a, "end": b} for a, b, k in scan(text, automaton)]
                for text in texts(rows.column(1))
            ]
            yield batch(schema, [rows.column(0), spans])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(
        scan_rows, "doc_id long, spans array<struct<kind:string,start:int,end:int>>"
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, every secret in ``text_col`` replaced by ``mark``.

    Spans that overlap are replaced as one.  NULL texts stay NULL; other columns
    are passed on unread.
    """
    at = docs.columns.index(text_col)

    def redact_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = keyword_automaton()
        for rows in batches:
            clean = []
            for value in rows.column(at):
                text = value.as_py()
                pieces, done = [], 0
                spans = scan(text, automaton) if text else []
                for start, end, _ in spans:
                    if start >= done:
                        pieces += [text[done:start], mark]
                    done = max(done, end)
                clean.append("".join([*pieces, text[done:]]) if spans else text)
            columns = list(rows.columns)
            columns[at] = pa.array(clean, rows.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=rows.schema)

    return docs.mapInArrow(redact_rows, docs.schema)


def spans_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of these kinds, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(
            chosen,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
