"""Fill-in-middle: texts cut at line ends found eight bytes at a time.

The UTF-8 bytes of a batch of texts are viewed as 64-bit words.  Word arithmetic
marks the bytes that end a line, a bit count per word and its running sum tell in
which word the k-th line ends, and within the word the k-th mark is found by
taking lower marks away.  Code points are counted in the same way, by marking
the bytes that continue a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of text whose marks are held at once; a longer text is marked as a whole.
PIECE_BYTES = 8_000_000

_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_NEWLINES = np.uint64(0x0A0A0A0A0A0A0A0A)
_ONE = np.uint64(1)


def _words(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian words, filled up with zeros; one word more than needed."""
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def newline_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a newline, and no other bit."""
    different = words ^ _NEWLINES
    return ~(((different & _LOW7) + _LOW7) | different | _LOW7)


def continuation_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that continues a character (10xxxxxx)."""
    return words & ~(words << _ONE) & _HIGH


class Marks:
    """Marked bytes with their rank (how many lie before a place) and select (place of the k-th)."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, places: np.ndarray) -> np.ndarray:
        word, byte = places >> 3, (places & 7).astype(np.uint64)
        lower = (_ONE << (byte * np.uint64(8))) - _ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & lower)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th marked byte, from 1."""
        word = np.searchsorted(self.before, k, "left") - 1
        left, rest = self.marks[word], k - self.before[word]
        for _ in range(7):
            more = rest > 1
            if not more.any():
                break
            left = np.where(more, left & (left - _ONE), left)
            rest = rest - more
        lowest = left & (~left + _ONE)
        return (word << 3) + (np.bitwise_count(lowest - _ONE) >> 3)


def cut_places(
    data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray
) -> tuple[np.ndarray, ...]:
    """For the texts ``data[offsets[i]:offsets[i + 1]]``: number of lines, both cuts, code points before each.

    A cut is the byte after the smaller (greater) of h1 % (n + 1) and h2 % (n + 1) lines.
    """
    words = _words(data)
    lines, inner = Marks(newline_marks(words)), Marks(continuation_marks(words))
    start, end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    first = lines.rank(start)
    ended = lines.rank(end) - first
    tail = (end > start) & (data[np.maximum(end, 1) - 1] != 0x0A) if len(data) else np.zeros(len(start), bool)
    n = ended + tail
    a, b = h1 % (n + 1), h2 % (n + 1)

    def place(k: np.ndarray) -> np.ndarray:
        found = np.where(k == 0, start, end)
        within = (k > 0) & (k <= ended)
        found[within] = lines.select((first + k)[within]) + 1
        return found

    def chars(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return q - p - (inner.rank(q) - inner.rank(p))

    left, right = place(np.minimum(a, b)), place(np.maximum(a, b))
    return n, left - start, right - start, chars(start, left), chars(left, right)


def _pieces(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows of a string column of about ``PIECE_BYTES``: the rows, their bytes, their offsets."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + PIECE_BYTES, "right")) - 1)
        yield slice(first, last), data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def draws(id_col: Column, seed: int = 7) -> list[Column]:
    """h1 to h4: the first four groups of 8 digits of the hex sha256 of ``seed:id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
    percent: int = 100,
    spm_percent: int = 50,
) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts the lines.  Text is prefix, middle, suffix, cut at line ends that
    a hash of the id chooses; ``psm`` writes ``<P>prefix<S>suffix<M>middle``, ``spm``
    ``<S>suffix<P>prefix<M>middle``.  Empty and NULL texts and those that hold one of
    the three marks stay ``plain``, as do those that the hash puts beyond
    ``percent``; their counts are NULL.  ``prefix_chars`` and ``middle_chars`` count
    code points.  Repeated rows and ids are cut alike where their texts are alike;
    a NULL id is hashed as an empty one.  Other columns are not read.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
         ("middle_chars", pa.int64()), ("output", pa.string())]
    )
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    names = np.array([PLAIN, PSM, SPM])
    rate, spm_rate = percent, spm_percent

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            drawn = [rows.column(2 + i).to_numpy() for i in range(4)]
            for at, data, offsets in _pieces(rows.column(1)):
                h1, h2, h3, h4 = (h[at] for h in drawn)
                n, left, right, before, between = cut_places(data, offsets, h1, h2)
                raw, out = data.tobytes(), []
                form = np.where(h4 % 100 < spm_rate, 2, 1)
                form[(h3 % 100 >= rate) | (offsets[1:] == offsets[:-1])] = 0
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    text = raw[a:b]
                    if p in text or s in text or m in text:
                        form[i] = 0
                    first, middle, last = text[: left[i]], text[left[i] : right[i]], text[right[i] :]
                    if form[i] == 1:
                        text = b"".join([p, first, s, last, m, middle])
                    elif form[i] == 2:
                        text = b"".join([s, last, p, first, m, middle])
                    out.append(text)
                plain = form == 0
                yield batch(
                    schema,
                    [rows.column(0)[at], n, pa.array(names[form]), pa.array(before, mask=plain),
                     pa.array(between, mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *draws(F.col(id_col), seed)
    ).mapInArrow(
        transform,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of; the parts hold no marks, so the first ones found divide them."""

    def between(first: str, second: str) -> list[Column]:
        at, end = F.instr(output, second), F.instr(output, MIDDLE)
        return [
            F.substring(output, F.lit(len(first) + 1), at - (len(first) + 1)),
            F.substring(output, at + len(second), end - at - len(second)),
            F.substring(output, end + len(MIDDLE), F.length(output)),
        ]

    prefix, suffix, middle = between(PREFIX, SUFFIX)
    last, first, inner = between(SUFFIX, PREFIX)
    return (
        F.when(form == PSM, F.concat(prefix, middle, suffix))
        .when(form == SPM, F.concat(first, inner, last))
        .otherwise(output)
    )
