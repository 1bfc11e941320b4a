"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read as windows of bytes; in each, one network reads forwards and one
backwards.  Every position gets log-probabilities of the languages, and the mean
over all positions of a document gives its probabilities.  Training is
backpropagation through time, in numpy, on a bounded sample of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import free_names, raw_texts, runs, share_of_hash

HIDDEN = 8
#: Bytes that the network reads in one go.
WINDOW = 256
#: Windows that are read side by side; bounds the memory of a task.
SIDE_BY_SIDE = 2048
#: Bytes of a window to learn from; every text is cut into such windows as a whole.
TRAIN_WINDOW = 48
#: Bounds of the sample: languages, the most frequent ones, and windows of each.
MOST_LANGUAGES = 64
PER_LANGUAGE = 1200
STEPS = 400
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")


@dataclass
class Direction:
    """Weights of one gated recurrent layer: gates z and r, candidate n."""

    table: np.ndarray  # bytes x 3 hidden, with biases
    recurrent: np.ndarray  # 3 hidden x hidden


@dataclass
class Network:
    languages: list[str]
    forwards: Direction
    backwards: Direction
    out: np.ndarray  # languages x 2 hidden
    bias: np.ndarray  # languages


def read(layer: Direction, data: np.ndarray, lengths: np.ndarray | None = None, keep: bool = False):
    """States (position, hidden, window) of data (position, window).

    ``lengths`` in descending order limits each position to the windows that
    reach it.  With ``keep`` also the gates, for training.
    """
    size, width = data.shape
    hidden = layer.recurrent.shape[1]
    table = np.ascontiguousarray(layer.table.T)
    states = np.zeros((size, hidden, width), np.float32)
    gates = []
    state = np.zeros((hidden, width), np.float32)
    for t in range(size):
        n = width if lengths is None else int(np.searchsorted(-lengths, -t, side="left"))
        state = state[:, :n]
        x = np.take(table, data[t, :n], axis=1)
        g = layer.recurrent @ state
        zr = x[: 2 * hidden] + g[: 2 * hidden]
        zr *= 0.5
        np.tanh(zr, zr)
        zr += 1.0
        zr *= 0.5
        candidate = zr[hidden:] * g[2 * hidden :]
        candidate += x[2 * hidden :]
        np.tanh(candidate, candidate)
        if keep:
            gates.append((state, zr, candidate, g[2 * hidden :]))
        state = (state - candidate) * zr[:hidden]
        state += candidate
        states[t, :, :n] = state
    return (states, gates) if keep else states


def _unread(layer: Direction, data: np.ndarray, gates: list, above: np.ndarray):
    """Gradients of the layer, through time, given those of its states."""
    hidden = layer.recurrent.shape[1]
    d_table = np.zeros_like(layer.table)
    d_recurrent = np.zeros_like(layer.recurrent)
    carried = np.zeros_like(above[0])
    for t in range(len(data) - 1, -1, -1):
        before, zr, candidate, inner = gates[t]
        z, r = zr[:hidden], zr[hidden:]
        d_state = above[t] + carried
        d_candidate = d_state * (1 - z) * (1 - candidate**2)
        d_z = d_state * (before - candidate) * z * (1 - z)
        d_r = d_candidate * inner * r * (1 - r)
        d_x = np.concatenate([d_z, d_r, d_candidate])
        d_g = np.concatenate([d_z, d_r, d_candidate * r])
        np.add.at(d_table, data[t], d_x.T)
        d_recurrent += d_g @ before.T
        carried = d_state * z + layer.recurrent.T @ d_g
    return d_table, d_recurrent


def _log_softmax(logits: np.ndarray, axis: int) -> np.ndarray:
    logits = logits - logits.max(axis=axis, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=axis, keepdims=True))


def untrained(languages: list[str]) -> Network:
    rng = np.random.default_rng(3)

    def weights(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.3, shape).astype(np.float32)

    def layer() -> Direction:
        return Direction(weights(256, 3 * HIDDEN), weights(3 * HIDDEN, HIDDEN))

    n = len(languages)
    return Network(languages, layer(), layer(), weights(n, 2 * HIDDEN), np.zeros(n, np.float32))


def parameters(net: Network) -> list[np.ndarray]:
    """All weights, to be changed in place."""
    layers = [a for d in (net.forwards, net.backwards) for a in (d.table, d.recurrent)]
    return [*layers, net.out, net.bias]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS) -> Network:
    """Fit on windows (n, bytes) and the index of each one's language."""
    rng = np.random.default_rng(7)
    n_out = len(languages)
    net = untrained(languages)
    params = parameters(net)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    by_language = [np.flatnonzero(labels == k) for k in range(n_out)]
    by_language = [rows for rows in by_language if len(rows)]
    for step in range(1, steps + 1):
        # as many windows of each language
        chosen = np.concatenate([rng.choice(rows, 64) for rows in by_language])
        data = np.ascontiguousarray(windows[chosen].T)
        wanted = np.zeros((n_out, len(chosen)), np.float32)
        wanted[labels[chosen], np.arange(len(chosen))] = 1.0
        ahead, kept_ahead = read(net.forwards, data, keep=True)
        back, kept_back = read(net.backwards, data[::-1], keep=True)
        back = back[::-1]
        both = np.concatenate([ahead, back], axis=1)
        logits = np.matmul(net.out, both) + net.bias[:, None]
        wrong = (np.exp(_log_softmax(logits, 1)) - wanted) / (logits.shape[0] * logits.shape[2])
        d_out = np.einsum("tlb,thb->lh", wrong, both)
        d_both = np.matmul(net.out.T, wrong)
        d_ahead = _unread(net.forwards, data, kept_ahead, d_both[:, :HIDDEN])
        d_back = _unread(net.backwards, data[::-1], kept_back, d_both[::-1, HIDDEN:])
        rate = 0.02 * (1.0 - 0.9 * step / steps)
        gradients = [*d_ahead, *d_back, d_out, wrong.sum(axis=(0, 2))]
        for p, g, (mean, square) in zip(params, gradients, moments, strict=True):
            g = np.clip(g, -1.0, 1.0)
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            p -= (
                rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
            ).astype(np.float32)
    return net


def pooled(net: Network, documents: list[bytes]) -> np.ndarray:
    """Probabilities (document, language): the mean over positions of log-probabilities.

    Every byte of every document is read.  A document without bytes has even
    probabilities.
    """
    sizes = np.array([len(d) for d in documents], np.int64)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(documents)), counts)
    first = np.cumsum(sizes) - sizes
    part = runs(np.zeros(len(counts), np.int64), counts)
    start = first[owner] + part * WINDOW
    length = np.minimum(WINDOW, sizes[owner] - part * WINDOW)
    data = np.frombuffer(b"".join(documents) + bytes(WINDOW), np.uint8)
    total = np.zeros((len(documents), len(net.languages)))
    order = np.argsort(-length, kind="stable")
    for at in range(0, len(order), SIDE_BY_SIDE):
        chosen = order[at : at + SIDE_BY_SIDE]
        n = length[chosen]
        span = np.arange(int(n[0]))
        ahead = read(net.forwards, data[start[chosen] + span[:, None]], n)
        # the same windows from their last byte to their first
        turned = np.maximum(n - 1 - span[:, None], 0)
        back = read(net.backwards, data[start[chosen] + turned], n)
        back = back[turned, :, np.arange(len(n))].transpose(0, 2, 1)
        logits = np.matmul(net.out[:, :HIDDEN], ahead) + np.matmul(net.out[:, HIDDEN:], back)
        scores = _log_softmax(logits + net.bias[:, None], 1)
        scores *= (span[:, None] < n)[:, None, :]
        np.add.at(total, owner[chosen], scores.sum(axis=0).T)
    return np.exp(_log_softmax(total / np.maximum(sizes, 1)[:, None], 1))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: remainder 1 of the id's checksum by 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Network:
    """Train on at most ``per_language`` windows of each language, chosen by a hash of id and place.

    All windows of ``TRAIN_WINDOW`` bytes of the whole texts are chosen from; the
    last one of a text, or a short text, is repeated up to that length.  Held-out
    documents and NULL ids, texts and languages are left out; repeated rows count
    once each.  At most ``MOST_LANGUAGES`` languages are learned, those with most
    windows, so the sample is bounded.  Where no row is left the network knows
    :data:`UNKNOWN` only.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).cast("binary").alias("_text"),
        F.col(lang_col).alias("_lang"),
    ).where(
        F.col("_id").isNotNull()
        & F.col("_lang").isNotNull()
        & ~held_out(F.col("_id"))
        & (F.length("_text") > 0)
    )
    last = F.floor((F.length("_text") - 1) / TRAIN_WINDOW).cast("int")
    sizes = rows.groupBy("_lang").agg(F.sum(last + 1).alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "_lang").limit(MOST_LANGUAGES).collect()
    windows = rows.where(F.col("_lang").isin([lang for lang, _ in sizes])).select(
        "_id", "_lang", "_text", F.explode(F.sequence(F.lit(0), last)).alias("_at")
    )
    # their numbers thin the windows out before they are cut and shuffled
    mix = F.xxhash64("_id", "_at")
    few = F.lit(False)
    for lang, n in sizes:
        few = few | ((F.col("_lang") == lang) & share_of_hash(mix, per_language, n))
    cut = windows.where(few).select(
        "_id", "_lang", mix.alias("_mix"), F.substring("_text", F.col("_at") * TRAIN_WINDOW + 1, F.lit(TRAIN_WINDOW)).alias("_bytes")
    )
    ranked = cut.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_lang").orderBy("_mix", "_id", "_bytes"))
    )
    sample = ranked.where(F.col("_rank") <= per_language).select("_lang", "_rank", "_bytes")

    def train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            (r["_lang"], r["_rank"], r["_bytes"]) for part in batches for r in part.to_pylist()
        )
        if not rows:
            return
        languages = sorted({lang for lang, _, _ in rows})
        filled = b"".join((data * TRAIN_WINDOW)[:TRAIN_WINDOW] for _, _, data in rows)
        windows = np.frombuffer(filled, np.uint8).reshape(-1, TRAIN_WINDOW)
        net = train(windows, np.array([languages.index(lang) for lang, _, _ in rows]), languages)
        weights = [p.astype("<f4").tobytes() for p in parameters(net)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([languages], pa.list_(pa.string())), pa.array([weights], pa.list_(pa.binary()))],
            names=["languages", "weights"],
        )

    # the sample is bounded, so one task holds it; the driver gets the network alone
    found = sample.repartition(1).mapInArrow(
        train_rows, "languages array<string>, weights array<binary>"
    ).collect()
    if not found:
        return train(np.zeros((0, TRAIN_WINDOW), np.uint8), np.zeros(0, int), [UNKNOWN], steps=0)
    net = untrained(found[0]["languages"])
    for place, data in zip(parameters(net), found[0]["weights"], strict=True):
        place[...] = np.frombuffer(data, "<f4").reshape(place.shape)
    return net


def with_language(
    docs: DataFrame, net: Network, text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs``, the predicted language ``_lang`` and its probability ``_score``.

    The names get further underscores where ``docs`` has them.  Only the text is read.  A NULL text or one without a letter is ``und`` with
    score 0; repeated rows are read each; an empty table gives an empty result.
    """
    at = docs.columns.index(text_col)
    names = free_names(docs, "_lang", "_score")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            documents = list(raw_texts(rows.column(at)))
            found = pooled(net, documents)
            best = found.argmax(axis=1)
            lettered = [LETTER.search(d.decode()) is not None for d in documents]
            languages = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
            scores = np.where(lettered, found[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=[*rows.schema.names, *names],
            )

    added = [StructField(names[0], StringType()), StructField(names[1], DoubleType())]
    return docs.mapInArrow(predict, StructType([*docs.schema.fields, *added]))


def keep_languages(
    docs: DataFrame,
    net: Network,
    text_col: str = "text",
    wanted: list[str] | None = None,
    least: float = 0.4,
) -> DataFrame:
    """The rows in a wanted language (default: any learned one) with a score of ``least`` or more.

    Where :func:`fit` found no language to learn, no row can be told from another:
    all that have a letter stay, and asking for languages is an error.
    """
    learned = [lang for lang in net.languages if lang != UNKNOWN]
    if wanted is not None and not learned:
        raise ValueError("no language was learned, so none can be selected")
    named = with_language(docs, net, text_col)
    lang, score = map(F.col, free_names(docs, "_lang", "_score"))
    if not learned:
        return named.where(score > 0).select(*docs.columns)
    chosen = wanted if wanted is not None else learned
    return named.where(lang.isin(*chosen) & (lang != UNKNOWN) & (score >= least)).select(*docs.columns)
