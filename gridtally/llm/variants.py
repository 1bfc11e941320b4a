"""Spelling variants: near words by a dictionary of pairs of trie nodes.

The words are sorted and numbered as nodes of a trie, forwards and backwards, so
that every beginning and every end of a word is an integer.  A word of L letters
is in the dictionary with its L + 1 pairs (beginning, rest) and with its L pairs
that skip one letter.  Words that differ by a replaced letter share a skipping
pair, words that differ by an inserted one a skipping pair of the longer and a
full pair of the shorter: equal pairs are exactly the near words.  A pair belongs
to one word and its skipping ones, at most one per letter of the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage
from .common import batch

#: Maximal runs of these are words.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS, MIN_COUNT = 6, 5
#: A near word that occurs so many times as often is the form of a word.
TIMES = 5
#: One of so many runs of a text loses a letter.
SLIP = 199
#: Numbers of the nodes of one range of words.
_RANGE = 1 << 40
#: A pair that skips a letter, one that skips the last of equal letters, and a full one.
_SKIP, _SKIP_LAST, _FULL = 0, 1, 2


def lowered(run: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.length(run) == F.octet_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def count_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    slip: int | None = SLIP,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """``word, n``: the words of all texts with their number of occurrences.

    A run of letters loses the letter ``h % length`` if ``slip`` divides the crc32 h
    of ``id:run`` (a NULL id is empty; None: no run does).  NULL and empty texts
    have no words; repeated rows are counted each.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))).alias("run"),
    ).where(F.length("run") >= min_letters)
    runs = runs.select("id", lowered(F.col("run")).alias("word"))
    if slip is not None:
        h = F.crc32(F.concat("id", F.lit(":"), "word"))
        runs = runs.select("word", h.alias("h"))
        at = (F.col("h") % F.length("word")).cast("int")
        short = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.select(F.when(F.col("h") % slip == 0, short).otherwise(F.col("word")).alias("word"))
        runs = runs.where(F.length("word") >= min_letters)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


_NUMBERED = pa.schema(
    [("word", pa.string()), ("range", pa.int32()), ("edge", pa.bool_()), ("nodes", pa.list_(pa.int64()))]
)


def trie_nodes(words: DataFrame, column: str = "word") -> DataFrame:
    """``word, nodes``: the number of the trie node of every beginning, from the empty one to the whole word.

    The distinct words are sorted by ranges, and each range is read once in order:
    a word keeps the nodes of its common beginning with the word before and gets
    new ones for the rest.  A beginning that the first word of a range shares with
    the last one before is numbered as there; of that, two words a range pass the
    driver.  The whole word has the greatest number yet, so these follow the order
    of the words.
    """
    span = _RANGE

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        fresh, before, nodes, held = place * span, None, [], None
        for rows in batches:
            ready = []
            for word in rows.column(0).to_pylist():
                known = 0 if before is None else _common(before, word) + 1
                new = len(word) + 1 - known
                nodes = nodes[:known] + list(range(fresh, fresh + new))
                if held is not None:
                    ready.append(held)
                held = (word, place, before is None, nodes)
                fresh, before = fresh + new, word
            if ready:
                yield batch(_NUMBERED, list(zip(*ready)))
        if held is not None:
            yield batch(_NUMBERED, [[held[0]], [place], [True], [nodes]])

    ranged = words.select(F.col(column).alias("word")).repartitionByRange("word").sortWithinPartitions("word")
    numbered = stage(
        ranged.mapInArrow(number, "word string, range int, edge boolean, nodes array<long>"), "trie-nodes"
    )
    known, last = [], None
    for row in numbered.where("edge").orderBy("word").collect():
        if last is not None and row["range"] != last[0]:
            known.append((row["range"], last[2][: _common(last[1], row.word) + 1]))
            # the first word of a range numbers its beginnings one after the other
            nodes = known[-1][1] + row.nodes[len(known[-1][1]) :]
        elif last is not None:
            nodes = [_renamed(node, known, row["range"]) for node in row.nodes]
        else:
            nodes = row.nodes
        last = (row["range"], row.word, nodes)
    shared = words.sparkSession.createDataFrame(known, "shared_range int, shared array<long>")
    depth = F.col("range").cast("long") * -span
    renamed = F.transform(
        "nodes",
        lambda node: F.coalesce(
            F.get(F.col("shared"), F.least(node + depth, F.lit((1 << 31) - 1)).cast("int")), node
        ),
    )
    # one row per range at most
    return numbered.join(F.broadcast(shared), F.col("range") == F.col("shared_range"), "left").select(
        "word", F.when(F.col("shared").isNull(), F.col("nodes")).otherwise(renamed).alias("nodes")
    )


def _renamed(node: int, known: list[tuple[int, list[int]]], place: int) -> int:
    if known and known[-1][0] == place and node - place * _RANGE < len(known[-1][1]):
        return known[-1][1][node - place * _RANGE]
    return node


def _pairs(words: DataFrame) -> DataFrame:
    """``head, tail, kind, id, n``: the dictionary of pairs of nodes."""
    size = F.length("word")
    letters = F.split("word", "")

    def skip(i: Column) -> Column:
        last = (i == size - 1) | (F.get(letters, i) != F.get(letters, i + 1))
        kind = F.when(last, F.lit(_SKIP_LAST)).otherwise(F.lit(_SKIP))
        return F.struct(
            F.get("heads", i).alias("head"), F.get("tails", size - 1 - i).alias("tail"), kind.alias("kind")
        )

    def full(i: Column) -> Column:
        return F.struct(
            F.get("heads", i).alias("head"), F.get("tails", size - i).alias("tail"), F.lit(_FULL).alias("kind")
        )

    return words.select(
        "id",
        "n",
        F.inline(
            F.concat(
                F.transform(F.sequence(F.lit(0), size - 1), skip),
                F.transform(F.sequence(F.lit(0), size), full),
            )
        ),
    )


def near_words(words: DataFrame) -> DataFrame:
    """``id, word, n, n_near, near_n, near_id``: number of near words, and the most frequent one.

    ``words`` are distinct, not empty, each with its count ``n``.  Words are near if
    they differ by exactly one inserted, deleted or replaced code point.  Of near
    words of equal ``n`` the smallest counts; without any, ``n_near`` is 0 and the
    others are NULL.  ``id`` is the trie node of the word; ids follow the order of
    the words.
    """
    words = stage(words, "words")
    heads = trie_nodes(words).withColumnRenamed("nodes", "heads")
    tails = trie_nodes(words.select(F.reverse("word").alias("word"))).select(
        F.reverse("word").alias("word"), F.col("nodes").alias("tails")
    )
    numbered = stage(
        words.join(heads, "word").join(tails, "word").withColumn("id", F.element_at("heads", -1)), "numbered-words"
    )
    # at most one full entry and one skipping entry per letter of the alphabet
    shared = (
        _pairs(numbered)
        .groupBy("head", "tail")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "id", "kind"))).alias("all"))
        .where(F.size("all") > 1)
        .select("all", F.explode("all").alias("one"))
    )

    def near(other: Column) -> Column:
        one = F.col("one")
        replaced = (one["kind"] < _FULL) & (other["kind"] < _FULL)
        inserted = one["kind"] + other["kind"] == _FULL + _SKIP_LAST
        return (one["id"] != other["id"]) & (replaced | inserted)

    others = shared.select(F.col("one")["id"].alias("id"), F.filter("all", near).alias("others"))
    best = (
        others.where(F.size("others") > 0)
        .select(
            "id", F.size("others").cast("long").alias("here"), F.element_at("others", 1).dropFields("kind").alias("best")
        )
        .groupBy("id")
        .agg(F.sum("here").alias("n_near"), F.min("best").alias("best"))
    )
    return numbered.select("id", "word", "n").join(best, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        (-F.col("best")["less"]).alias("near_n"), F.col("best")["id"].alias("near_id"),
    )


def spelling_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, one row per word.

    ``words`` has distinct words and their counts ``n``; the empty word and NULL are
    left out.  ``form`` is the most frequent near word (ties: the smallest) if it
    occurs ``times`` times as often, ``root`` the end of the chain of forms, the word
    itself without one.  Every form is more frequent than its word, so the chain
    ends; it is followed by doubling steps, a few rounds for any data.
    """
    known = stage(near_words(words.where("word <> ''")), "near-words")
    is_form = F.col("near_n") >= F.col("n") * times
    steps = stage(known.where(is_form).select("id", F.col("near_id").alias("to")), "forms")
    while True:
        beyond = steps.select(F.col("id").alias("to"), F.col("to").alias("beyond"))
        moved = stage(steps.join(beyond, "to", "left"), "forms")
        steps = moved.select("id", F.coalesce("beyond", "to").alias("to"))
        if moved.where("beyond IS NOT NULL").isEmpty():
            break
    named = known.select(
        "id", "word", "n", "n_near", F.when(is_form, F.col("near_id")).alias("form_id"),
        F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    forms = known.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    roots = steps.join(known.select(F.col("id").alias("to"), F.col("word").alias("end")), "to").select("id", "end")
    return (
        named.join(forms, "form_id", "left")
        .join(roots, "id", "left")
        .select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
    )
