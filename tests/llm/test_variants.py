"""Spelling variants against a plain version."""

import collections
import random
import re
import zlib

import pytest

from gridtally.llm import queries, variants

FOLDER = "/root/testdata/sf0.01"
ASCII_LOWER = str.maketrans(variants.UPPER, variants.LOWER)


def plain_counts(rows):
    """Occurrences of every word of (id, text) rows."""
    counts = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def edits(word, alphabet):
    for i in range(len(word) + 1):
        for c in alphabet:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]
        if i < len(word):
            yield word[:i] + word[i + 1 :]


def plain_variants(counts):
    """word -> (form, root, n, n_near, form_n), by trying every edit."""
    alphabet = sorted({c for w in counts for c in w})
    form, near = {}, {}
    for word, n in counts.items():
        near[word] = {e for e in edits(word, alphabet) if e != word and e in counts}
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= 5 * n else None
    found = {}
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        found[word] = (form[word], root, n, len(near[word]), counts.get(form[word]))
    return found


def rows_of(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    wanted = plain_variants(plain_counts((r.doc_id, r.text) for r in docs))
    df = queries.op12_spelling_variants(spark, FOLDER)
    assert df.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"),
                         ("n_near", "bigint"), ("form_n", "bigint")]
    assert rows_of(df) == wanted
    assert sum(v[0] is not None for v in wanted.values()) > 10


@pytest.mark.parametrize("seed", range(3))
def test_random_words_in_many_ranges(spark, seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(400):
        word = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 8)))
        counts[word] = rng.choice([5, 6, 30, 31, 200, 1000, 1000, 6000, 40000])
    counts["a" * 3000] = 7
    counts["a" * 2999 + "b"] = 70
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(variants.spelling_variants(words)) == plain_variants(counts)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_nodes_are_numbers_of_beginnings(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(80)}
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = variants.trie_nodes(frame).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    number = {}
    for row in rows:
        for i, node in enumerate(row.nodes):
            assert number.setdefault(row.word[:i], node) == node
    assert len(set(number.values())) == len(number) and {r.word for r in rows} == words
    assert [r.word for r in sorted(rows, key=lambda r: r.nodes[-1])] == sorted(words)


def test_odd_rows(spark):
    long = "Straßenlaterne " * 20_000 + "y" * 30_000
    docs = [(1, None), (2, ""), (None, "Garden GARDEN garden"), (None, "garden gärden ÄRGER"), (3, long), (3, long),
            (4, "z" * 50 + " " + " ".join(["yyyyyy"] * 5)), (5, "x × ÷abcdef " * 9)]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, word int, n int")
    counted = variants.count_words(frame)
    counts = plain_counts(docs)
    assert {r.word: r.n for r in counted.collect()} == counts and "÷abcdef" in counts
    assert rows_of(variants.spelling_variants(counted)) == plain_variants(counts)
    assert rows_of(variants.spelling_variants(variants.count_words(frame.limit(0)))) == {}
