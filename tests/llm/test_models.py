"""Near-duplicates, regressions, language: against brute force and held-out rows."""

import collections
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gridtally.llm import components, graded, langid, neardup, ordinal, quality, queries, toxicity

FOLDER = "/root/testdata/sf0.01"


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows, percent=85):
    """component of every id: links between all pairs of texts."""
    above = {i: i for i, _ in rows}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                above[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets}


def near_copies(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(6):
        base = [word() for _ in range(rng.choice([3, 20, 60, 150]))]
        for _ in range(n):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("block", [4, 512])
def test_components_equal_brute_force(spark, block):
    rows = near_copies(25, block)
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "One two"), (1004, "oNE TWO"), (1005, "É x"), (1006, "é x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("rep", "label", "region", "kept", "key")}).repartition(3)
    wanted = brute_force(rows)
    found = neardup.near_duplicates(docs, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@pytest.mark.parametrize(("percent", "block"), [(80, 512), (85, 3), (100, 3)])
def test_links_between_ranges_of_sizes(spark, monkeypatch, percent, block):
    rng = random.Random(4)
    words = [f"w{rng.random()}" for _ in range(700)]
    # texts that grow by 3 to 25 %: one region of many sizes, whose links cross the ranges
    rows, n = [], 40
    while n < len(words):
        rows.append((len(rows) + 3, " ".join(words[:n])))
        n = int(n * rng.choice([1.03, 1.08, 1.15, 1.25]))
    rows += [(100 + k, text + " end") for k, text in rows]
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string")
    wanted = brute_force(rows, percent)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 4096)  # with 512 rows a block ends by its bytes
    found = neardup.near_duplicates(docs, percent=percent, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted


def test_ranges_of_sizes_that_may_link(spark):
    for percent in (50, 80, 85, 90, 99):
        sizes = [(n, -(-n * percent // 100)) for n in [*range(1, 400), 9_999, 123_456, 10**7]]
        far = spark.createDataFrame(sizes, "large long, small long").select(
            F.col("large").alias("n_shingles"), "small"
        ).withColumn("a", neardup._grade(percent)).withColumn("n_shingles", F.col("small"))
        assert far.withColumn("b", neardup._grade(percent)).where("a - b > 1 OR a < b").count() == 0


def test_odd_rows_of_near_duplicates(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, long), (5, long), (3, long + " end"), (None, long), (None, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(neardup.near_duplicates(docs).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in found if r.doc_id == 5] == [(5, 3, False)] * 2
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    assert [(r.component_id, r.n_shingles) for r in found if r.doc_id == 9] == [(9, 0)]
    assert neardup.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize("turned", [False, True])
def test_an_id_with_two_texts(spark, parts, turned):
    rng = random.Random(9)
    a, b, c = (" ".join(str(rng.random()) for _ in range(120)) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, c), (4, c + " z"), (4, c), (5, c + " w")]
    docs = spark.createDataFrame(rows[::-1] if turned else rows, "doc_id long, text string").repartition(parts)
    found = sorted((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect())
    # a row has the component of its own text; the two texts of 1 are not connected by it
    assert found == [(1, 1, True)] * 2 + [(2, 1, False), (3, 1, False)] + [(4, 4, True)] * 3 + [(5, 4, False)]
    left = sorted((r.doc_id, r.text) for r in neardup.drop_near_duplicates(docs).collect())
    assert len(left) == 3 and left[:2] == sorted([(1, a), (1, b)])
    assert left[2][0] == 4 and left[2][1] in (c, c + " z")
    again = sorted((r.doc_id, r.text) for r in neardup.drop_near_duplicates(docs.repartition(2)).collect())
    assert again == left


def test_rows_that_stay(spark):
    text = "The house and the garden of the old man."
    rows = [(7, text, "b"), (7, text, "a"), (7, text.upper(), "c"), (8, text, "a"), (9, None, "x"), (9, "", "y"),
            (None, text, "n"), (None, text, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, set_key string").repartition(3)
    left = neardup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    # 7 has three rows of one set: the smallest by text, then by the other columns, stays
    assert sorted(map(str, left.collect())) == sorted(
        map(str, spark.createDataFrame([(7, text.upper(), "c"), (9, None, "x"), (None, text, "n"), (None, text, "n")],
                                       docs.schema).collect()))
    assert neardup.drop_near_duplicates(docs.limit(0)).collect() == []


def shuffled_rows(df):
    """Records written by the shuffles of the finished plan, per expressions that they are dealt by."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            records = node.metrics().apply("shuffleRecordsWritten").value()
            found.append((node.outputPartitioning().toString(), records))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_texts_that_stay_are_not_shuffled(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(20)), i, "b") for i in range(200)]
    rows += [(1000 + i, rows[i][1], i, "b") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, _bitmap string")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = neardup.drop_near_duplicates(docs)
        by_text = [n for keys, n in shuffled_rows(left) if "xxhash64(text" in keys]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    # five of 205 rows go
    assert by_text and sum(by_text) <= 10
    assert sorted(map(tuple, left.collect())) == rows[:200]


def test_close_signatures_share_a_key(spark):
    rng = np.random.default_rng(3)
    places = neardup.CHUNKS * neardup.CHUNK
    rows = []
    for i in range(40):
        a = rng.integers(0, 65536, places).astype("<u2")
        b = a.copy()
        # the largest distance for which the pigeonhole guarantees a common key
        b[rng.choice(places, 2 * neardup.CHUNKS - 1, replace=False)] ^= 1
        rows += [(i, bytearray(a.tobytes())), (i, bytearray(b.tobytes()))]
    keys = spark.createDataFrame(rows, "rep long, signature binary").select(
        "rep", F.explode(neardup.chunk_keys()).alias("key")
    )
    shared = keys.groupBy("rep", "key").count().where("count > 1").select("rep").distinct()
    assert shared.count() == 40


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(60) if i != 30] + [(100, 100), (7, 3)]
    found = dict(components.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {i: 0 if i <= 30 else 31 for i in range(61)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_ordinal_thresholds_and_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=3000)
    grades = np.digitize(2 * x + rng.logistic(size=3000), [-1.0, 0.5, 2.0])
    model = ordinal.fit(np.arange(3000), np.zeros(3000, int), x, grades, 1, 4, steps=500, balanced=False)
    assert np.allclose(model.thresholds, [-1.0, 0.5, 2.0], atol=0.3)
    assert abs(model.weights[0] - 2.0) < 0.3
    tails = model.tails(np.linspace(-5, 5, 50))
    assert (np.diff(tails, axis=1) <= 0).all() and (np.diff(model.expected(np.linspace(-5, 5, 50))) > 0).all()
    empty = ordinal.fit(np.empty(0, int), np.empty(0, int), np.empty(0), np.empty(0, int), 5, 3)
    assert empty.tails(np.zeros(1)).shape == (1, 2)


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    return read("documents"), read("labels")


def halves(labels):
    odd = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    return labels.where(~odd), labels.where(odd)


def test_toxicity_of_held_out_documents(tables):
    docs, labels = tables
    seen, unseen = halves(labels)
    rated = toxicity.rate(docs, toxicity.fit(docs, seen)).withColumnRenamed("toxic", "found")
    rows = rated.join(unseen, "doc_id").collect()
    right = collections.Counter((r.toxic, r.found) for r in rows)
    # most words of a third of the toxic documents are in languages with few examples
    assert right[1, True] >= 0.5 * sum(n for (t, _), n in right.items() if t == 1)
    assert right[0, True] <= 0.02 * len(rows)
    assert all(0 <= r.expected_severity <= 3 and r.p_severe <= r.p_toxic for r in rows)


def test_quality_of_held_out_documents(tables):
    docs, labels = tables
    seen, unseen = halves(labels)
    model = quality.fit(docs, seen.withColumn("grade", quality.rating()))
    kept = {r.doc_id for r in quality.select_quality(docs, model).collect()}
    rows = unseen.collect()
    assert np.mean([(r.doc_id in kept) == (r.quality == 1) for r in rows]) > 0.97


def sigmoid(x):
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def hashed(name, n):
    return xxhash.xxh3_64_intdigest(name) % n


def plain_toxic_score(text, model):
    """Words of letters and their first four and five bytes, each log(1 + count) times its weight."""
    counts = collections.Counter()
    for word in re.findall(rb"[a-z\x80-\xff]+", text.lower().encode()):
        counts[hashed(word, toxicity.FEATURES)] += 1
        for n in (4, 5):
            if len(word) > n:
                counts[hashed(word[:n] + b"*", toxicity.FEATURES)] += 1
    return sum(math.log(1 + n) * model.weights[c] for c, n in counts.items())


def plain_shape(token):
    if token.isalpha():
        if token.islower():
            return "x"
        if token.isupper():
            return "X" if len(token) == 1 else "XX"
        return "Xx" if token[1:].islower() else "xX"
    if token.isdigit():
        return "9"
    return "x9" if token[0].isalnum() or token[0] == "_" else token[:3]


def plain_quality_score(text, model):
    """Square roots of shares of words, shapes, pairs of shapes and repeats, each times its weight."""
    tokens = re.findall(r"\w+|[^\w\s]+", text)
    shares = collections.Counter()
    for i, token in enumerate(tokens):
        shares[hashed("w " + token.lower(), quality.FEATURES)] += 1
        shares[hashed("s " + plain_shape(token), quality.FEATURES)] += 4
        if i:
            pair = f"p {plain_shape(tokens[i - 1])} {plain_shape(token)}"
            shares[hashed(pair, quality.FEATURES)] += 4
            shares[hashed("r", quality.FEATURES)] += 8 * (tokens[i - 1] == token)
    return sum(math.sqrt(n / len(tokens)) * model.weights[c] for c, n in shares.items())


def test_toxicity_equals_plain_scores(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = queries.op3_toxicity(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        score = plain_toxic_score(texts[r.doc_id], model)
        tails = [sigmoid(score - t) for t in model.thresholds]
        assert abs(r.expected_severity - sum(tails)) < 1e-3
        assert abs(r.p_toxic - tails[0]) < 1e-3 and abs(r.p_severe - tails[-1]) < 1e-3
        assert r.toxic == (r.p_toxic >= 0.5)
    long = "idiot " * 100_000
    docs = spark.createDataFrame([(1, long)], "doc_id long, text string")
    found = toxicity.rate(docs, model).first()
    assert abs(found.p_toxic - sigmoid(plain_toxic_score(long, model) - model.thresholds[0])) < 1e-3


def test_quality_equals_plain_scores(spark, tables):
    docs, labels = tables
    model = queries.quality_model(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = queries.op7_quality(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        score = plain_quality_score(texts[r.doc_id], model)
        usable, good = (sigmoid(score - t) for t in model.thresholds)
        assert abs(r.p_usable - usable) < 1e-3 and abs(r.p_good - good) < 1e-3
        assert abs(r.expected_grade - usable - good) < 2e-3 and r.kept == (r.p_usable >= 0.5)


def test_sample_of_an_id_with_two_texts(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "c"), (2, "c"), (None, "d")], "doc_id long, text string")
    rated = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1), (None, 1), (2, None)], "doc_id long, grade int")
    for parts in (1, 5):
        found = graded.labelled_sample(docs.repartition(parts), rated, 10, "doc_id", "text", "grade").collect()
        assert sorted(tuple(r) for r in found) == [(1, 0, "a"), (2, 1, "c")]


ODD = [(1, None, None), (2, "", "en"), (3, "123 456 !!", "de"), (4, "word " * 50_000, None), (4, "word " * 50_000, None),
       (None, "The house and the garden", "en"), (5, "Der Garten und das Haus", "de")]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    return docs.withColumns({c: F.lit("x") for c in ("_lang", "_score", "_p_usable", "grade", "features")})


def test_regressions_of_odd_rows(spark, tables, odd):
    docs, labels = tables
    for labelled in (labels, labels.limit(0)):
        model = toxicity.fit(docs, labelled)
        assert toxicity.rate(odd, model).count() == len(ODD)
        assert toxicity.rate(odd.limit(0), model).collect() == []
        model = quality.fit(docs, labelled.withColumn("grade", quality.rating()))
        rated = quality.rate(odd, model)
        assert rated.count() == len(ODD) and "__p_usable" in rated.columns
        kept = quality.select_quality(odd, model)
        assert kept.columns == odd.columns and {1, 2}.isdisjoint(r.doc_id for r in kept.collect())


@pytest.fixture(scope="module")
def network(tables):
    return langid.fit(tables[0])


def test_language_of_held_out_documents(spark, network):
    rows = queries.op8_language_id(spark, FOLDER).join(
        spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).where("held_out").collect()
    assert len(rows) > 250
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(network, odd):
    named = langid.with_language(odd, network)
    rows = {r.doc_id: r for r in named.collect()}
    assert [rows[i]["__lang"] for i in (1, 2, 3)] == ["und"] * 3
    assert rows[1]["__score"] == 0.0 and rows[4]["__lang"] in network.languages
    assert named.count() == len(ODD)
    assert langid.keep_languages(odd, network).columns == odd.columns
    assert langid.with_language(odd.limit(0), network).collect() == []
    assert langid.fit(odd.limit(0)).languages == ["und"]


def plain_scores(net, text):
    """Position by position, without batching."""
    sums = np.zeros(len(net.languages))
    for at in range(0, len(text), langid.WINDOW):
        part = np.frombuffer(text[at : at + langid.WINDOW], np.uint8)
        states = []
        for layer, data in ((net.forwards, part), (net.backwards, part[::-1])):
            h, out, n = np.zeros(langid.HIDDEN), [], langid.HIDDEN
            for byte in data:
                x, g = layer.table[byte].astype(float), layer.recurrent @ h
                z, r = (1 / (1 + np.exp(-(x[k * n : k * n + n] + g[k * n : k * n + n]))) for k in (0, 1))
                candidate = np.tanh(x[2 * n :] + r * g[2 * n :])
                h = candidate + z * (h - candidate)
                out.append(h)
            states.append(np.array(out))
        logits = np.concatenate([states[0], states[1][::-1]], axis=1) @ net.out.T + net.bias
        sums += (logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))).sum(axis=0)
    p = np.exp(sums / len(text))
    return p / p.sum()


def test_batches_equal_single_positions(network):
    texts = [b"a", b"Der Garten und das Haus", b"", b"xyz " * 200, bytes(range(256)) * 3]
    found = langid.pooled(network, texts)
    assert np.allclose(found[2], 1 / len(network.languages))
    for text, row in zip(texts, found, strict=True):
        if text:
            assert np.allclose(row, plain_scores(network, text), atol=1e-4)


def test_gradients_through_time():
    rng = np.random.default_rng(1)
    layer = langid.Direction(
        rng.normal(size=(256, 3 * langid.HIDDEN)), rng.normal(size=(3 * langid.HIDDEN, langid.HIDDEN))
    )
    data = rng.integers(0, 4, (5, 3))
    above = rng.normal(size=(5, langid.HIDDEN, 3))
    _, gates = langid.read(layer, data, keep=True)
    _, d_recurrent = langid._unread(layer, data, gates, above)
    for place in ((0, 0), (langid.HIDDEN, 2), (2 * langid.HIDDEN + 1, 3)):
        sides = []
        for step in (1e-2, -1e-2):
            moved = layer.recurrent.copy()
            moved[place] += step
            sides.append((langid.read(langid.Direction(layer.table, moved), data) * above).sum())
        assert abs((sides[0] - sides[1]) / 2e-2 - d_recurrent[place]) < 2e-2 * max(1, abs(d_recurrent[place]))


def test_no_language_to_learn_keeps_what_has_letters(spark):
    rows = [(i, f"The old house number {i} stood by the river.", None) for i in range(8)]
    rows += [(90, "12 34", None), (91, None, None), (92, "", None), (None, "A house.", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = spark.range(300).where(langid.held_out(F.col("id")))
    held = held.selectExpr("id AS doc_id", "'The old house stood by the river.' AS text", "'en' AS lang")
    kept = {r.doc_id for r in held.collect()}
    assert kept
    for frame, ids in ((docs, {*range(8), None}), (held, kept)):
        left = langid.keep_languages(frame, langid.fit(frame))
        assert left.columns == frame.columns and {r.doc_id for r in left.collect()} == ids
    with pytest.raises(ValueError):
        langid.keep_languages(docs, langid.fit(docs), wanted=["en"])
