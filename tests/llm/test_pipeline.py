"""The pipeline against what each stage promises, by brute force."""

import pytest
from test_models import brute_force, shingles
from test_text import checked_packing
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from gridtally.llm import langid, quality, queries, secrets

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "language_id", "near_dedup", "secret_scan", "packing",
    ]
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and entry.queries()["pipeline"] is corpus_pipeline.run
    assert not any("localCheckpoint" in open(m.__file__).read() for m in (langid, quality, corpus_pipeline))


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels")]


def test_run_equals_plain_stages(spark, tables):
    docs, labels = tables
    usable = quality.select_quality(docs, queries.quality_model(docs, labels))
    named = langid.keep_languages(usable, langid.fit(usable))
    rows = sorted((r.doc_id, r.text) for r in named.collect())
    groups = brute_force(rows, corpus_pipeline.NEAR_PERCENT)
    automaton = secrets.keyword_automaton()
    tokenizer = Tokenizer.from_file(queries.PACKING_TOKENIZER)
    wanted = {}
    for key, text in rows:
        if groups[key][1] == key:
            for start, end, _ in sorted(secrets.scan(text, automaton), reverse=True):
                text = text[:start] + "[SECRET]" + text[end:]
            wanted[key] = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    assert checked_packing(corpus_pipeline.run(spark, FOLDER).collect(), wanted, 1024) == 0


def test_clean_documents_stay(spark, tables):
    docs, labels = tables
    good = {r.doc_id for r in labels.where("quality = 1 AND toxic = 0").collect()}
    usable = corpus_pipeline.select_quality(spark, docs, FOLDER)
    kept = {r.doc_id for r in corpus_pipeline.select_language(spark, usable, FOLDER).collect()}
    poor = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(good - kept) <= 0.01 * len(good) and len(poor & kept) <= 0.05 * len(poor)


def test_stages_keep_columns_and_take_odd_rows(spark, tables):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _lang string, kept string"
    odd = [
        (1, None, None, None, None, "a", "b"),
        (2, "", "en", "s", 0, "a", "b"),
        (None, "The house and the garden of the old man.", "en", "s", 1, "a", "b"),
        (5, "The house and the garden of the old man.", "en", "s", 1, "a", "b"),
        (5, "The house and the garden of the old man.", "en", "s", 1, "a", "b"),
        (6, "the HOUSE and the garden of the old man.", "en", "s", 1, "a", "b"),
    ]
    frame = spark.createDataFrame(odd, schema)
    for docs in (frame, frame.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, FOLDER)
            assert found.columns == docs.columns and found.count() <= docs.count()
    left = corpus_pipeline.drop_near_copies(spark, frame, FOLDER).collect()
    assert sorted(str(r.doc_id) for r in left) == ["1", "2", "5", "None"]
    masked = corpus_pipeline.scan_secrets(
        spark, spark.createDataFrame([(1, "x password=4c8f8006a3af39d897 y", "en", "s", 1, "a", "b")], schema), FOLDER
    )
    assert masked.first().text == "x [SECRET] y"


def test_near_copies_from_four_fifths_on_go(spark):
    words = [f"w{i}" for i in range(104)]
    near = [*words[:-11], *[f"x{i}" for i in range(11)]]  # 89 of 111 shingles are common
    far = [*words[:-12], *[f"y{i}" for i in range(12)]]  # 88 of 112
    rows = [(2, words), (4, near), (3, far)]
    sets = {i: shingles(" ".join(w)) for i, w in rows}
    share = {i: len(sets[2] & sets[i]) / len(sets[2] | sets[i]) for i in (3, 4)}
    assert share[3] < 0.8 < share[4] < 0.85
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    left = corpus_pipeline.drop_near_copies(spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in left) == [2, 3]


def test_near_dedup_equals_brute_force_at_four_fifths(spark, tables):
    rows = sorted((r.doc_id, r.text) for r in tables[0].collect())
    left = corpus_pipeline.drop_near_copies(spark, tables[0], FOLDER).collect()
    wanted = {i for i, (_, top) in brute_force(rows, 80).items() if i == top}
    assert {r.doc_id for r in left} == wanted != {i for i, (_, top) in brute_force(rows).items() if i == top}
