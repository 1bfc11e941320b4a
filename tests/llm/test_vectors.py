"""Vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.llm import ann, queries, topk

FOLDER = "/root/testdata/sf0.1"


def table(spark, rows):
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return docs.withColumns({c: F.lit(0) for c in ("id", "uid", "vector", "group", "left", "score")})


def plain_top(rows, is_query, score, k):
    found = []
    for q, a in rows:
        if is_query(q):
            scored = sorted((-score(a, b), c) for c, b in rows if c != q)
            found += [(q, n, c, -s) for n, (s, c) in enumerate(scored[:k], 1)]
    return found


def product(a, b):
    return sum(int(np.floor(1024.0 * x)) * int(np.floor(1024.0 * y)) for x, y in zip(a, b, strict=False))


ODD = [(0, [1.0, 0.0, -0.5]), (100, [0.25, 0.25, 0.25]), (1, None), (2, [None, 1.0, 1.0]), (3, [float("nan"), 0.0, 0.0]),
       (4, [float("inf"), 0.0, 0.0]), (5, [0.0, 0.0, 0.0]), (6, []), (7, [1.0, 0.0]), (None, [1.0, 1.0, 1.0]),
       (8, [1.0, 0.0, -0.5]), (9, [1.0, 0.0, -0.5]), (200, None)]


def test_top_k_of_odd_rows(spark):
    rows = [r for r in ODD if r[0] in (0, 100, 5, 6, 7, 8, 9)]
    wanted = plain_top(rows, lambda i: i % 100 == 0, product, 10)
    found = topk.top_k(table(spark, ODD).repartition(3), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert topk.top_k(table(spark, ODD).limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_repeated_query_rows_answer_once(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [3.0, 0.0])]
    found = topk.top_k(table(spark, rows), F.col("vec_id") == 0, k=3).collect()
    assert sorted((r["rank"], r.vec_id) for r in found) == [(1, 1), (2, 1), (3, 2)]


@pytest.mark.parametrize("group", [7, 4096])
def test_top_k_equals_brute_force(spark, monkeypatch, group):
    from gridtally.llm import vectors

    rng = np.random.default_rng(group)
    rows = [(i, rng.choice([0.0, 0.0, 0.5, -0.25, 0.125], 6).tolist()) for i in range(120)]
    found = vectors.search(
        table(spark, rows), F.col("vec_id") % 10 == 0, topk._finder(4, 1024.0), 4, "long", "vec_id", "embedding",
        candidates=group, queries=group,
    ).collect()
    assert sorted(map(tuple, found)) == sorted(plain_top(rows, lambda i: i % 10 == 0, product, 4))


def test_nearest_of_odd_rows(spark):
    def cosine(a, b):
        a, b = (np.array([*v, *[0.0] * (3 - len(v))]) for v in (a, b))
        return float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)))

    rows = [r for r in ODD if r[0] in (0, 100, 7, 8, 9)]
    found = ann.nearest(table(spark, ODD), F.col("vec_id") % 50 == 0).collect()
    wanted = plain_top(rows, lambda i: i % 50 == 0, cosine, 5)
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(found)] == [w[:3] for w in sorted(wanted)]
    assert np.allclose([r.score for r in sorted(found)], [w[3] for w in sorted(wanted)])
    assert ann.nearest(table(spark, ODD).limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_recall_of_the_registered_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    matrix = np.array([r.embedding for r in rows])
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    found = {}
    for r in queries.op9_nearest_neighbours(spark, FOLDER).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for query, got in found.items():
        scores = matrix @ matrix[ids == query][0]
        scores[ids == query] = -2
        best = set(ids[np.lexsort((ids, -scores))[:5]])
        hits += len(best & {v for _, v, _ in got})
        assert [r for r, _, _ in sorted(got)] == [1, 2, 3, 4, 5]
        assert all(abs(scores[ids == v][0] - s) < 1e-9 for _, v, s in got)
    assert len(found) == (ids % 50 == 0).sum()
    assert hits >= 0.9 * 5 * len(found)


def test_blocks_are_bounded_and_sent_once(spark, monkeypatch):
    from gridtally.llm import vectors

    rng = np.random.default_rng(3)
    rows = [(i, rng.choice([0.0, 0.5, -0.25], 8).tolist()) for i in range(90)] + [(200, [1.0] * 8)] * 5000
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 8 * 8 * 20)
    frame = table(spark, rows)
    usable = vectors.usable_rows(frame, F.col("vec_id") % 10 == 0, "vec_id", "embedding")
    # 20 vectors of 8 components make a block, and of 5000 copies those that an answer can hold are kept
    assert vectors.block_counts(usable, 4096, 1024) == (-(-5090 // 20), -(-5009 // 20))
    assert vectors.few_copies(usable, 4).count() == 94
    found = topk.top_k(frame, F.col("vec_id") % 10 == 0, k=4).collect()
    plain = [r for r in rows if r[0] != 200] + [(200, [1.0] * 8)] * 4
    wanted = plain_top([r for r in plain if r[0] % 10 == 0 and r[0] != 200] + plain[-1:], lambda i: False, product, 4)
    for q, a in dict((i, v) for i, v in plain if i % 10 == 0).items():
        scored = sorted((-product(a, b), c) for c, b in plain if c != q)
        wanted += [(q, n, c, -s) for n, (s, c) in enumerate(scored[:4], 1)]
    assert sorted(map(tuple, found)) == sorted(wanted)


def test_rounds_end_with_all_verified(spark):
    # opposite and orthogonal vectors: no window holds them, the last round finds them
    rows = [(0, [1.0, 0.0, 0.0]), (1, [-1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.9, 0.1, 0.0])]
    found = ann.nearest(table(spark, rows), F.col("vec_id") == 0, k=5).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 3), (2, 2), (3, 1)]
    assert [round(r.score, 3) for r in sorted(found, key=lambda r: r["rank"])] == [0.994, 0.0, -1.0]


def test_windows_verify_few_vectors():
    """Where vectors have neighbours, few of all pairs are verified, and hardly a neighbour is missed."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(300, 64))
    matrix = np.repeat(centres, 10, axis=0) + 0.3 * rng.normal(size=(3000, 64))
    ids = np.arange(len(matrix))
    stored = ann.sorted_arrays(matrix)
    order = np.frombuffer(stored, "<i4", ann.PROJECTIONS * len(ids)).reshape(ann.PROJECTIONS, -1)
    assert all(sorted(own) == list(range(len(ids))) for own in order.tolist())
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    left, verified, hits = list(range(0, 3000, 30)), 0, 0
    asked = len(left)
    for radius in ann.RADII:
        find = ann._finder(3000, radius)(ids, matrix, stored)
        still = []
        for at, found, scores in find(ids[left], matrix[left]):
            verified += len(found)
            if len(found) >= 5 and np.sqrt(2 - 2 * scores[4]) <= radius:
                plain = unit @ unit[left[at]]
                plain[left[at]] = -2
                hits += len(set(found[:5]) & set(np.argsort(-plain)[:5]))
            else:
                still.append(left[at])
        left = still
    assert not left and verified < 0.05 * asked * len(ids) and hits > 0.95 * 5 * asked


@pytest.mark.parametrize("value", [1e13, 1e300])
def test_top_k_is_exact_or_fails(spark, value):
    def best(rows):
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return [(r.vec_id, r.score) for r in topk.top_k(vectors, F.col("vec_id") == 0).collect()]

    # beyond the old limit of a weight, but a long
    assert best([(0, [1.0, 0.0]), (1, [5e12, 1.0])]) == [(1, 1024 * 5 * 10**12 * 1024)]
    # the product with itself is no score
    assert best([(0, [5e12]), (1, [1e-3])]) == [(1, 1024 * 5 * 10**12)]
    with pytest.raises(Exception, match="range of a long"):
        best([(0, [value, 1.0]), (1, [value, 1.0])])
