"""k nearest points, fingerprints of a panel, parent values that are kept up to date."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridtally.operators.aggregate import aggregate_parents
from gridtally.operators.maintained import change_sums, parent_sums, parents_of_sums, read_sums, write_sums
from gridtally.operators.nearest import nearest_k, nearest_points
from gridtally.operators.quality import panel_fingerprints


def plain_nearest(queries, points, k):
    out = []
    for q, group, x, y in queries:
        known = x is not None and y is not None and not math.isnan(x)
        here = [p for p in points if p[1] == group and p[2] is not None and not math.isnan(p[2])] if known else []
        found = sorted((math.sqrt((p[2] - x) * (p[2] - x) + (p[3] - y) * (p[3] - y)), p[0]) for p in here)[:k]
        out += [(q, i + 1, p, d) for i, (d, p) in enumerate(found)] or [(q, None, None, None)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [1, 5, 40])
def test_k_nearest_equals_brute_force(spark, k):
    rng = random.Random(k)
    # a grid with ties, a dense spot, copies of a place, a group of two points
    points = [(i, "a", float(i % 40), float(i // 40)) for i in range(800)]
    points += [(1000 + i, "a", 3 + rng.random() / 1000, 3 + rng.random() / 1000) for i in range(300)]
    points += [(2000 + i, "a", 10.5, 10.5) for i in range(200)]
    points += [(3000, "b", 1.0, 1.0), (3001, "b", 2.0, 2.0), (3002, "b", None, 1.0), (3003, "b", float("nan"), 0.0)]
    rng.shuffle(points)
    queries = [(f"q{i}", "a", rng.choice([rng.uniform(-5, 50), float(rng.randrange(40))]), rng.uniform(-5, 30)) for i in range(60)]
    queries += [("spot", "a", 3.0, 3.0), ("copies", "a", 10.5, 10.5), ("few", "b", 0.0, 0.0), ("none", "c", 0.0, 0.0)]
    queries += [("lost", "a", None, 0.0), ("nan", "a", float("nan"), 0.0), ("twice", "a", 1.5, 1.5), ("twice", "a", 1.5, 1.5)]
    p = spark.createDataFrame(points, "gridcell_idx LONG, region STRING, lon DOUBLE, lat DOUBLE")
    q = spark.createDataFrame(queries, "geoid STRING, region STRING, cx DOUBLE, cy DOUBLE")
    found = nearest_k(q, p, k, by=["region"]).select("geoid", "rank", "gridcell_idx", "distance").collect()
    assert sorted(map(tuple, found), key=repr) == plain_nearest(queries, points, k)
    if k == 1:
        one = nearest_points(q, p, by=["region"]).select("geoid", "gridcell_idx", "distance").collect()
        assert sorted(map(tuple, one), key=repr) == sorted(((r[0], *r[2:]) for r in map(tuple, found)), key=repr)
    empty = nearest_k(q, p.limit(0), k, by=["region"])
    assert empty.where("rank IS NULL AND gridcell_idx IS NULL").count() == len(queries) == empty.count()


def test_fingerprints_find_what_counts_do_not(spark):
    rows = []
    for year in range(2000, 2006):
        cells = [(i, float(i % 5), float(i // 5)) for i in range(20)]
        if year == 2001:
            cells[3], cells[7] = (3, *cells[7][1:]), (7, *cells[3][1:])  # another order
        if year == 2002:
            cells[4] = (4, 9.0, 9.0)  # another cell
        if year == 2003:
            cells[4] = (4, *cells[5][1:])  # one cell twice, one missing
        if year == 2004:
            cells = cells[:-1]
        if year == 2005:
            cells[0] = (0, None, 0.0)
        rows += [("NE1", "urban", "ec", year, *c) for c in cells]
    rows += [("NE1", "urban", "ec", None, *c) for c in [(i, float(i % 5), float(i // 5)) for i in range(20)]]
    rows += [("P9", "urban", "ec", y, 1, 0.0, 0.0) for y in (2000, 2001)]
    panel = spark.createDataFrame(
        rows, "region STRING, urban_rural STRING, species STRING, year INT, at LONG, lon DOUBLE, lat DOUBLE")
    for shuffled in (panel, panel.orderBy(F.desc("at")), panel.repartition(7)):
        found = {(r.region, r.year): (r.same_count, r.same_cells, r.same_order)
                 for r in panel_fingerprints(shuffled, position="at").collect()}
        assert found == {
            ("NE1", 2000): (True, True, True), ("NE1", 2001): (True, True, False), ("NE1", 2002): (True, False, False),
            ("NE1", 2003): (True, False, False), ("NE1", 2004): (False, False, False),
            ("NE1", 2005): (True, False, False), ("NE1", None): (True, True, True),
            ("P9", 2000): (True, True, True), ("P9", 2001): (True, True, True)}
    plain = panel_fingerprints(panel.withColumn("id", F.col("at")), cell=["id"]).collect()
    assert all(r.same_order is None for r in plain)
    # rows that are no cell have the same number everywhere but in 2004
    assert {r.year for r in plain if not r.same_cells} == {2004}
    # only sums are shuffled
    plan = panel_fingerprints(panel, position="at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") and "SortMergeJoin" not in plan and "Generate" not in plan
    assert panel_fingerprints(panel.limit(0)).collect() == []


BY = ["species"]
SCHEMA = "species STRING, year INT, geoid STRING, predicted_within DOUBLE, predicted_nearest DOUBLE, population LONG"


def block_rows(rng, n):
    code = lambda i: f"{i % 3:02d}{i % 4:03d}{i % 7:06d}{i % 2}{i:03d}"
    value = lambda: rng.choice([None, 0.1, 0.7, rng.uniform(0, 1e6), 1 / 3])
    return {
        (s, y, code(i)): (value(), rng.choice([0.3, rng.random(), None]), rng.choice([None, 0, 7, 10**9]) if i % 9 == 0 else i)
        for i in range(n) for s in ("ec", "no3") for y in (2000, 2001)
    }


def frame(spark, rows):
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], SCHEMA)


def fresh(spark, rows):
    values = frame(spark, rows)
    return aggregate_parents(values.drop("population"), values.select(*BY, "year", "geoid", "population"),
                             by=BY, block=[*BY, "year", "geoid"])


def told(df):
    return {(r.species, r.level, r.year, r.geoid): (None if r.predicted is None else float(f"{r.predicted:.9g}"),
                                                    r.pct_pop_predicted) for r in df.collect()}


def test_maintained_sums_equal_a_fresh_roll_up(spark, tmp_path):
    rng = random.Random(11)
    rows, path = block_rows(rng, 200), str(tmp_path / "sums")
    write_sums(parent_sums(frame(spark, rows), by=BY), path)
    for round_ in range(3):
        changed = rng.sample(sorted(rows), 150)
        before = {k: rows[k] for k in changed}
        for i, k in enumerate(changed):
            if i % 4 == 0:
                del rows[k]
            elif i % 4 == 1:
                rows[k] = (None, None, rows[k][2])  # a value that turned NULL
            elif i % 4 == 2:
                rows[k] = (rng.random(), 1.0, None if i % 8 == 2 else 5)
            else:
                rows[k] = (1 / 7, None, 3)
        added = {k: v for k, v in block_rows(rng, 230 + 20 * round_).items() if k not in rows and k not in before}
        rows.update(added)
        after = {k: rows[k] for k in [*changed, *added] if k in rows}
        sums = change_sums(read_sums(spark, path), frame(spark, before), frame(spark, after), by=BY)
        found = parents_of_sums(write_sums(sums, path), BY)
        assert told(found) == told(fresh(spark, rows))
    assert len(list((tmp_path / "sums").glob("version=*"))) == 4
    # taking everything away leaves nothing, not even rounding
    none = change_sums(read_sums(spark, path), frame(spark, rows), frame(spark, {}), by=BY)
    assert none.collect() == []


def test_rows_that_were_not_counted_are_refused(spark, tmp_path):
    rows = {("ec", 2000, "010010000011000"): (1.0, 1.0, 5)}
    sums = parent_sums(frame(spark, rows), by=BY)
    other = {("ec", 2000, "020010000011000"): (1.0, 1.0, 5)}
    with pytest.raises(Exception, match="never counted"):
        change_sums(sums, frame(spark, other), frame(spark, {}), by=BY).collect()
    with pytest.raises(FileNotFoundError):
        read_sums(spark, str(tmp_path / "nothing"))
