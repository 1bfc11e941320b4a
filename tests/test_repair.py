"""Rings that cross: against areas by vertical slices."""

import math
import random

import numpy as np

from gridtally.functions import geometry as G
from gridtally.operators.regions import polygon_validity
from gridtally.operators.repair import polygon_repair, trace


def even_odd_area(rings):
    """The area that a ray from inside leaves through an odd number of edges, slice by slice."""
    edges = [(a, b) for r in rings for a, b in zip(r, [*r[1:], r[0]]) if a[0] != b[0]]
    xs = {p[0] for e in edges for p in e}
    for i, ((ax, ay), (bx, by)) in enumerate(edges):
        for (cx, cy), (dx, dy) in edges[:i]:
            cross = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
            if cross:
                t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / cross
                if 0 < t < 1:
                    xs.add(ax + t * (bx - ax))
    total, xs = 0.0, sorted(xs)
    for x1, x2 in zip(xs, xs[1:]):
        x = (x1 + x2) / 2
        ys = sorted(a[1] + (x - a[0]) / (b[0] - a[0]) * (b[1] - a[1]) for a, b in edges if (a[0] > x) != (b[0] > x))
        total += (x2 - x1) * sum(high - low for low, high in zip(ys[::2], ys[1::2]))
    return total


def signed_area(rings):
    return sum((a * d - c * b) / 2 for r in rings for (a, b), (c, d) in zip(r, r[1:]))


def closed(points):
    return [*points, points[0]]


def shapes():
    rnd = random.Random(8)
    point = lambda size: (rnd.uniform(-size, size), rnd.uniform(-size, size))
    whole = lambda size: (float(rnd.randrange(size)), float(rnd.randrange(size)))
    out = {f"tangle{i}": [closed([point(5) for _ in range(rnd.choice([4, 5, 8, 30]))])] for i in range(25)}
    out |= {f"two{i}": [closed([point(5) for _ in range(6)]), closed([point(3) for _ in range(4)])] for i in range(10)}
    # many edges that lie on one another, end on one another, or run along the axes
    out |= {f"grid{i}": [closed([whole(5) for _ in range(rnd.choice([4, 7, 12]))]) for _ in range(rnd.choice([1, 2]))]
            for i in range(40)}
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    out["open"] = [square]
    out["repeated"] = [[square[0], *closed(square)]]
    out["spike"] = [closed([*square, (0.0, 8.0)])]
    out["hole over the border"] = [closed(square), closed([(3.0, 1.0), (3.0, 2.0), (6.0, 2.0), (6.0, 1.0)])]
    out["shared side"] = [closed(square), closed([(4.0, 0.0), (8.0, 0.0), (8.0, 4.0), (4.0, 4.0)])]
    out["same twice"] = [closed(square), closed(square)]
    out["five-pointed"] = [closed([(math.cos(4 * math.pi * i / 5), math.sin(4 * math.pi * i / 5)) for i in range(5)])]
    out["line"] = [[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]
    out["not finite"] = [closed([*square, (float("nan"), 1.0), (float("inf"), 1.0)])]
    return out


def test_repaired_polygons_cover_the_same(spark):
    given = shapes()
    sound = {"sound": [closed([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])],
             "with hole": [closed([(0.0, 0.0), (9.0, 0.0), (9.0, 9.0)]), closed([(5.0, 1.0), (5.0, 2.0), (6.0, 2.0)])]}
    rows = [(k, v) for k, v in (given | sound).items()] + [("none", None), ("empty", [])]
    df = spark.createDataFrame(rows, f"geoid STRING, rings {G.RINGS_TYPE}").repartition(5)
    mended = polygon_repair(df)
    found = {r.geoid: None if r.rings is None else [[tuple(p) for p in ring] for ring in r.rings] for r in mended.collect()}
    assert len(found) == len(rows) and found["none"] is None and found["empty"] == []
    for name in sound:
        assert found[name] == sound[name]
    changed = 0
    for name, rings in given.items():
        finite = [[p for p in r if all(map(math.isfinite, p))] for r in rings]
        wanted = even_odd_area(finite)
        # sound ones come back as they are, whichever way they run
        mine = wanted if found[name] == rings else signed_area(found[name] or [])
        changed += found[name] != rings
        assert math.isclose(mine, wanted, rel_tol=1e-9, abs_tol=1e-9), (name, mine, wanted)
        # the rings themselves, whichever way they run
        assert math.isclose(even_odd_area(found[name] or []), wanted, rel_tol=1e-9, abs_tol=1e-9), name
    assert changed > 60 and found["same twice"] is None and found["line"] is None and len(found["spike"]) == 1
    exact = [n for n in given if not n.startswith(("tangle", "two", "five"))]
    report = {r.geoid: r for r in polygon_validity(mended).collect()}
    crossing = {n for n in exact if report[n].crosses and found[n] is not None}
    assert not {n for n in crossing if not n.startswith("grid")}
    before = {r.geoid: r.crosses for r in polygon_validity(df).collect()}
    assert before["five-pointed"] and before["spike"] and before["same twice"] and before["shared side"]
    assert not before["sound"] and not before["with hole"] and not before["open"]


def test_rings_that_touch_in_a_point_are_rings_of_their_own():
    def pieces(*rings):
        return np.array([(*a, *b) for r in rings for a, b in zip(r, r[1:])])

    left = [(0.0, 0.0), (2.0, 1.0), (0.0, 2.0), (0.0, 0.0)]
    right = [(2.0, 1.0), (4.0, 0.0), (4.0, 2.0), (2.0, 1.0)]
    assert sorted(map(len, trace(pieces(left, right)))) == [4, 4]
    outer = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0), (0.0, 0.0)]
    hole = [(0.0, 0.0), (3.0, 6.0), (6.0, 3.0), (0.0, 0.0)]
    found = trace(pieces(outer, hole))
    assert [len(r) for r in found] == [5, 4] and signed_area(found) == 81 - 13.5
    far = [(x + 20, y) for x, y in outer]
    inner = [(x + 21, y + 1) for x, y in hole]
    island = [(22.5 + x / 9, 3 + y / 9) for x, y in outer]
    found = trace(pieces(outer, far, inner, island))
    assert [r[0][0] >= 20 for r in found] == [False, True, True, True]
    assert math.isclose(signed_area(found), 81 + 81 - 13.5 + 1)
    assert trace(np.empty((0, 4))) == []
