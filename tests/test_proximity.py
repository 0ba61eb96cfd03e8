import math

import numpy as np
import pytest

from tessella.operators import neighbours, proximity

POINTS = "id long, s string, px double, py double, k string, x string"


def points(spark, rows):
    # k and x are columns whose names the operator uses itself
    return spark.createDataFrame([(*r, "other", "other") for r in rows], POINTS)


def brute(rows, radius):
    good = {(k, s, x, y) for k, s, x, y in rows if None not in (k, s, x, y) and math.isfinite(x) and math.isfinite(y)}
    return {(a[0], b[0]) for a in good for b in good if a[0] < b[0] and a[1] == b[1] and math.sqrt((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2) <= radius}


@pytest.mark.parametrize("radius", [0.5, 3.0, 40.0])
def test_near_pairs_equal_all_pairs(spark, radius):
    rng = np.random.default_rng(int(radius * 10))
    rows = [(i, rng.choice(["a", "b"]), float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-30, 30, (150, 2)))]
    rows += [(i, s, x, y) for i, s, x, y in rows[:10]]  # delivered again
    rows += [(500, "a", 0.0, 0.0), (501, "a", 0.0, 0.0), (502, "a", radius, 0.0), (503, None, 0.0, 0.0), (504, "a", None, 0.0), (505, "a", float("nan"), 0.0), (506, "a", float("inf"), 0.0), (None, "a", 0.0, 0.0)]
    got = [tuple(r) for r in proximity.near_pairs(points(spark, rows), "id", "px", "py", "s", radius).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows, radius)


def test_near_pairs_of_nothing(spark):
    assert proximity.near_pairs(points(spark, []), "id", "px", "py", "s", 5.0).count() == 0


def inside(x, y, v):
    hit = False
    for (x1, y1), (x2, y2) in zip(v, v[1:] + v[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_points_in_regions(spark, limit):
    rng = np.random.default_rng(3)
    star = [(50 + r * math.cos(t), 40 + r * math.sin(t)) for t, r in zip(np.linspace(0, 2 * math.pi, 13)[:-1], [30, 9] * 6)]
    square = [(0.0, 0.0), (20.0, 0.0), (20.0, 20.0), (0.0, 20.0), (0.0, 0.0)]
    outlines = {1: ("a", star), 2: ("a", square[::-1]), 3: ("b", square), 4: ("a", square[:2]), 5: ("a", None), 6: ("a", [(0.0, 0.0), (float("nan"), 1.0), (5.0, 5.0)])}
    regions = spark.createDataFrame([(r, s, None if v is None else [{"x": float(p[0]), "y": float(p[1])} for p in v]) for r, (s, v) in outlines.items()], "rid long, s string, vertices array<struct<x:double,y:double>>")
    rows = [(i, rng.choice(["a", "b"]), float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-10, 90, (800, 2)))]
    got = {tuple(r) for r in proximity.points_in_regions(points(spark, rows + rows[:5] + [(900, "a", None, 1.0)]), "id", "px", "py", regions, "rid", "s", broadcast_rows=limit).collect()}
    want = {(r, i) for r, (s, v) in outlines.items() if r < 4 for i, g, x, y in rows if g == s and inside(x, y, [(float(a), float(b)) for a, b in v])}
    assert got == want


def test_cover_keeps_interior_cells_whole():
    cells = proximity.cover_outline(np.array([0.1, 63.9, 63.9, 0.1]), np.array([0.1, 0.1, 63.9, 63.9]))
    area = sum(4.0**level for level, _, _, interior in cells if interior)
    assert area > 0.7 * 63.8**2
    assert len({level for level, *_ in cells}) > 2


@pytest.mark.parametrize("with_self,block", [(False, 7), (False, 512), (True, 20)])
def test_nearest_equals_brute_force(spark, with_self, block):
    rng = np.random.default_rng(9)
    rows = [("a", i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 10, (120, 2)))]
    rows += [("a", 500, 9000.0, -9000.0), ("a", 501, 1.0, 1.0), ("a", 502, 1.0, 1.0)]  # far off, and on one place
    rows += [("d", 800 + i, 3.0, 4.0) for i in range(40)] + [("d", 900, 3.0, 4.5)]  # copies of a third of all rows
    rows += [("b", 600, 0.0, 0.0), ("b", 601, 5.0, 0.0), ("c", 700, 1.0, 1.0)]  # fewer than k
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, "g string, k long, x double, y double"), 4, with_self, block).collect():
        got.setdefault(r["src"], []).append((r["rank"], r["dst"]))
    for g, k, x, y in rows:
        near = sorted((math.sqrt((x - x2) ** 2 + (y - y2) ** 2), k2) for g2, k2, x2, y2 in rows if g2 == g and (with_self or k2 != k))[:4]
        assert [d for _, d in sorted(got.get(k, []))] == [k2 for _, k2 in near]
    none = spark.createDataFrame([], "g string, k long, x double, y double")
    assert neighbours.nearest(none, 4, with_self, block).count() == 0
