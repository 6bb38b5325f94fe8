import math
import random

import numpy as np

import freshet.operators.nearby as N

P = "id string, lat double, lon double"
SPECIAL = [("nul", None, 1.0), ("nan", float("nan"), 1.0), ("far", -9999.0, -9999.0), ("zero", 0.0, 0.0), ("lon", 10.0, 181.0)]


def km(a, b):
    p, q = map(math.radians, (a[0], b[0]))
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1, h)))


def test_near_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "PART_POINTS", 40)
    rng = random.Random(1)
    a = [(f"a{i}", rng.uniform(-2, 2), rng.uniform(178, 182)) for i in range(300)] + [("pole", 89.99, 10.0), ("dup", 1.0, 179.0), ("dup", 1.0, 179.0), ("same", 1.0, 179.0)]
    a = [(k, la, lo if lo <= 180 else lo - 360) for k, la, lo in a]
    b = [(f"b{i}", rng.uniform(-2, 2), rng.choice([1, -1]) * rng.uniform(178, 180)) for i in range(300)] + [("npole", 89.99, -170.0), ("edge", 1.0, 179.0)]
    A = spark.createDataFrame(a + SPECIAL, P).selectExpr("*", "1 AS part", "2 AS km", "3 AS left_key")
    B = spark.createDataFrame(b + SPECIAL, P).selectExpr("*", "1 AS part")
    got = [(r.left_key, r.right_key) for r in N.near(A, B, 25.0, ("id", "lat", "lon"), ("id", "lat", "lon")).collect()]
    want = {(x[0], y[0]) for x in a for y in b if km(x[1:], y[1:]) <= 25}
    assert set(got) == want and len(got) == len(want) and ("pole", "npole") in want and ("dup", "edge") in want
    own = {(r.left_key, r.right_key) for r in N.near(A, A, 0.0, ("id", "lat", "lon"), ("id", "lat", "lon")).collect()}
    assert ("dup", "same") in own and ("a1", "a1") in own


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for p, q in zip(ring, ring[1:]):
            if (p[0] <= x) != (q[0] <= x):
                odd ^= p[1] + (x - p[0]) * (q[1] - p[1]) / (q[0] - p[0]) > y
    return odd


def test_regions_with_holes_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(N, "PART_POINTS", 60)
    rng = np.random.default_rng(3)
    star = lambda cx, cy, n, r: (lambda t, s: [*zip(cx + r * s * np.cos(t), cy + r * s * np.sin(t))])(np.sort(rng.uniform(0, 6.28, n)), rng.uniform(0.5, 1, n))
    shapes = {f"u{k}": [star(rng.uniform(0, 10), rng.uniform(0, 10), 12, 3)] for k in range(12)}
    shapes["holed"] = [[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]]
    shapes["pieces"] = [[(0, 0), (1, 0), (0, 1)], [(9, 9), (10, 9), (9, 10)]]
    rings = {k: [[(float(x), float(y)) for x, y in [*r, r[0]]] for r in v] for k, v in shapes.items()}
    units = spark.createDataFrame([(k, v) for k, v in rings.items()] + [("none", None), ("empty", []), (None, [])], "huc string, rings array<array<struct<x double, y double>>>")
    units = units.unionByName(units.filter("huc = 'holed'"))
    pts = [(f"p{i}", float(rng.uniform(-1, 11)), float(rng.uniform(-1, 11))) for i in range(400)] + [("c", 5.0, 5.0), ("c2", 0.2, 0.2)]
    df = spark.createDataFrame(pts + SPECIAL, P).selectExpr("*", "'x' AS region", "1 AS slab")
    got = [(r.left_key, r.region) for r in N.containing(df, units, ("id", "lat", "lon"), "huc", "rings").collect()]
    want = {(k, u) for k, la, lo in pts for u, rs in rings.items() if inside(lo, la, rs)}
    assert set(got) == want and len(got) == len(want)


def test_empty(spark):
    none, one = spark.createDataFrame([], P), spark.createDataFrame([("a", 1.0, 1.0)], P)
    at = ("id", "lat", "lon")
    assert N.near(none, one, 5, at, at).collect() == [] and N.near(one, none, 5, at, at).collect() == []
    units = spark.createDataFrame([], "huc string, rings array<array<struct<x double, y double>>>")
    assert N.containing(one, units, at, "huc", "rings").collect() == []
