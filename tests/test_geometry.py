import numpy as np

from freshet.operators import clusters, geometry, matching
from tests.test_nearby import inside

RINGS = "huc string, rings array<array<struct<x double, y double>>>"
L = [(0.1, 0.2), (2.7, 0.2), (2.7, 1.1), (1.3, 1.1), (1.3, 2.9), (0.1, 2.9), (0.1, 0.2)]
HOLE = [(0.3, 0.4), (0.3, 0.9), (0.9, 0.9), (0.9, 0.4), (0.3, 0.4)]


def test_cell_fractions(spark):
    shapes = {"l": [L], "holed": [L, HOLE], "turned": [L[::-1], HOLE]}
    df = spark.createDataFrame([*shapes.items(), ("none", None), ("empty", [])], RINGS)
    got = {}
    for r in geometry.cell_fractions(df, "huc", "rings", 1.0).collect():
        got[r.region, r.i, r.j] = r.fraction
    xs = (np.arange(100) + 0.5) / 100
    for k, rings in shapes.items():
        for i in range(3):
            for j in range(3):
                want = np.mean([inside(i + x, j + y, rings) for x in xs[::2] for y in xs[::2]])
                assert abs(got.get((k, i, j), 0.0) - want) < 0.02, (k, i, j)
    area = {r.region: r.area for r in geometry.region_area(df, "huc", "rings").collect()}
    for k in shapes:
        assert abs(sum(f for (s, _, _), f in got.items() if s == k) - area[k]) < 1e-9


def test_nearest_line(spark):
    p = spark.createDataFrame([(1, 0.0, 1.0), (2, 5.0, 5.0), (3, 90.0, 90.0)], "point_id int, x double, y double")
    s = spark.createDataFrame([("a", -1.0, 0.0, 1.0, 0.0), ("b", 0.0, 3.0, 0.0, 2.5), ("c", 4.0, 4.0, 4.0, 4.0)], "line_id string, x1 double, y1 double, x2 double, y2 double")
    got = {r.point_id: (r.line_id, round(r.distance, 6)) for r in geometry.nearest_line(p, s, 2.0).collect()}
    assert got == {1: ("a", 1.0), 2: ("c", round(2**0.5, 6))}


def test_nearest_line_all(spark):
    rng = np.random.default_rng(3)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-3, 3, (30, 2)))] + [(30, 90.0, 90.0), (31, -170.0, 5.0), (32, 90.0, 90.0), (33, None, 1.0), (34, float("nan"), 1.0), (35, 8.0, 8.0), (36, 0.5, -9.0)]
    segs = [("b", 0.0, 0.0, 1.0, 0.0), ("a", 0.0, 0.0, 1.0, 0.0), ("v", 2.0, -1.0, 2.0, 2.0), ("p", -2.0, -2.0, -2.0, -2.0), ("long", -3.0, 2.5, 3.0, 2.0)]
    want = {}
    for i, x, y in pts:
        best = (None, None)
        if x is not None and x == x:
            ds = []
            for k, x1, y1, x2, y2 in segs:
                n = (x2 - x1) ** 2 + (y2 - y1) ** 2
                t = min(max(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / n, 0), 1) if n else 0.0
                ds.append((round(float(np.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1))), 8), k))
            best = min(ds)[::-1]
        want[i] = best
    p = spark.createDataFrame(pts, "point_id int, x double, y double")
    s = spark.createDataFrame(segs, "line_id string, x1 double, y1 double, x2 double, y2 double")
    got = geometry.nearest_line_all(p, s, 0.5).collect()
    assert len(got) == len(pts) and {r.point_id: (r.line_id, r.distance and round(r.distance, 8)) for r in got} == want
    none = geometry.nearest_line_all(p, s.limit(0), 0.5).collect()
    assert len(none) == len(pts) and all(r.line_id is None for r in none)


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(400 + i, 401 + i) for i in range(60)] + [(500, 500 + i) for i in range(1, 90)]
    parent = {i: i for i in range(700)}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    nodes = spark.range(700).toDF("id")
    got = {r.id: r.component for r in clusters.components(nodes, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: top(i) for i in range(700)}
    assert clusters.components(nodes, spark.createDataFrame([], "a bigint, b bigint")).filter("id <> component").count() == 0


def test_interval_set_match(spark):
    ts = lambda s: f"2024-01-0{s}"
    r = spark.createDataFrame([(1, ts("1 09:00:00"), "c1", 0.0, 0.0), (2, ts("1 07:00:00"), "c1", 0.0, 0.0), (3, ts("1 18:00:00"), "", 10.2, 20.0), (4, ts("1 12:00:00"), None, 11.0, 20.0), (5, ts("2 12:00:00"), "c2", 0.0, 0.0), (6, ts("1 18:00:01"), "c1", 0.0, 0.0)], "report_id int, t string, county string, lat double, lon double").selectExpr("report_id", "cast(t AS timestamp_ntz) AS t", "county", "lat", "lon")
    e = spark.createDataFrame([("e", ts("1 12:00:00"), ts("1 12:00:00"), ["c1", "c1", "c2"], (9.0, 19.0, 10.0, 21.0))], "episode_id string, t0 string, t1 string, counties array<string>, box struct<min_lat double, min_lon double, max_lat double, max_lon double>").selectExpr("episode_id", "cast(t0 AS timestamp_ntz) AS t0", "cast(t1 AS timestamp_ntz) AS t1", "counties", "box")
    assert sorted(x.report_id for x in matching.interval_set_match(r, e).collect()) == [1, 3]


def test_overlaps_and_simplify(spark):
    shapes = {"l": [L], "holed": [L, HOLE], "far": [[(9.0, 9.0), (9.5, 9.0), (9.0, 9.5), (9.0, 9.0)]], "tri": [[(-1.0, 0.0), (2.0, 0.5), (0.5, 2.5), (-1.0, 0.0)]]}
    a = spark.createDataFrame([*shapes.items(), ("none", None), ("empty", [])], RINGS)
    got = {(r.left_key, r.right_key): r.area for r in geometry.overlaps(a, a, ("huc", "rings"), ("huc", "rings"), 0.7).collect()}
    assert not any("far" in k and k != ("far", "far") for k in got)
    area = {r.region: r.area for r in geometry.region_area(a, "huc", "rings").collect()}
    for k in shapes:
        assert abs(got[k, k] - area[k]) < 1e-9
    g = (np.arange(200) + 0.5) / 50 - 1
    for p, q in (("tri", "l"), ("tri", "holed"), ("l", "holed")):
        want = sum(inside(x, y, shapes[p]) and inside(x, y, shapes[q]) for x in g for y in g) / 2500
        assert abs(got[p, q] - want) < 0.03 and abs(got[p, q] - got[q, p]) < 1e-9
    ring = [(0.0, 0.0), (1.0, 0.01), (2.0, 0.0), (2.0, 2.0), (1.0, 1.2), (0.0, 2.0), (0.0, 0.0)]
    s = geometry.simplify(spark.createDataFrame([("a", [ring])], RINGS), "huc", "rings", 0.1).first()
    assert [tuple(p) for p in s.rings[0]] == [p for p in ring if p != (1.0, 0.01)]
