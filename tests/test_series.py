"""Results don't depend on blocks of time, and one source may hold most of the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import clusters, matching, series, storms

T = dt.datetime(2024, 1, 1)
DAY = 86_400_000_000


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    out = [("hot", T + dt.timedelta(hours=3 * k + rng.random()), None if rng.random() < 0.4 else round(rng.random() * 9, 3), k) for k in range(400)]
    out += [(f"s{k % 40}", T + dt.timedelta(hours=30 * rng.random() * k), round(rng.random(), 3), 1000 + k) for k in range(400)]
    return spark.createDataFrame(out, "s string, t timestamp_ntz, v double, id bigint").cache()


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("days", [1, 9])
def test_blocks(rows, days):
    b, whole = days * DAY, 100_000 * DAY
    same(series.fill_forward(rows, "s", ["t", "id"], "v", "f", b), series.fill_forward(rows, "s", ["t", "id"], "v", "f", whole))
    same(series.sessions(rows, "s", "t", 4 * 3600, b), series.sessions(rows, "s", "t", 4 * 3600, whole))
    h = rows.withColumn("h", F.date_trunc("hour", "t").cast("timestamp_ntz")).groupBy("s", "h").agg(F.round(F.sum("v"), 3).alias("v"))
    r = lambda d, *c: d.select("s", "h", *[F.round(x, 6) for x in c])
    same(r(series.rolling_sums(h, "s", "h", "v", (1, 3, 30), b), "s1", "s3", "s30"), r(series.rolling_sums(h, "s", "h", "v", (1, 3, 30), whole), "s1", "s3", "s30"))
    same(r(series.rolling_coverage(h, "s", "h", "v", 30, 0.2, b), "covered", "total"), r(series.rolling_coverage(h, "s", "h", "v", 30, 0.2, whole), "covered", "total"))
    same(series.with_previous(rows, "s", "t", ["v", "id"], b), series.with_previous(rows, "s", "t", ["v", "id"], whole))


def test_against_plain_loops(rows):
    data, last, seen = sorted(rows.collect(), key=lambda x: (x.s, x.t, x.id)), {}, {}
    want, number = {}, {}
    for x in data:
        if x.v is not None:
            last[x.s] = x.v
        if x.s not in seen or x.t - seen[x.s] > dt.timedelta(hours=4):
            number[x.s] = number.get(x.s, 0) + 1
        seen[x.s] = x.t
        want[x.id] = (last.get(x.s), number[x.s])
    f = {x.id: x.f for x in series.fill_forward(rows, "s", ["t", "id"], "v", "f", DAY).collect()}
    n = {x.id: x.session for x in series.sessions(rows, "s", "t", 4 * 3600, DAY).collect()}
    assert {k: (f[k], n[k]) for k in f} == want


def test_duration_curve(spark):
    df = spark.createDataFrame([("a", 5.0, 1), ("a", 3.0, 2), ("a", 0.0, 3), ("a", -2.0, 4), ("a", None, 5), ("a", 1.0, 6), ("b", 0.0, 7)], "s string, q double, id int")
    got = {x.id: x.exceedance for x in series.exceedance(df, "s", "q", "id").collect()}
    assert got == {1: 25.0, 2: 50.0, 6: 75.0}  # what isn't above zero doesn't count
    at = lambda p: {x.s: x.q for x in series.value_at_exceedance(df, "s", "q", "id", p).collect()}
    assert at(60.0) == {"a": 3.0 - 2.0 * 0.4} and at(1.0) == {"a": 5.0} and at(99.0) == {"a": 1.0}
    assert series.exceedance(df.filter("false"), "s", "q", "id").collect() == []


def test_as_of(rows):
    left = rows.filter("id % 3 = 0").select("id", "s", "t")
    right = rows.filter("id % 3 <> 0 AND v IS NOT NULL").select("s", "t", "v")
    got = {x.id: x.last for x in matching.as_of(left, right, "s", "t", "t", "v", "last").collect()}
    r = sorted((x.s, x.t, x.v) for x in right.collect())
    for x in left.collect():
        before = [v for s, t, v in r if s == x.s and t <= x.t]
        assert got[x.id] == (before[-1] if before else None)


def test_storm_cells(spark):
    """Two cells, one stuck high in four hours: it counts for the area alone, and is taken out of the hourly mean where it is high."""
    rows = []
    for k in range(-5, 6):
        h = T + dt.timedelta(hours=k)
        rows += [("x", 1, 7, 1.0, T, h, float(k) if k > 0 else None), ("x", 2, 7, 1.0, T, h, 120.0 if 1 <= k <= 4 else 2.0)]
    df = spark.createDataFrame(rows, "storm string, cell bigint, unit bigint, w double, t0 timestamp_ntz, hour timestamp_ntz, v double")
    k = storms.cell_rain(df)
    by = {x.cell: x for x in k.collect()}
    assert by[2].hot and not by[1].hot and (by[1].m1, by[1].m3, by[1].ep, by[1].pre) == (5.0, 12.0, 15.0, 0.0) and by[1].h1 == T + dt.timedelta(hours=5)
    f = storms.footprint_rain(k, ["storm"]).first()
    assert (f.n_hot, f.ep_max, f.ep_mean, f.m3_max) == (1, 15.0, 15.0, 12.0) and abs(f.km2 - 2 * 1.1132**2) < 1e-9
    hourly = {(x.hour - T).seconds // 3600: (x.mean, x.top) for x in storms.hourly_rain(df, k).collect()}
    assert hourly == {0: (2.0, 2.0), 1: (1.0, 1.0), 2: (2.0, 2.0), 3: (3.0, 3.0), 4: (4.0, 4.0), 5: (3.5, 5.0)}
    assert storms.footprint_rain(storms.cell_rain(df.filter("false")), ["storm"]).collect() == []


def test_circles(spark):
    rng = random.Random(4)
    pts = [(k, k % 2, T + dt.timedelta(hours=rng.random() * 60), 40 + rng.random() * 2, -90 + rng.random() * 2, rng.random() * 12) for k in range(300)]
    pts += [(900, 0, T, 80.0, 10.0, 30.0), (901, 0, T, 80.1, 12.0, 30.0), (902, 0, None, 80.1, 12.0, 30.0)]
    df = spark.createDataFrame(pts, "id bigint, g int, t timestamp_ntz, y double, x double, r double")
    got = {(x.a, x.b) for x in clusters.circle_links(df, "g", "id", "t", "y", "x", "r", 6.0, 1.0).collect()}
    from math import asin, cos, radians, sin, sqrt

    def km(a, b):
        d = sin(radians(b[3] - a[3]) / 2) ** 2 + cos(radians(a[3])) * cos(radians(b[3])) * sin(radians(b[4] - a[4]) / 2) ** 2
        return 2 * 6371 * asin(sqrt(d))

    ok = [p for p in pts if p[2]]
    want = {(a[0], b[0]) for a in ok for b in ok if a[0] < b[0] and a[1] == b[1] and abs((a[2] - b[2]).total_seconds()) <= 6 * 3600 and abs(a[3] - b[3]) <= 0.6 and km(a, b) <= a[5] + b[5] + 2}
    assert got == want and (900, 901) in want and len(want) > 50
    c = clusters.components(df, df.limit(0).select(F.col("id").alias("a"), F.col("id").alias("b")))
    names = {x.component: x.cluster_id for x in clusters.numbered(df.dropna().join(c, "id"), "g", "component", "t", "id").collect()}
    order = sorted((p for p in ok if p[1] == 1), key=lambda p: (p[2], p[0]))
    assert [names[p[0]] for p in order] == [f"1_{i + 1}" for i in range(len(order))]
