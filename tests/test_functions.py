import math
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.functions import geo, physics, text, times
from freshet.operators import catalog, series, zonal


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("c"))).collect()]


def test_text(spark):
    assert one(spark, ["1234567", "01234567.0", " 422026250 ", "810464660123456", None], text.site_id) == ["01234567", "01234567", "422026250", "810464660123456", None]
    assert one(spark, ["SAINT-JEAN", "o'BRIEN 2ND", ""], text.title_case) == ["Saint-Jean", "O'Brien 2Nd", ""]
    assert one(spark, ["", None, "0", "10.00K", "2.5m", "1.2.3", "K", "1T"], text.money) == [0, 0, 0, 10_000, 2_500_000, 0, 0, 0]
    assert one(spark, ["", "10.00K", "K", "1T"], lambda c: text.money(c, None)) == [None, 10_000, None, 1e12]
    assert one(spark, ["CST-6", "GST10", "X", None], text.zone_hours) == [-6, 10, 0, 0]
    assert one(spark, ["a  b_ c_", None, " x\n\ty "], text.clean_text) == ["a b, c,", "", "x y"]
    assert one(spark, ["TXC201", "TXZ201", None], text.county_of_ugc) == ["48201", "", ""]
    assert one(spark, [" nan ", "None", "", " x", None], text.clean_id) == [None, None, None, "x", None]


def test_times(spark):
    t = [dt.datetime(2021, 9, 30, 23, 59, 59), dt.datetime(2021, 10, 1), dt.datetime(1969, 12, 31, 23, 30)]
    assert one(spark, t, times.water_year, "timestamp_ntz") == [2021, 2022, 1970]
    assert one(spark, t, lambda c: times.floor_to(c, 3600), "timestamp_ntz")[2] == dt.datetime(1969, 12, 31, 23)
    assert one(spark, t, lambda c: times.ceil_to(c, 3600), "timestamp_ntz")[:2] == [dt.datetime(2021, 10, 1), dt.datetime(2021, 10, 1)]


def test_equal_area_keeps_areas(spark):
    # a small square at any latitude has the area that the ellipsoid gives it
    rows = [(la, lo) for la in (25.0, 37.5, 49.0) for lo in (-120.0, -96.0, -70.0)]
    df = spark.createDataFrame(rows, "la double, lo double")
    h = 0.01
    c = [geo.equal_area_xy(F.col("la") + dy * h, F.col("lo") + dx * h) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1))]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in [*c, c[0]]])
    for la, _, a in df.select("la", "lo", geo.ring_area(ring)).collect():
        import math

        e2 = 2 * geo.FLATTENING - geo.FLATTENING**2
        s = math.sin(math.radians(la + h / 2))
        m = geo.AXIS * (1 - e2) / (1 - e2 * s * s) ** 1.5
        n = geo.AXIS / math.sqrt(1 - e2 * s * s)
        want = m * n * math.cos(math.radians(la + h / 2)) * math.radians(h) ** 2
        assert abs(a / want - 1) < 1e-4


def test_cells_round_trip(spark):
    ids = [0, 6999, 7000, 24_499_999]
    assert one(spark, ids, lambda c: geo.cell_at(geo.cell_lat(c), geo.cell_lon(c)), "bigint") == ids
    assert one(spark, [60.0, 19.0], lambda c: geo.cell_at(c, F.lit(-100.0)), "double") == [None, None]


def test_evapotranspiration(spark):
    lit = [F.lit(x) for x in (95_000.0, 0.008, 2.0, -1.0)]
    day = one(spark, [20.0], lambda c: physics.hourly_reference_et(c, *lit, F.lit(700.0), F.lit(350.0)), "double")[0]
    night = one(spark, [20.0], lambda c: physics.hourly_reference_et(c, *lit, F.lit(0.0), F.lit(300.0)), "double")[0]
    dusk = one(spark, [20.0], lambda c: physics.hourly_reference_et(c, *lit, F.lit(20.0), F.lit(300.0)), "double")[0]

    def by_hand(t, short, long):
        kpa, q, u2 = 95.0, 0.008, math.hypot(2, 1) * 4.87 / math.log(672.58)
        es = 0.6108 * math.exp(17.27 * t / (t + 237.3))
        delta, gamma, ea = 4098 * es / (t + 237.3) ** 2, 0.000665 * kpa, q * kpa / (0.622 + 0.378 * q)
        rn = 0.77 * short * 0.0036 + long * 0.0036 - 0.98 * 4.903e-9 / 24 * (t + 273.15) ** 4
        g, cd = (0.1 * rn, 0.24) if rn > 0 else (0.5 * rn, 0.96)
        return max((0.408 * delta * (rn - g) + gamma * 37 / (t + 273.15) * u2 * (es - ea)) / (delta + gamma * (1 + cd * u2)), 0)

    # at dusk there is some light, but the net radiation is below zero
    for got, want in ((day, by_hand(20, 700, 350)), (night, by_hand(20, 0, 300)), (dusk, by_hand(20, 20, 300))):
        assert abs(got - want) < 1e-12


def test_class_breaks_and_totals(spark):
    vals = [5, 1, 1, 9, 9, 9, 2, 7, None, 3]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    s = sorted(v for v in vals if v is not None)
    got = {r.q: r.value for r in catalog.class_breaks(df, "v", (0.0, 0.3, 0.55, 0.96, 1.0)).collect()}
    assert got == {q: s[min(len(s) - 1, int(q * len(s)))] for q in got} and len(got) == 5
    run = series.running_total(df.filter("v IS NOT NULL").distinct(), ["v"], F.col("v"), "before", "all").orderBy("v").collect()
    assert [(r.v, r.before, r["all"]) for r in run] == [(1, 0, 27), (2, 1, 27), (3, 3, 27), (5, 6, 27), (7, 11, 27), (9, 18, 27)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.floats(0, 100)), st.floats(0.1, 5)), min_size=1, max_size=25))
def test_coverage_falls_with_the_threshold(spark, rows):
    df = spark.createDataFrame(rows, "z int, v double, w double")
    for r in zonal.coverage(df, ["z"], F.col("v"), F.col("w"), (1, 10, 50)).collect():
        assert 1 + 1e-9 >= r.cov[0] >= r.cov[1] - 1e-12 >= r.cov[2] - 2e-12 >= -1e-9
        assert r["max"] is None or r["mean"] <= r["max"] + 1e-9


def test_unknown_is_not_low(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 0)], "id int, n int")
    assert {r.id for r in df.filter(catalog.at_least({"n": 0})).collect()} == {1, 2, 3}
    assert {r.id for r in df.filter(catalog.at_least({"n": 1})).collect()} == {1}
