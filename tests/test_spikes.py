import datetime as dt
import math
from dataclasses import replace

from freshet.operators.spikes import FLOOD_PEAK, RAIN_RATE, implausible

T = dt.datetime(2024, 5, 1)
SHAPE = "id bigint, s string, t timestamp_ntz, v double"


def storm(source, start, n, first_id, top=8.0):
    """Rain that builds up and dies away, then a dry hour."""
    wave = [round(top * math.sin(math.pi * k / n) ** 2, 1) for k in range(n)] + [0.0] * 10
    return [(first_id + k, source, start + dt.timedelta(minutes=2 * k), v) for k, v in enumerate(wave)]


def rain(source, first_id, days=3):
    rows = []
    for k in range(days * 4):
        rows += storm(source, T + dt.timedelta(hours=6 * k), 90, first_id + 200 * k, top=4.0 + k % 5)
    return rows


def run(spark, rows, rules):
    df = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 AS _id", "'x' AS reason", "2 AS _block", "3 AS row_id")
    got = implausible(df, "id", "s", "t", "v", rules).collect()
    assert len(got) == len({r.row_id for r in got})
    return {r.row_id: r.reason for r in got}


def test_rain(spark):
    rows = rain("a", 0) + rain("b", 10_000)
    assert run(spark, rows, RAIN_RATE) == {}
    by = {r[0]: r for r in rows}
    put = lambda i, v: (i, by[i][1], by[i][2], v)
    want = {10: (900.0, "jump"), 210: (60.0, "jump"), 211: (70.0, "jump"), 250: (5000.0, "impossible"), 251: (-0.5, "impossible"), 10_040: (300.0, "jump")}
    changed = {i: put(i, v) for i, (v, _) in want.items()} | {k: put(k, v) for k, v in ((20, -1.0), (21, -3.0), (22, float("nan")), (23, None))}
    for k in range(420, 445):  # stuck, a little unsteady; one missing between
        changed[k], want[k] = put(k, 3.47 if k % 3 else 3.48), (0, "stuck")
    changed[430] = put(430, None)
    del want[430]
    rows = [changed.get(r[0], r) for r in rows]
    rows += [(50_000, *rows[10][1:]), (50_001, None, T, 99999.0), (50_002, "a", None, -7.0), (50_003, None, T, 400.0), (None, "a", T, 1e9)]
    want |= {50_000: (0, "jump"), 50_001: (0, "impossible"), 50_002: (0, "impossible")}
    expect = {k: r for k, (_, r) in want.items()}
    assert run(spark, rows, RAIN_RATE) == expect
    for hours in (2, 7, 24 * 365):  # blocks don't matter
        assert run(spark, rows, replace(RAIN_RATE, block=hours * 3600 * 1_000_000)) == expect


def test_peaks(spark):
    rows = [(k, "g", T + dt.timedelta(days=k), 100.0 + 37 * (k * k % 11)) for k in range(40)] + [(100, "few", T, 1e6), (101, "few", T, 1.0)]
    assert run(spark, rows, FLOOD_PEAK) == {}
    rows[7], rows[9], rows[11], rows[13] = ((k, "g", rows[k][2], v) for k, v in ((7, 40_000.0), (9, 0.1), (11, -999999.0), (13, 9_999_999.0)))
    for k in range(20, 25):
        rows[k] = (k, "g", rows[k][2], 250.0)
    assert run(spark, rows, FLOOD_PEAK) == {7: "fence", 9: "fence", 13: "impossible", **{k: "stuck" for k in range(20, 25)}}


def test_ends_of_blocks(spark):
    """Neighbours are counted in readings, however far apart: four equal peaks around the end of a block are stuck as inside of one."""
    rows = [(k, "g", T + dt.timedelta(days=50 * k), 100.0 + 37 * (k * k % 11)) for k in range(40)]
    for k in (18, 19, 20, 21):
        rows[k] = (k, "g", rows[k][2], 250.0)
    rows += [(100 + k, "g", rows[k][2], rows[k][3]) for k in (3, 19)]  # delivered twice
    want = {k: "stuck" for k in (18, 19, 20, 21, 119)}
    for days in (10, 50, 75, 333, 1000, 100_000):
        assert run(spark, rows, replace(FLOOD_PEAK, block=days * 86_400 * 1_000_000)) == want, days


def test_fences_follow_the_source(spark):
    """A gage that varies much has a wide fence, and none has one below a factor of 12."""
    wild = [(k, "w", T + dt.timedelta(days=k), math.exp(8 * math.sin(k * 1.7))) for k in range(60)]
    calm = [(200 + k, "c", T + dt.timedelta(days=k), 100.0 + k % 7) for k in range(60)]
    calm[30], calm[40] = (230, "c", calm[30][2], 1100.0), (240, "c", calm[40][2], 1500.0)
    assert run(spark, wild + calm, FLOOD_PEAK) == {240: "fence"}


def test_empty(spark):
    assert run(spark, [], RAIN_RATE) == {} and run(spark, [], FLOOD_PEAK) == {}
