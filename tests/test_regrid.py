import datetime as dt

from freshet.operators.regrid import regrid

T = dt.datetime(2024, 3, 1)
R = "cell bigint, t timestamp_ntz, v double"
W = "w string, cell bigint, a timestamp_ntz, b timestamp_ntz"
minute = lambda m: T + dt.timedelta(minutes=m)


def run(spark, readings, windows, **kw):
    r = spark.createDataFrame(readings, R).selectExpr("*", "1 AS _t", "'x' AS step", "0 AS n")
    w = spark.createDataFrame(windows, W).selectExpr("*", "7 AS v", "8 AS _k")
    rows = regrid(r, w, "cell", "t", "v", "w", "a", "b", **kw).collect()
    assert len(rows) == len({(x.w, x.step) for x in rows})
    return {(x.w, x.step): x for x in rows}


def test_marks_and_shares(spark):
    bad = [(1, minute(50), x) for x in (None, float("nan"), -1.0, -3.0, float("inf"))]
    rows = [(1, minute(5), 6.0), (1, minute(20), 12.0), (1, minute(20), 12.0), (1, minute(70), 3.0), (None, minute(31), 1.0), (1, None, 1.0), *bad]
    win = [("x", 1, minute(0), minute(90)), ("x", 1, minute(0), minute(90)), ("y", 1, minute(7), minute(37)), ("none", 2, minute(0), minute(30)), ("late", 1, minute(600), minute(630))]
    win += [("null", None, minute(0), minute(30)), ("open", 1, minute(0), None), ("short", 1, minute(0), minute(10))]
    got = run(spark, rows, win)
    assert {k[0] for k in got} == {"x", "y", "none", "late"}
    assert [got["x", k].n_readings for k in range(6)] == [1, 2, 0, 0, 1, 0]
    assert [got["x", k].status for k in range(6)] == ["observed", "observed", "filled", "filled", "observed", "empty"]
    # 12 mm/h between minutes 5 and 20: 10 minutes in step 0, 5 in step 1; 3 mm/h from 20 to 70
    assert abs(got["x", 0].amount - 2.0) < 1e-9 and abs(got["x", 1].amount - 1.5) < 1e-9 and abs(got["x", 2].amount - 0.75) < 1e-9
    assert got["x", 5].amount is None and abs(got["x", 0].covered - 10 / 15) < 1e-9
    assert [got["y", k].n_readings for k in range(2)] == [2, 0]
    assert all(x.status == "empty" for k, x in got.items() if k[0] in ("none", "late"))


def test_counter_with_reset_and_block_borders(spark):
    # a counter that grows by 1 a minute and begins again at minute 400 (block of 6 hours: 360)
    rows = [(1, minute(m), float(m if m < 400 else m - 400)) for m in range(0, 721, 5)]
    got = run(spark, rows, [("x", 1, minute(0), minute(720))], counter=True)
    amounts = [got["x", k].amount for k in range(48)]
    assert all(abs(a - 15) < 1e-6 for k, a in enumerate(amounts) if k != 26)
    assert abs(amounts[26] - 10) < 1e-6  # what was counted between 395 and the reset is not known


def test_empty(spark):
    assert run(spark, [], [("x", 1, minute(0), minute(30))])["x", 1].status == "empty"
    assert run(spark, [(1, minute(1), 1.0)], []) == {}
