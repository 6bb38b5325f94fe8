import json
import sqlite3
import struct
import zlib

import numpy as np
import pytest

from freshet.sources import geofeatures, grids, reports, sinks


def test_storm_events(spark, tmp_path):
    head = "EPISODE_ID,EVENT_ID,EVENT_TYPE,BEGIN_YEARMONTH,BEGIN_DAY,BEGIN_TIME,END_YEARMONTH,END_DAY,END_TIME,EVENT_NARRATIVE,MORE\n"
    (tmp_path / "x_d2021_c1.csv").write_text(head + '1,10,Flash Flood,202101,5,2575,202101,4,100,"two\nlines, ""quoted""",z\n1,11,Hail,202101,5,100,202101,5,200,x,z\n')
    (tmp_path / "x_d2019_c1.csv").write_text(head + "2,20,Flash Flood,201902,31,100,201903,1,100,x,z\n")
    d = reports.event_times(reports.storm_events(spark, str(tmp_path), years=(2020, 2022)))
    (r,) = d.collect()
    assert (r.EVENT_ID, r.EVENT_NARRATIVE, str(r.begin_local), str(r.end_local)) == (10, 'two\nlines, "quoted"', "2021-01-05 23:59:00", "2021-01-05 23:59:00")
    assert r.DAMAGE_CROPS is None and r.source_file == "x_d2021_c1.csv"
    assert reports.storm_events(spark, str(tmp_path), None).count() == 3
    (tmp_path / "bad.csv").write_text("A,B\n1,2\n")
    with pytest.raises(ValueError):
        reports.storm_events(spark, str(tmp_path / "bad.csv"))


def test_storm_reports(spark, tmp_path):
    (tmp_path / "a.csv").write_text("VALID,VALID2,LAT,LON,MAG,WFO,TYPECODE,TYPETEXT,CITY,COUNTY,STATE,SOURCE,REMARK,UGC,UGCNAME,QUALIFIER\n202101050101,x,1.5,2.5,,ABC\n" + ",".join("x" * 20) + "\n\n")
    (tmp_path / "b.csv").write_text("no header\n")
    (r,) = reports.storm_reports(spark, str(tmp_path)).collect()
    assert (r.VALID, r.LAT, r.WFO, r.UGC) == ("202101050101", "1.5", "ABC", None)


def test_text_answers(spark, tmp_path):
    (tmp_path / "s.rdb").write_text("# note\nsite_no\tstation_nm\n15s\t50s\n0123\tBig River \n")
    assert [tuple(r) for r in reports.tab_answers(spark, str(tmp_path / "s.rdb"), ["site_no", "station_nm"]).collect()] == [("0123", "Big River")]
    (tmp_path / "p.js").write_text('// c\nvar X = {"a": {"n": 3}};\n')
    assert reports.script_payload(spark, str(tmp_path / "p.js"), "a struct<n: int>").first().data.a.n == 3
    one = {"value": {"timeSeries": [{"sourceInfo": {"siteName": "R", "siteCode": [{"value": "01"}], "geoLocation": {"geogLocation": {"latitude": 1.0, "longitude": 2.0}}}, "values": [{"value": [{"value": "3.5", "dateTime": "2024-01-01T00:00:00.000-05:00"}, {"value": "", "dateTime": "2024-01-01T00:15:00.000-05:00"}]}, {"value": [{"value": "9", "dateTime": "2024-01-01T00:00:00Z"}]}]}]}}
    (tmp_path / "g.json").write_text(json.dumps(one))
    got = [(r.site, r.value) for r in reports.gauge_answers(spark, str(tmp_path / "g.json")).orderBy("time").collect()]
    assert got == [("01", 3.5), ("01", None)]


SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 0.0)]


def wkb(ring):
    return struct.pack("<BII", 1, 3, 1) + struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring)


def test_geo(spark, tmp_path):
    feats = [{"type": "Feature", "properties": {"id": "a"}, "geometry": {"type": "Polygon", "coordinates": [SQUARE]}}, {"type": "Feature", "properties": {"id": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [[SQUARE], [SQUARE]]}}]
    (tmp_path / "f.js").write_text("var G = " + json.dumps({"type": "FeatureCollection", "features": feats}))
    got = {r.id: len(r.rings) for r in geofeatures.geojson(spark, str(tmp_path / "f.js"), "id: string").collect()}
    assert got == {"a": 1, "b": 2}
    path = str(tmp_path / "x.gpkg")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE divides (id TEXT, n INTEGER, geom BLOB)")
        head = b"GP\x00\x03" + struct.pack("<i", 4326) + struct.pack("<4d", 0, 2, 0, 2)
        db.executemany("INSERT INTO divides VALUES (?, ?, ?)", [(f"c{i}", i, head + wkb(SQUARE) if i % 2 else wkb(SQUARE)) for i in range(20)])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(geofeatures.GeoPackage)
    d = spark.read.format("gpkg").schema(f"id string, n bigint, rings {geofeatures.RINGS}").option("table", "divides").option("partitions", 3).load(path)
    assert d.count() == 20 and [tuple(p) for p in d.filter("id = 'c7'").first().rings[0]] == SQUARE
    assert sorted(r.n for r in d.filter("id IN ('c1', 'c2')").collect()) == [1, 2]


def png(values, bits=16, filters=(0, 1, 2, 3, 4)):
    raw = values.astype(">u2" if bits == 16 else np.uint8).tobytes()
    step, width = bits // 8, values.shape[1] * (bits // 8)
    rows, before = b"", bytes(width)
    for y in range(values.shape[0]):
        line, f = raw[y * width : (y + 1) * width], filters[y % len(filters)]
        left = lambda i, r: r[i - step] if i >= step else 0
        out = bytearray()
        for i, x in enumerate(line):
            a, b, c = left(i, line), before[i], left(i, before)
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            out.append((x - (0, a, b, (a + b) // 2, paeth)[f]) & 255)
        rows += bytes([f]) + bytes(out)
        before = line
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + b"\0\0\0\0"
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", values.shape[1], values.shape[0], bits, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_grid_messages(spark, tmp_path):
    rng = np.random.default_rng(1)
    v = rng.integers(0, 60000, (7, 9))
    sec = lambda n, body: struct.pack(">IB", len(body) + 5, n) + body
    grid = bytes(25) + struct.pack(">II", 9, 7) + bytes(30)
    pack = bytes(4) + struct.pack(">H", 41) + struct.pack(">fHH", -30.0, 0, 1) + bytes(2)
    body = sec(1, bytes(16)) + sec(3, grid) + sec(5, pack) + sec(7, png(v))
    message = b"GRIB" + bytes(4) + struct.pack(">Q", 16 + len(body) + 4) + body + b"7777"
    (tmp_path / "g.grib2").write_bytes(message * 2)
    got = grids.grid_cells(spark, str(tmp_path / "g.grib2")).toPandas()
    want = (v - 30.0) / 10
    assert set(got["message"]) == {0, 1} and len(got) == 2 * (want >= 0).sum()
    one = got[got["message"] == 1]
    assert np.allclose(one["value"], want[one["row"], one["col"]], rtol=1e-6)


def test_own_series(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1.0, 2.0, 4.0)], "t string, lat double, lon double, p double").selectExpr("cast(t AS timestamp_ntz) AS time", "lat", "lon", "p")
    r = grids.own_series(df, "p", "in/h", 0.5).first()
    assert str(r.time) == "2024-01-01 00:30:00" and abs(r.depth_mm - 50.8) < 1e-9
    with pytest.raises(ValueError):
        grids.own_series(df, "p", "cubits", 1)
    with pytest.raises(ValueError):
        grids.own_series(df.drop("lat"), "p", "mm", 1)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', 1.5), (2, None, 2.0), (3, "x\ny", None)], "id int, s string, v double")
    sinks.write_table(df, str(tmp_path / "t"), csv=True)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "t/parquet")).collect())) == sorted(map(str, df.collect()))
    assert spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path / "t/csv")).filter("id = 1").first().s == 'a "b", c'
    sinks.write_script(df, str(tmp_path / "js"), "T")
    assert spark.read.text(str(tmp_path / "js/head")).first().value == 'var T = {"fields": ["id", "s", "v"], "rows": []};'
    rows = [r.value for r in spark.read.text(str(tmp_path / "js/rows")).collect()]
    assert sorted(json.loads(x[len("T.rows.push(") : -2]) for x in rows) == [[1, 'a "b", c', 1.5], [2, None, 2.0], [3, "x\ny", None]]
    sinks.write_documents(df, str(tmp_path / "docs"), "id")
    assert spark.read.json(str(tmp_path / "docs")).count() == 3
    unit = spark.createDataFrame([("a", [[(0.123456789, 1.0), (2.0, 3.0)]])], f"name string, rings {geofeatures.RINGS.replace(': ', ' ')}")
    assert json.loads(unit.select(sinks.feature(unit.rings, ["name"])).first()[0]) == {"type": "Feature", "properties": {"name": "a"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0.12346, 1.0], [2.0, 3.0]]]]}}
    box = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    unit = spark.createDataFrame([("b", [box(0.0, 9.0), box(1.0, 8.0), box(20.0, 21.0), box(2.0, 3.0)])], unit.schema)
    got = json.loads(unit.select(sinks.feature(unit.rings, ["name"])).first()[0])["geometry"]["coordinates"]
    assert [[r[0] for r in p] for p in got] == [[[0.0, 0.0], [1.0, 1.0]], [[20.0, 20.0]], [[2.0, 2.0]]]
    d = sinks.data_dictionary({"t": df}, {"id": "key"}).collect()
    assert [(r.column, r.type, r.comment) for r in d] == [("id", "int", "key"), ("s", "string", ""), ("v", "double", "")]


def test_upsert_days(spark, tmp_path):
    at = str(tmp_path / "days")
    rows = lambda xs: spark.createDataFrame(xs, "k int, t string, v int").selectExpr("k", "cast(t AS timestamp_ntz) AS t", "v")
    sinks.upsert_days(rows([(1, "2024-01-01 00:00:00", 1), (2, "2024-01-02 00:00:00", 2)]), at, "t", ["k"])
    sinks.upsert_days(rows([(2, "2024-01-02 00:00:00", 20), (3, "2024-01-02 01:00:00", 3), (3, "2024-01-02 01:00:00", 3)]), at, "t", ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(at).collect()) == [(1, 1), (2, 20), (3, 3)]
