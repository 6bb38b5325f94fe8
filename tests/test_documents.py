import json

from pyspark.sql import functions as F

from freshet.functions import text, times
from freshet.functions.register import register
from freshet.operators import catalog
from freshet.operators.nearby import haversine_km
from freshet.sources import documents


def test_documents(spark, tmp_path):
    for k, doc in enumerate([{"id": 1, "rain": {"ep": {"max": 3.5}, "n": 2}, "f": ["a", "b"], "r": [1, 2, 3]}, {"id": 2, "rain": None}]):
        (tmp_path / f"{k}.json").write_text(json.dumps(doc, indent=1))
    d = documents.entity_documents(spark, str(tmp_path), "id INT, rain STRUCT<ep: STRUCT<max: DOUBLE>, n: INT>, f ARRAY<STRING>, r ARRAY<INT>")
    flat = documents.flattened(d)
    assert flat.columns == ["id", "rain_ep_max", "rain_n", "f", "r", "file_name"]
    assert [(r.id, r.rain_ep_max, r.rain_n) for r in flat.orderBy("id").collect()] == [(1, 3.5, 2), (2, None, None)]
    assert documents.flattened(d, keep=("rain_ep",)).columns[1] == "rain_ep"
    assert d.filter("id = 1").select(documents.zipped(F.col("f"), F.col("r")).alias("m")).first().m == {"a": 1, "b": 2}


def test_registered_functions(spark):
    names = register(spark)
    df = spark.createDataFrame([(" 123.0", "2020-10-02", 40.0, -90.0, "CST-6"), ("123456789", "2020-09-30", 10.0, 1.0, "x"), (None, None, None, None, None)], "s string, d string, y double, x double, z string")
    df = df.withColumn("t", F.to_timestamp_ntz("d"))
    got = df.selectExpr("site_id(s)", "water_year(t)", "haversine_km(y, x, 0D, 0D)", "cell_at(y, x)", "zone_hours(z)").collect()
    want = df.select(text.site_id(F.col("s")), times.water_year(F.col("t")), haversine_km(F.col("y"), F.col("x"), F.lit(0.0), F.lit(0.0))).collect()
    assert [tuple(r)[:3] for r in got] == [tuple(r) for r in want] and len(names) == 5
    assert got[0][3] is not None and got[1][3] is None and [r[4] for r in got] == [-6, 0, 0]


def test_breaks(spark):
    assert [r.value for r in catalog.ladder_breaks(spark.range(0).select(F.col("id").alias("v")), "v", (0.3, 0.55, 0.75, 0.88, 0.96)).collect()] == [1, 2, 3, 5, 10]
    df = spark.createDataFrame([(x,) for x in (0, -4, None, 7, 7, 8, 8, 9, 12000, 13000)], "v int")
    assert [r.value for r in catalog.ladder_breaks(df, "v", (0.3, 0.55, 0.75, 0.88, 0.96)).collect()] == [10, 15, 12000, 13000, 14000]
    df = spark.createDataFrame([(x,) for x in (3.0, 3.0, 900.0)], "v double")
    assert [r.value for r in catalog.ladder_breaks(df, "v", (0.3, 0.55, 0.75, 0.88, 0.96), money=True).collect()] == [5, 10, 1000, 2500, 5000]


def test_predicates(spark):
    df = spark.createDataFrame([("TX, OK", 5.0), ("CO", None), (None, 25.0)], "s string, v double")
    f = lambda c: [r[0] for r in df.select(c).collect()]
    assert f(catalog.any_of(F.col("s"), ["OK"])) == [True, False, False] and f(catalog.any_of(F.col("s"), [])) == [True] * 3
    assert f(catalog.open_range(F.col("v"), 0, 20, 20)) == [True] * 3 and f(catalog.open_range(F.col("v"), 1, 20, 20)) == [True, False, True] and f(catalog.open_range(F.col("v"), 0, 10, 20)) == [True, False, False]
    assert f(catalog.slider_amount(F.lit(50), F.lit(1e8))) == [1e6] * 3 and f(catalog.slider_amount(F.lit(0), F.lit(1e8))) == [0.0] * 3
    assert f(catalog.permille(F.col("v") / 10000)) == [0, None, 2] and f(catalog.as_ratio(F.col("v"), F.lit("ratio"))) == [5.0, None, 25.0]
