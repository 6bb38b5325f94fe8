import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.streaming import live

SHAPE = "obs_id bigint, cell_id bigint, time timestamp_ntz, precip_rate float"
T = dt.datetime(2024, 1, 1)


def land(spark, tmp_path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SHAPE).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i}"))
    return spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in")).withColumn("time", F.col("time").cast("timestamp"))


def run(spark, df, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName("out").outputMode(mode).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table("out").collect()


ROWS = [[(1, 7, T, 1.0), (2, 7, T + dt.timedelta(minutes=5), 3.0), (2, 7, T + dt.timedelta(minutes=5), 3.0)], [(3, 7, T + dt.timedelta(minutes=20), 5.0), (4, 7, T + dt.timedelta(minutes=21), -1.0)], [(5, 7, T + dt.timedelta(hours=9), 2.0)]]


def test_steps_close_with_the_watermark(spark, tmp_path):
    d = live.rain_steps(live.deduplicated(land(spark, tmp_path, ROWS), ["obs_id"], "1 hour"), 15, None)
    got = {(r.step_start.minute, r.n, r.rate) for r in run(spark, d, tmp_path)}
    assert got == {(0, 2, 2.0), (15, 1, 5.0)}


def test_running_peaks(spark, tmp_path):
    got = [r.peak for r in run(spark, live.running_peaks(land(spark, tmp_path, ROWS), "1 hour"), tmp_path)]
    assert max(got) == 5.0 and 2.0 not in got


@pytest.mark.parametrize("files", [1, 9])
def test_running_peaks_gives_every_rise(spark, tmp_path, files):
    land(spark, tmp_path, [[ROWS[0][1], (9, 7, T + dt.timedelta(minutes=5), 2.0), (8, 7, T + dt.timedelta(minutes=2), 0.5), ROWS[0][0]], *ROWS[1:]])
    d = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True).parquet(str(tmp_path / "in")).withColumn("time", F.col("time").cast("timestamp"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        got = run(spark, live.running_peaks(d, "1 hour"), tmp_path)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.time, r.peak) for r in got) == [(T, 1.0), (T + dt.timedelta(minutes=5), 3.0), (T + dt.timedelta(minutes=20), 5.0)]


def test_wet_spells_and_rolling(spark, tmp_path):
    got = run(spark, live.wet_spells(land(spark, tmp_path, ROWS), "30 minutes", "1 hour"), tmp_path)
    assert [(r.n, r.top) for r in got] == [(4, 5.0)]
    d = live.rolling_steps(spark.readStream.schema(SHAPE).option("recursiveFileLookup", True).parquet(str(tmp_path / "in")).selectExpr("cell_id", "cast(time AS timestamp) AS time", "precip_rate"), 1, 30, "1 hour")
    q = d.writeStream.format("memory").queryName("roll").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert max(r.total for r in spark.table("roll").collect()) == 12.0


def test_store_by_day_is_idempotent(spark, tmp_path):
    d = land(spark, tmp_path, ROWS)
    for k in range(2):
        live.store_by_day(d, str(tmp_path / "out"), str(tmp_path / f"cp{k}"), ["obs_id"]).awaitTermination()
    assert sorted(r.obs_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4, 5]
