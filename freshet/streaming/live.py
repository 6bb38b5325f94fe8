"""Streams: rain per cell and step, running peaks of each cell, and deliveries that come more than once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from freshet.operators.regrid import usable
from freshet.sources.sinks import upsert_days


def scans(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 50) -> DataFrame:
    """Scans as they land in a folder; times without zone are taken as UTC instants, which watermarks need."""
    d = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return d.withColumn("time", F.convert_timezone(F.lit("UTC"), F.current_timezone(), "time").cast("timestamp"))


def _waiting(df: DataFrame, late: str | None) -> DataFrame:
    """df with a watermark; None for a stream that has its own, as after deduplicated()."""
    return df.withWatermark("time", late) if late else df


def deduplicated(df: DataFrame, keys: list[str], late: str) -> DataFrame:
    """Deliveries of one reading count once, as long as they come within `late` of each other."""
    return df.withWatermark("time", late).dropDuplicatesWithinWatermark(keys)


def rain_steps(df: DataFrame, minutes: int, late: str | None) -> DataFrame:
    """(cell_id, step_start, n, rate) for each closed step: tumbling windows that wait for late scans."""
    d = _waiting(df.filter(usable(F.col("precip_rate"))), late)
    g = d.groupBy(F.window("time", f"{minutes} minutes"), "cell_id").agg(F.count("*").alias("n"), F.avg(F.col("precip_rate").cast("double")).alias("rate"))
    return g.select("cell_id", F.col("window.start").alias("step_start"), "n", "rate")


def rolling_steps(df: DataFrame, hours: int, slide_minutes: int, late: str | None) -> DataFrame:
    """Sliding windows: (cell_id, window_end, total rate) over so many hours, every slide_minutes."""
    d = _waiting(df.filter(usable(F.col("precip_rate"))), late)
    g = d.groupBy(F.window("time", f"{hours} hours", f"{slide_minutes} minutes"), "cell_id").agg(F.sum(F.col("precip_rate").cast("double")).alias("total"))
    return g.select("cell_id", F.col("window.end").alias("window_end"), "total")


def wet_spells(df: DataFrame, gap: str, late: str | None) -> DataFrame:
    """Sessions of rain: scans above zero of a cell with no gap longer than `gap`."""
    d = _waiting(df.filter(usable(F.col("precip_rate")) & (F.col("precip_rate") > 0)), late)
    g = d.groupBy(F.session_window("time", gap), "cell_id").agg(F.count("*").alias("n"), F.max("precip_rate").alias("top"))
    return g.select("cell_id", F.col("session_window.start").alias("begin"), F.col("session_window.end").alias("end"), "n", "top")


def running_peaks(df: DataFrame, late: str | None) -> DataFrame:
    """(cell_id, time, peak) whenever a cell's highest usable rate so far rises; the state is one number a cell.

    Within a micro-batch readings count in order of time, of equal times the highest alone; what comes late in a later batch counts then.
    """

    def rises(f: pd.DataFrame, peak: float) -> pd.DataFrame:
        f = f.sort_values(["time", "precip_rate"], ascending=[True, False])
        before = f["precip_rate"].cummax().shift().fillna(peak).clip(lower=peak)
        return f[f["precip_rate"] > before]

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        peak = state.get[0] if state.exists else -1.0
        # a rise of the whole batch is one of its own frame, too
        found = rises(pd.concat([rises(f, peak) for f in frames]), peak)
        state.update((float(max(peak, found["precip_rate"].max())) if len(found) else peak,))
        if len(found):
            yield pd.DataFrame({"cell_id": key[0], "time": found["time"].to_numpy(), "peak": found["precip_rate"].to_numpy(float)})

    d = _waiting(df.filter(usable(F.col("precip_rate"))), late).select("cell_id", "time", "precip_rate")
    return d.groupBy("cell_id").applyInPandasWithState(step, "cell_id bigint, time timestamp, peak double", "peak double", "append", GroupStateTimeout.NoTimeout)


def store_by_day(df: DataFrame, path: str, checkpoint: str, keys: list[str]):
    """Starts the stream that upserts new readings into day folders, batch by batch; a repeated batch changes nothing."""
    sink = lambda batch, _: upsert_days(batch, path, "time", keys)
    return df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
