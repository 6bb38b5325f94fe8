"""Joins by time, by sets and by nearness in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.times import floor_to, micros
from freshet.operators.series import fill_forward
from freshet.session import cut

HOUR = 3600 * 1_000_000


def interval_set_match(reports: DataFrame, episodes: DataFrame, before_h: int = 3, after_h: int = 6, pad: float = 0.25) -> DataFrame:
    """(report_id, episode_id): reports(report_id, t, county, lat, lon) in the time window of episodes(episode_id, t0, t1, counties, box).

    A report belongs where t0 - before_h <= t <= t1 + after_h and its county is one of the episode's; without a county ('' or null) where it
    lies in the episode's box(min_lat, min_lon, max_lat, max_lon) padded by pad degrees. Both cases are equality joins, on county and
    day or on day and degree of latitude, so no report meets all episodes.
    """
    day = lambda c: F.floor(c / (24 * HOUR))
    e = episodes.withColumn("_a", micros(F.col("t0")) - before_h * HOUR).withColumn("_b", micros(F.col("t1")) + after_h * HOUR)
    e = e.withColumn("_day", F.explode(F.sequence(day(F.col("_a")), day(F.col("_b")))))
    r = reports.select("report_id", micros(F.col("t")).alias("_t"), F.nullif("county", F.lit("")).alias("_county"), "lat", "lon").withColumn("_day", day(F.col("_t")))
    inside = F.col("_t").between(F.col("_a"), F.col("_b"))
    by_county = e.select("episode_id", "_a", "_b", "_day", F.explode(F.array_distinct("counties")).alias("_county")).join(r.filter("_county IS NOT NULL"), ["_day", "_county"]).filter(inside)
    box = e.select("episode_id", "_a", "_b", "_day", "box", F.explode(F.sequence(F.floor(F.col("box.min_lat") - pad), F.floor(F.col("box.max_lat") + pad))).alias("_deg"))
    near = F.col("lat").between(F.col("box.min_lat") - pad, F.col("box.max_lat") + pad) & F.col("lon").between(F.col("box.min_lon") - pad, F.col("box.max_lon") + pad)
    by_box = r.filter("_county IS NULL").withColumn("_deg", F.floor("lat")).join(box, ["_day", "_deg"]).filter(inside & near)
    return by_county.select("report_id", "episode_id").unionByName(by_box.select("report_id", "episode_id")).distinct()


def nearest_in_time(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, tolerance_s: int, right_cols: list[str], prefer: str | None = None) -> DataFrame:
    """left with the columns of the row of right (same key) nearest in time within the tolerance; the earlier one of ties. Else nulls.

    prefer: a number in right; rows with the least one come first, however near the others are.

    Buckets as wide as the tolerance make it an equality join on key and bucket.
    """
    tol = tolerance_s * 1_000_000
    le = cut(left.withColumn("_t", micros(F.col(left_time))).withColumn("_row", F.monotonically_increasing_id()))  # the numbers stay as written
    ri = right.select(F.col(key).alias("_key"), micros(F.col(right_time)).alias("_u"), F.struct(*right_cols).alias("_r"), (F.col(prefer) if prefer else F.lit(0)).alias("_p"))
    ri = ri.withColumn("_k", F.floor(F.col("_u") / F.lit(tol)))
    probe = le.select("_row", F.col(key).alias("_key"), "_t", F.explode(F.sequence(F.floor((F.col("_t") - tol) / F.lit(tol)), F.floor((F.col("_t") + tol) / F.lit(tol)))).alias("_k"))
    hit = probe.join(ri, ["_key", "_k"]).filter(F.abs(F.col("_t") - F.col("_u")) <= tol)
    best = hit.groupBy("_row").agg(F.min_by("_r", F.struct(F.col("_p"), F.abs(F.col("_t") - F.col("_u")).alias("d"), F.col("_u"), F.col("_r"))).alias("_r"))
    return le.join(best, "_row", "left").select(*left.columns, *[F.col(f"_r.{c}").alias(f"nearest_{c}") for c in right_cols])


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str, out: str) -> DataFrame:
    """left with the latest value of right (same key) at or before its time: both are merged in order, and the last value is carried on."""
    a = left.select("*", F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    b = right.select(key, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v"))
    both = a.unionByName(b, allowMissingColumns=True)
    return fill_forward(both, key, ["_t", "_side", "_v"], "_v", out).filter("_side = 1").select(*left.columns, out)


def hours_touched(df: DataFrame, begin: str, end: str, before_h: int, after_h: int, out: str = "hour") -> DataFrame:
    """A row for each full hour from begin - before_h to end + after_h."""
    a, b = floor_to(F.col(begin), 3600), floor_to(F.col(end), 3600)
    return df.withColumn(out, F.explode(F.sequence(a - F.expr(f"INTERVAL '{before_h}' HOUR"), b + F.expr(f"INTERVAL '{after_h}' HOUR"), F.expr("INTERVAL '1' HOUR"))))
