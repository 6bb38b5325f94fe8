"""The expressions as SQL functions of a session: temporary, inlined by the optimizer, without Python in their way."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Name, arguments, result and body of each function.
FUNCTIONS = (
    ("site_id", "s STRING", "STRING", "CASE WHEN length(regexp_replace(trim(s), '[.]0$', '')) >= 8 THEN regexp_replace(trim(s), '[.]0$', '') ELSE lpad(regexp_replace(trim(s), '[.]0$', ''), 8, '0') END"),
    ("water_year", "t TIMESTAMP_NTZ", "BIGINT", "CAST(year(t) + CASE WHEN month(t) >= 10 THEN 1 ELSE 0 END AS BIGINT)"),
    ("haversine_km", "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE", "DOUBLE", "2 * 6371 * asin(sqrt(least(1D, pow(sin(radians(c - a) / 2), 2) + cos(radians(a)) * cos(radians(c)) * pow(sin(radians(d - b) / 2), 2))))"),
    ("cell_at", "lat DOUBLE, lon DOUBLE", "BIGINT", "CASE WHEN lat <= 55 AND lat > 20 AND lon >= -130 AND lon < -60 THEN CAST(floor((55 - lat) / 0.01) * 7000 + floor((lon + 130) / 0.01) AS BIGINT) END"),
    ("zone_hours", "z STRING", "INT", "coalesce(try_cast(regexp_extract(z, '([+-]?[0-9]+)$', 1) AS INT), 0)"),
)


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to spark.sql in this session; gives their names."""
    for name, args, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {result} RETURN {body}")
    return [f[0] for f in FUNCTIONS]
