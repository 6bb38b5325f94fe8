"""Statistics of grid values over areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(value: Column) -> Column:
    """Finite, not negative values; anything else is null."""
    v = value.cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v) & (v >= 0) & (v < float("inf")), v)


def area_mean(df: DataFrame, by: list[str], value: Column, weight: Column) -> DataFrame:
    """Mean over the weight of the cells with a value (renormalised each time), null without any."""
    d = df.select(*by, value.alias("_v"), weight.alias("_w"))
    return d.groupBy(*by).agg(F.expr("try_divide(sum(_w * _v), nullif(sum(if(_v IS NOT NULL, _w, 0)), 0))").alias("mean"))


def coverage(df: DataFrame, by: list[str], value: Column, weight: Column, thresholds: tuple[float, ...]) -> DataFrame:
    """mean and max over valid cells, and cov: the shares of the whole weight, cells without a value included, that reach each threshold."""
    d = df.select(*by, value.alias("_v"), weight.alias("_w"))
    reach = [F.expr(f"try_divide(sum(if(_v >= {t}, _w, 0)), sum(_w))") for t in thresholds]
    return d.groupBy(*by).agg(F.expr("try_divide(sum(_w * _v), nullif(sum(if(_v IS NOT NULL, _w, 0)), 0))").alias("mean"), F.max("_v").alias("max"), F.array(*reach).alias("cov"))


def zonal(df: DataFrame, by: list[str], value: Column, weight: Column, threshold: float) -> DataFrame:
    """mean, min, max, the share of valid weight at or above the threshold, and the valid share of all weight."""
    d = df.select(*by, value.alias("_v"), weight.alias("_w"))
    valid = "nullif(sum(if(_v IS NOT NULL, _w, 0)), 0)"
    return d.groupBy(*by).agg(
        F.expr(f"try_divide(sum(_w * _v), {valid})").alias("mean"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        F.expr(f"try_divide(sum(if(_v >= {threshold}, _w, 0)), {valid})").alias("share"), F.expr(f"try_divide({valid}, sum(_w))").alias("valid"),
    )


def hot_cells(df: DataFrame, by: list[str], value: str, limits: tuple[tuple[float, int], ...] = ((100.0, 4), (150.0, 3))) -> DataFrame:
    """Groups (cells) with values above one of the limits in at least so many rows: stuck or spurious cells."""
    hits = [F.count_if(F.col(value) > v) >= n for v, n in limits]
    keep = hits[0]
    for h in hits[1:]:
        keep |= h
    return df.groupBy(*by).agg(keep.alias("_hot")).filter("_hot").select(*by)
