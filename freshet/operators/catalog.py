"""Filtering, ranking and summarising a catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.operators.series import running_total


def at_least(criteria: dict[str, float]) -> Column:
    """All columns at their minimum or above. A minimum over 0 leaves out nulls, one of 0 asks nothing."""
    active = [F.coalesce(F.col(c) >= v, F.lit(False)) for c, v in criteria.items() if v > 0]
    return reduce(lambda a, b: a & b, active, F.lit(True))


def top(df: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The k highest rows, nulls last (as -1), ties in the order of `tie`; with rank from 1. The feature is a report of k rows."""
    best = df.orderBy(F.coalesce(F.col(by), F.lit(-1)).desc(), tie).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.coalesce(F.col(by), F.lit(-1)).desc(), tie)).cast("bigint"))


def funnel(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """(stage, name, n): rows left after each filter and those before it, in one pass."""
    ok, sums = F.lit(True), []
    for i, (_, c) in enumerate(stages):
        ok = ok & F.coalesce(c, F.lit(False))
        sums.append(F.count_if(ok).alias(f"_{i}"))
    rows = ", ".join(f"{i}L, '{name}', _{i}" for i, (name, _) in enumerate(stages))
    return df.agg(*sums).selectExpr(f"stack({len(stages)}, {rows}) AS (stage, name, n)")


def class_breaks(df: DataFrame, value: str, shares: tuple[float, ...]) -> DataFrame:
    """(q, value): the exact value at place floor(q * n), counted from 0, for each share q."""
    n = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))
    run = running_total(n, ["v"], F.col("n"), "lo", "all")
    k = F.least(F.floor(F.col("q") * F.col("all")), F.col("all") - 1)
    return run.withColumn("q", F.explode(F.array(*[F.lit(q) for q in shares]))).filter((k >= F.col("lo")) & (k < F.col("lo") + F.col("n"))).select("q", F.col("v").alias("value"))


# Round numbers that class breaks of counts are raised to.
LADDER = (1, 2, 3, 5, 10, 15, 20, 25, 30, 40, 50, 75, 100, 150, 200, 250, 300, 400, 500, 750, 1000, 1500, 2000, 3000, 5000, 7500, 10000)


def round_count(v: Column) -> Column:
    """The least of LADDER that isn't below v, or v raised to full thousands."""
    return F.coalesce(F.get(F.filter(F.array(*map(F.lit, LADDER)), lambda x: x >= v), F.lit(0)).cast("double"), (F.ceil(v / 1000) * 1000).cast("double"))


def next_count(v: Column) -> Column:
    """The least of LADDER above v, or v + 1000."""
    return F.coalesce(F.get(F.filter(F.array(*map(F.lit, LADDER)), lambda x: x > v), F.lit(0)).cast("double"), v + 1000)


def round_money(v: Column) -> Column:
    """v raised to 1, 2.5, 5 or 10 times a power of ten; 0 for what isn't above zero."""
    k = F.pow(F.lit(10.0), F.floor(F.log10(v)))
    return F.when(v > 0, F.when(v / k <= 1, 1.0).when(v / k <= 2.5, 2.5).when(v / k <= 5, 5.0).otherwise(10.0) * k).otherwise(0.0)


def ladder_breaks(df: DataFrame, value: str, shares: tuple[float, ...], money: bool = False) -> DataFrame:
    """(i, value): class breaks of the values above zero, raised to round numbers and strictly rising; 1, 2, ... without any such value, then rounded alike."""
    raw = class_breaks(df.filter(F.col(value) > 0).select(value), value, shares).agg(F.transform(F.array_sort(F.collect_list(F.struct("q", "value"))), lambda x: x["value"].cast("double")).alias("raw"))  # a value for each share
    raw = raw.select(F.when(F.size("raw") > 0, F.col("raw")).otherwise(F.array(*[F.lit(float(i + 1)) for i in range(len(shares))])).alias("raw"))
    up, more = (round_money, lambda last: round_money(last * 1.5)) if money else (round_count, next_count)
    grown = F.aggregate("raw", F.array().cast("array<double>"), lambda acc, v: F.concat(acc, F.array(F.when(up(v) <= F.try_element_at(acc, F.lit(-1)), more(F.try_element_at(acc, F.lit(-1)))).otherwise(up(v)))))
    return raw.select(F.posexplode(grown).alias("i", "value")).select(F.col("i").cast("bigint").alias("i"), "value")


def slider_amount(place: Column, top: Column) -> Column:
    """The amount at a place (0 to 100) of a slider that is logarithmic from 10,000 to top; 0 asks nothing."""
    return F.when(place <= 0, F.lit(0.0)).otherwise(F.round(F.pow(F.lit(10.0), 4 + place / 100 * (F.log10(top) - 4))))


def open_range(c: Column, low: float, high: float, top: float) -> Column:
    """low <= c <= high, where high = top means no bound. A range that asks nothing also takes nulls, another one doesn't."""
    if low <= 0 and high >= top:
        return F.lit(True)
    ok = c >= low
    return F.coalesce(ok & (c <= high) if high < top else ok, F.lit(False))


def any_of(c: Column, wanted: list[str]) -> Column:
    """Whether a comma-separated text holds one of the wanted names; all do if none is wanted."""
    return F.coalesce(F.arrays_overlap(F.transform(F.split(c, ","), lambda x: F.trim(x)), F.array(*map(F.lit, wanted))), F.lit(False)) if wanted else F.lit(True)


def as_ratio(c: Column, scale: Column) -> Column:
    """Values of records marked 'ratio' as they are; others are percents from before the mark and become ratios."""
    return F.when(scale.eqNullSafe("ratio"), c).otherwise(c / 100)


def permille(c: Column) -> Column:
    """Thousandths as whole numbers, halves to even; null stays null."""
    return F.bround(c * 1000).cast("int")


def contingency(df: DataFrame, forecast: Column, observed: Column) -> DataFrame:
    """hits, misses, false_alarms, pod, far, csi of two booleans; empty denominators count as 1."""
    d = df.select(F.coalesce(forecast, F.lit(False)).alias("f"), F.coalesce(observed, F.lit(False)).alias("o"))
    c = d.agg(F.count_if(F.expr("f AND o")).alias("hits"), F.count_if(F.expr("NOT f AND o")).alias("misses"), F.count_if(F.expr("f AND NOT o")).alias("false_alarms"))
    r = lambda a, b: F.round(a / F.greatest(b, F.lit(1)), 3)
    h, m, f = F.col("hits"), F.col("misses"), F.col("false_alarms")
    return c.select("*", r(h, h + m).alias("pod"), r(f, h + f).alias("far"), r(h, h + m + f).alias("csi"))
