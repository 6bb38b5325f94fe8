"""Rain of storms over footprints of cells: per cell, per unit and hour by hour, without cells that are stuck high."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.series import rolling_sums

#: Trailing sums over so many hours.
ROLL = (1, 3, 6)
#: A cell is stuck high if it is above one of these amounts in at least so many of the hours read.
HOT = ((100.0, 4), (150.0, 3))


def cell_rain(hours: DataFrame) -> DataFrame:
    """(storm, cell, unit, w, m1, h1, m3, h3, m6, h6, ep, pre, hot), a row for each cell of each storm.

    hours: storm, cell, unit, w, t0, hour, v: every hour of a storm for every cell of its footprint, those before t0 to look back, v null
    where nothing was measured. m and h: the highest trailing sum of the hours from t0 on and the first hour that has it, missing hours being 0;
    ep and pre: the sums from t0 on and before; hot: above HOT in any hours, those before t0 too.
    """
    d = rolling_sums(hours, ["storm", "cell"], "hour", "v", ROLL)
    in_ = F.col("hour") >= F.col("t0")
    best = [F.min_by(F.struct(F.col(f"s{k}").alias("m"), F.col("hour").alias("h")), F.when(in_, F.struct(-F.col(f"s{k}"), F.col("hour")))).alias(f"b{k}") for k in ROLL]
    v = F.coalesce("v", F.lit(0.0))
    hot = [F.count_if(F.col("v") > mm) >= n for mm, n in HOT]
    g = d.groupBy("storm", "cell", "unit", "w").agg(*best, F.sum(F.when(in_, v).otherwise(0.0)).alias("ep"), F.sum(F.when(in_, 0.0).otherwise(v)).alias("pre"), (hot[0] | hot[1]).alias("hot"))
    return g.select("storm", "cell", "unit", "w", *[F.col(f"b{k}.{c}").alias(f"{c}{k}") for k in ROLL for c in "mh"], "ep", "pre", "hot")


def footprint_rain(cells: DataFrame, by: list[str]) -> DataFrame:
    """(*by, km2, n_hot, and max and mean of ep, pre, m1, m3, m6, with t1, t3, t6, the hours of the highest sums), of cell_rain.

    Means weigh the cells by w; hot cells count for the area alone. Of cells with the same highest sum the one of the least number tells the hour.
    """
    aggs = [(F.sum("w") * (111.32 * 0.01) ** 2).alias("km2"), F.count_if("hot").alias("n_hot")]
    ok = ~F.col("hot")
    for c in ("ep", "pre", *[f"m{k}" for k in ROLL]):
        v, w = F.when(ok, F.col(c)), F.when(ok, F.col("w"))
        aggs += [F.max(v).alias(f"{c}_max"), F.try_divide(F.sum(v * w), F.sum(w)).alias(f"{c}_mean")]
    for k in ROLL:
        aggs.append(F.min_by(f"h{k}", F.when(ok, F.struct(-F.col(f"m{k}"), F.col("cell")))).alias(f"t{k}"))
    return cells.groupBy(*by).agg(*aggs)


def hourly_rain(hours: DataFrame, cells: DataFrame) -> DataFrame:
    """(storm, hour, mean, top) over the footprint, from t0 on: the plain mean and the maximum of what was measured.

    Hot cells are taken out of an hour where they are above the lower amount of HOT: what they hold is taken from the mean times the
    number of all cells of the footprint, and that number is lowered by them.
    """
    d = hours.filter("hour >= t0").join(cells.select("storm", "cell", "hot"), ["storm", "cell"])
    bad = F.col("hot") & (F.col("v") > HOT[0][0])
    g = d.groupBy("storm", "hour").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.sum(F.when(bad, F.col("v"))).alias("off"), F.count_if(bad).alias("k"), F.max(F.when(bad, None).otherwise(F.col("v"))).alias("top"))
    mean = F.when(F.col("k") > 0, (F.col("mean") * F.col("n") - F.col("off")) / F.greatest(F.col("n") - F.col("k"), F.lit(1))).otherwise(F.col("mean"))
    return g.select("storm", "hour", mean.alias("mean"), "top")
