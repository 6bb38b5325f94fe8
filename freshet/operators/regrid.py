"""Irregular readings onto a regular grid.

A cumulative counter is differenced between consecutive readings, a reading below the one before being a reset (the counter
began again at zero). A rate stands for the counter it drives: its increment is the rate times the time since the
reading before. Each increment is spread over the grid cells between the two readings in proportion to the overlap. Grid cells
without a usable reading are marked: 'filled' where increments reach over them, else 'empty'.

Sources are cut into blocks of time with a halo as long as the longest bridged gap, so that one source with most of the rows
is many tasks, and readings are summed per grid cell before they meet the windows that ask for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.times import from_micros, micros, with_halo

STEP = 15 * 60 * 1_000_000
MAX_GAP = 60 * 60 * 1_000_000
BLOCK = 6 * 3600 * 1_000_000


def usable(value: Column) -> Column:
    """Finite and not negative: marks such as null, NaN, -1 and -3 are no readings."""
    v = value.cast("double")
    return v.isNotNull() & ~F.isnan(v) & (v >= 0) & (v < float("inf"))


def regrid(
    readings: DataFrame,
    windows: DataFrame,
    source: str,
    time: str,
    value: str,
    window_key: str,
    start: str,
    end: str,
    counter: bool = False,
    unit_seconds: float = 3600.0,
    step: int = STEP,
    max_gap: int = MAX_GAP,
    block: int = BLOCK,
) -> DataFrame:
    """(window_key, step, step_start, n_readings, amount, covered, status), one row for each step of each window.

    Step k covers [start + k * step, start + (k + 1) * step). counter: the values are a running total, else rates per
    unit_seconds. amount: what fell into the step; covered: the share of the step between readings at most max_gap apart;
    status: 'observed' (n_readings > 0), 'filled' (amount from increments that reach over it) or 'empty' (amount null).
    step, max_gap and block are in microseconds.

    The defined cases: readings with null source, null time or an unusable value are left out; of readings at one time all
    count as readings, the later ones adding no time; repeated windows count once; windows with a null bound or source, or that
    end before one step is over, have no rows; a window without readings has only empty steps; the
    windows of one source may overlap and start at any time. Columns but those named are ignored.
    """
    w = windows.select(F.col(window_key).alias("_w"), F.col(source).alias("_s"), micros(F.col(start)).alias("_a"), micros(F.col(end)).alias("_b")).distinct()
    w = w.filter(F.col("_s").isNotNull() & F.col("_a").isNotNull() & (F.col("_b") >= F.col("_a") + step)).withColumn("_phase", F.pmod(F.col("_a"), F.lit(step)))
    # blocks of a source that some window looks at, by the offset of its steps
    asked = w.select("_s", "_phase", F.explode(F.expr(f"sequence((_a - {max_gap}) div {block}, (_b + {max_gap}) div {block})")).alias("_block")).distinct()

    r = readings.select(F.col(source).alias("_s"), micros(F.col(time)).alias("_t"), F.col(value).cast("double").alias("_v"))
    r = r.filter(F.col("_s").isNotNull() & F.col("_t").isNotNull() & usable(F.col("_v")))
    r = r.withColumn("_block", with_halo(F.col("_t"), block, before=max_gap))
    r = r.join(asked, ["_s", "_block"])
    by = Window.partitionBy("_s", "_block", "_phase").orderBy("_t", "_v")
    r = r.withColumn("_t0", F.lag("_t").over(by)).withColumn("_v0", F.lag("_v").over(by)).filter(F.floor(F.col("_t") / F.lit(block)) == F.col("_block"))
    gap = F.col("_t") - F.col("_t0")
    r = r.withColumn("_t0", F.when(gap <= max_gap, F.col("_t0")))  # beyond it nothing is known of the time between
    if counter:
        grown = F.when(F.col("_v") >= F.col("_v0"), F.col("_v") - F.col("_v0")).otherwise(F.col("_v"))
        density = F.when(gap > 0, grown / gap)
    else:
        density = F.col("_v") / (unit_seconds * 1e6)
    r = r.withColumn("_q", F.when(F.col("_t0").isNotNull(), density))
    first, own = F.floor((F.coalesce("_t0", "_t") - F.col("_phase")) / F.lit(step)), F.floor((F.col("_t") - F.col("_phase")) / F.lit(step))
    r = r.withColumn("_own", own).withColumn("_bin", F.explode(F.sequence(first, own)))
    lo = F.greatest(F.col("_t0"), F.col("_bin") * step + F.col("_phase"))
    hi = F.least(F.col("_t"), (F.col("_bin") + 1) * step + F.col("_phase"))
    over = F.when(F.col("_t0").isNotNull(), F.greatest(hi - lo, F.lit(0)))
    grid = r.groupBy("_s", "_phase", "_bin").agg(
        F.sum((F.col("_bin") == F.col("_own")).cast("bigint")).alias("n"), F.sum(over * F.col("_q")).alias("amount"), (F.sum(over) / step).alias("covered")
    )

    steps = w.withColumn("_k", F.explode(F.expr(f"sequence(0L, (_b - _a) div {step} - 1)"))).withColumn("_bin", F.floor((F.col("_a") - F.col("_phase")) / F.lit(step)) + F.col("_k"))
    out = steps.join(grid, ["_s", "_phase", "_bin"], "left")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return out.select(
        F.col("_w").alias(window_key),
        F.col("_k").alias("step"),
        from_micros(F.col("_a") + F.col("_k") * step).alias("step_start"),
        n.alias("n_readings"),
        "amount",
        F.coalesce("covered", F.lit(0.0)).alias("covered"),
        F.when(n > 0, "observed").when(F.col("covered") > 0, "filled").otherwise("empty").alias("status"),
    )
