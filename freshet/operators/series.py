"""Time series by source: resampling, rolling sums, ranks, integrals and sessions.

Sources are cut into blocks of time, so that one with most of the rows is many tasks: sums over a bounded time take a halo of that
length along, and what is carried on without a bound (the last value, the number of sessions) goes over a small table of the blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.times import from_micros, micros, with_halo
from freshet.session import cut

SECOND = 1_000_000
#: Length of a block of time, in microseconds.
BLOCK = 30 * 86_400 * SECOND


def resample(df: DataFrame, source: str, time: str, seconds: int, aggs: dict[str, Column], dense: bool = True) -> DataFrame:
    """(source, step_start, *aggs): bins [start, start + seconds) from each source's first to its last, empty ones included if dense.

    The readings are summed up to bins before the bins are laid out, so dense bins cost one row each, not a join of readings.
    """
    n = seconds * SECOND
    b = df.filter(F.col(time).isNotNull()).groupBy(source, F.floor(micros(F.col(time)) / F.lit(n)).alias("_bin")).agg(*[c.alias(k) for k, c in aggs.items()])
    if dense:
        ends = b.groupBy(source).agg(F.min("_bin").alias("a"), F.max("_bin").alias("z"))
        b = ends.select(source, F.explode(F.sequence("a", "z")).alias("_bin")).join(b, [source, "_bin"], "left")
    return b.select(source, from_micros(F.col("_bin") * n).alias("step_start"), *aggs)


def _names(x: str | list[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _block(time: str, block: int) -> Column:
    return F.floor(micros(F.col(time)) / F.lit(block))


def fill_forward(df: DataFrame, source: str | list[str], order: str | list[str], value: str, out: str, block: int = BLOCK) -> DataFrame:
    """out: the last value that isn't null, up to and with this row; order begins with a time, rows without one come first."""
    by, order = _names(source), _names(order)
    d = df.withColumn("_b", F.coalesce(_block(order[0], block), F.lit(-(1 << 60))))
    ends = d.filter(F.col(value).isNotNull()).groupBy(*by, "_b").agg(F.max(F.struct(*order, F.col(value).alias("_value"))).alias("_e"))
    blocks = d.select(*by, "_b").distinct().join(ends, [*by, "_b"], "left")
    carry = blocks.select(*by, "_b", F.last("_e._value", ignorenulls=True).over(Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    w = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("_last", F.last(value, ignorenulls=True).over(w)).join(carry, [*by, "_b"], "left").withColumn(out, F.coalesce("_last", "_carry")).select(*df.columns, out)


def with_previous(df: DataFrame, source: str | list[str], time: str, cols: list[str], block: int = BLOCK) -> DataFrame:
    """df with _prev, the struct of cols of the row before in its source; null for the first. Rows are taken to have distinct times."""
    by, what = _names(source), F.struct(*cols)
    d = df.withColumn("_b", _block(time, block))
    ends = d.groupBy(*by, "_b").agg(F.max_by(what, time).alias("_e")).withColumn("_carry", F.lag("_e").over(Window.partitionBy(*by).orderBy("_b"))).drop("_e")
    d = d.withColumn("_lag", F.lag(what).over(Window.partitionBy(*by, "_b").orderBy(time)))
    return d.join(ends, [*by, "_b"], "left").withColumn("_prev", F.coalesce("_lag", "_carry")).select(*df.columns, "_prev")


def _trailing(df: DataFrame, source: str | list[str], hour: str, hours: int, block: int):
    """Blocks with a halo of so many hours before them, the window over them, and the condition of their own rows."""
    d = df.withColumn("_b", with_halo(micros(F.col(hour)), block, before=(hours - 1) * 3600 * SECOND))
    w = Window.partitionBy(*_names(source), "_b").orderBy(F.floor(micros(F.col(hour)) / F.lit(3600 * SECOND)))
    return d, w, _block(hour, block) == F.col("_b")


def rolling_sums(df: DataFrame, source: str | list[str], hour: str, value: str, hours: tuple[int, ...], block: int = BLOCK) -> DataFrame:
    """Trailing sums s1, s3, ... over so many hours up to each row's hour; missing hours and nulls count as 0. Rows without an hour are left out."""
    d, w, own = _trailing(df, source, hour, max(hours), block)
    sums = {f"s{k}": F.sum(F.coalesce(F.col(value), F.lit(0))).over(w.rangeBetween(-(k - 1), 0)) for k in hours}
    return d.withColumns(sums).filter(own).drop("_b")


def rolling_peak(df: DataFrame, source: str, hour: str, value: str) -> DataFrame:
    """(source, peak, peak_hour): the highest value and the first hour that has it."""
    m = F.min_by(F.struct(F.col(value).alias("v"), F.col(hour).alias("h")), F.struct(-F.col(value), F.col(hour)))
    return df.filter(F.col(value).isNotNull()).groupBy(source).agg(m.alias("m")).select(source, F.col("m.v").alias("peak"), F.col("m.h").alias("peak_hour"))


def rolling_coverage(df: DataFrame, source: str, hour: str, value: str, hours: int, least: float, block: int = BLOCK) -> DataFrame:
    """The trailing sum over so many hours where at least that share of them has a value, else null."""
    d, w, own = _trailing(df, source, hour, hours, block)
    w = w.rangeBetween(-(hours - 1), 0)
    d = d.withColumns({"covered": F.count(value).over(w) / hours, "_t": F.sum(value).over(w)}).filter(own)
    return d.withColumn("total", F.when(F.col("covered") >= least, F.col("_t"))).drop("_b", "_t")


def exceedance(df: DataFrame, source: str, value: str, order: str) -> DataFrame:
    """Flow duration of the values above zero: 100 * rank / (n + 1) with ranks from the highest, ties in the given order.

    Ranks are running numbers over ranges of all rows, so that a source with most of them is many tasks.
    """
    d = df.filter(F.col(value) > 0)
    first = F.struct(F.col(source).alias("s"), (-F.col(value)).alias("v"), F.col(order).alias("o"))
    d = running_total(d.withColumn("_at", first), ["_at"], F.lit(1).cast("bigint"), "_row", "_all")
    n = d.groupBy(source).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    return d.join(n, source).withColumn("exceedance", 100.0 * (F.col("_row") - F.col("_first") + 1) / (F.col("_n") + 1)).drop("_at", "_row", "_all", "_n", "_first")


def value_at_exceedance(df: DataFrame, source: str, value: str, order: str, percent: float) -> DataFrame:
    """(source, q): the value exceeded so many percent of the time, linear between ranks and held at the ends."""
    e = exceedance(df, source, value, order).select(source, F.col("exceedance").alias("e"), F.col(value).alias("v"))
    below, above = F.when(F.col("e") <= percent, F.col("e")), F.when(F.col("e") > percent, F.col("e"))
    g = e.groupBy(source).agg(F.max(below).alias("e1"), F.max_by("v", below).alias("v1"), F.min(above).alias("e2"), F.min_by("v", above).alias("v2"))
    return g.select(source, F.coalesce(F.col("v1") + (F.col("v2") - F.col("v1")) * (percent - F.col("e1")) / (F.col("e2") - F.col("e1")), "v1", "v2").alias("q"))


def hydrograph_metrics(df: DataFrame, group: list[str], time: str, flow: str) -> DataFrame:
    """Per group: volume (trapezoids, cubic feet to acre-feet), flashiness (sum of changes over sum of flows), peak, peak time, hours to it."""
    d = with_previous(df.filter(F.col(flow).isNotNull()).withColumn("_t", micros(F.col(time)) / SECOND), group, time, [flow, "_t"])
    d = d.withColumn("_q0", F.col("_prev")[flow]).withColumn("_t0", F.col("_prev._t"))
    peak = F.min_by(F.struct(F.col(flow).alias("q"), F.col(time).alias("t")), F.struct(-F.col(flow), F.col(time)))
    g = d.groupBy(*group).agg(
        F.count("*").alias("n"),
        (F.coalesce(F.sum((F.col(flow) + F.col("_q0")) / 2 * (F.col("_t") - F.col("_t0"))), F.lit(0.0)) / 43560).alias("volume_acreft"),
        F.expr(f"try_divide(coalesce(sum(abs({flow} - _q0)), 0D), nullif(greatest(sum({flow}), 0D), 0D))").alias("flashiness"),
        peak.alias("_p"),
        F.min("_t").alias("_first"),
    )
    hours = (micros(F.col("_p.t")) / SECOND - F.col("_first")) / 3600
    return g.select(*group, "n", "volume_acreft", "flashiness", F.col("_p.q").alias("peak"), F.col("_p.t").alias("peak_time"), hours.alias("hours_to_peak"))


def sessions(df: DataFrame, source: str, time: str, gap_seconds: int, block: int = BLOCK) -> DataFrame:
    """Adds session (1, 2, ... of each source): a gap longer than gap_seconds begins a new one, a gap as long does not."""
    times_ = df.select(source, time).filter(F.col(time).isNotNull()).distinct()  # rows at one time are in one session
    d = with_previous(times_, source, time, [time], block)
    new = F.coalesce((micros(F.col(time)) - micros(F.col("_prev")[time]) > gap_seconds * SECOND).cast("bigint"), F.lit(1).cast("bigint"))
    d = d.withColumn("_new", new).withColumn("_b", _block(time, block))
    sums = d.groupBy(source, "_b").agg(F.sum("_new").alias("_n"))
    carry = sums.withColumn("_carry", F.sum("_n").over(Window.partitionBy(source).orderBy("_b")) - F.col("_n")).drop("_n")
    run = F.sum("_new").over(Window.partitionBy(source, "_b").orderBy(time))
    d = d.withColumn("_run", run).join(carry, [source, "_b"]).select(source, time, (F.col("_run") + F.col("_carry")).alias("session"))
    return df.join(d, [source, time], "left").select(*df.columns, "session")


def running_total(df: DataFrame, order: list[str], size: Column, total: str, all_: str) -> DataFrame:
    """Adds total, the sum of size over the rows before this one in the whole order, and all_, the sum over all rows.

    No task sees all rows: a range partitioning sorts them, each partition is summed, and the partitions' sums give each its offset.
    """
    s = cut(df.withColumn("_n", size).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    sizes = s.groupBy("_part").agg(F.sum("_n").alias("_k"))
    before = sizes.withColumn("_before", F.sum("_k").over(Window.orderBy("_part")) - F.col("_k")).withColumn(all_, F.sum("_k").over(Window.partitionBy())).drop("_k")  # a row for each partition
    run = F.sum("_n").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return s.join(F.broadcast(before), "_part").withColumn(total, F.col("_before") + run - F.col("_n")).drop("_part", "_n", "_before")


def shard(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Adds shard 0 .. n - 1, contiguous in the order and of equal size to one row: floor(i * n / rows)."""
    s = running_total(df, order, F.lit(1).cast("bigint"), "_row", "_all")
    return s.withColumn("shard", F.floor(F.col("_row") * n / F.col("_all"))).drop("_row", "_all")


def offsets(df: DataFrame, order: str, size: str) -> DataFrame:
    """Adds start and stop: where the elements of each row begin and end when all rows are packed one after the other."""
    return running_total(df, [order], F.col(size), "start", "_all").withColumn("stop", F.col("start") + F.col(size)).drop("_all")
