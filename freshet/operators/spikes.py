"""Implausible readings: impossible values, jumps and stuck sensors, judged by what the same source normally shows.

What is normal comes from quantile sketches (KLL) of each source and part of the day; Spark merges them across partitions, and
those of a source are merged again to one for the parts of the day with few readings. Quartiles of the sketches give fences. Changes
and stretches without change need so many neighbours in order of time: sources are cut into blocks of time, each of which judges its
inner readings; those near an end of a block, by number and not by time, are judged once more in a small table of the ends of
all blocks, where their neighbours stand next to them, however far away. So a source with most of the rows is many tasks, and no result
depends on where a block ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.times import micros
from freshet.session import cut

HOUR = 3600 * 1_000_000
DAY = 24 * HOUR


@dataclass(frozen=True)
class Rules:
    """What is implausible for a kind of reading.

    missing: values that mark "no reading". lowest, highest: physical limits, both allowed.
    In fences, q1 and q3 are the quartiles of the source's positive readings, in logarithms if log_fence.
    Level readings (log_fence): beyond q1 - w or q3 + w with w = fence * (q3 - q1), and at least width.
    Others: above q3 + fence * (q3 - q1) and a sudden change, that is one to three readings at least jump[0] times as high as those
    before and after them plus noise; jump[1] times is enough at `far` times the fence. A sudden drop is the same upside down.
    still: so many consecutive readings that stay within min(still_abs, still_rel * value) are no weather, but zeros are.
    min_bucket: readings that a part of the day needs to be judged by itself; min_source: that a source needs to have fences.
    block: microseconds.
    """

    missing: tuple[float, ...] = ()
    lowest: float = 0.0
    highest: float = float("inf")
    log_fence: bool = False
    fence: float = 3.0
    width: float = 0.0
    jump: tuple[float, float] = (6.0, 3.0)
    far: float = 5.0
    noise: float = 0.5
    still: int = 10
    still_abs: float = 0.025
    still_rel: float = 0.03
    hours: int = 6
    min_bucket: int = 200
    min_source: int = 8
    sketch_k: int = 400
    block: int = 30 * DAY

    @property
    def reach(self) -> int:
        """Readings to each side that the judgement of one depends on."""
        return (0 if self.log_fence else 6) + 2 * (self.still - 1)


#: Rain rates in mm/h, every few seconds to minutes.
RAIN_RATE = Rules(missing=(-1.0, -3.0), highest=1000.0)
#: Flood peaks in cubic feet a second, one an event. A real flood may be several times the usual peak: the width is a factor of 12.
FLOOD_PEAK = Rules(missing=(-999999.0,), highest=9_000_000.0, log_fence=True, fence=3.0, width=2.5, still=4, still_abs=1e-6, still_rel=1e-9, min_bucket=40, block=20 * 365 * DAY)


def fences(readings: DataFrame, rules: Rules) -> DataFrame:
    """(_s, _h, q1, q3) for readings (_s, _t, _v): each source and part of the day, _h null for the source as a whole."""
    pos = readings.filter((F.col("_v") > 0) & F.col("_v").between(rules.lowest, rules.highest)).select("_s", _bucket(F.col("_t"), rules).alias("_h"), (F.log("_v") if rules.log_fence else F.col("_v")).alias("x"))
    part = pos.groupBy("_s", "_h").agg(F.kll_sketch_agg_double("x", F.lit(rules.sketch_k)).alias("k"))
    whole = part.groupBy("_s").agg(F.kll_merge_agg_double("k").alias("k")).withColumn("_h", F.lit(None).cast("bigint"))
    both = part.filter(F.kll_sketch_get_n_double("k") >= rules.min_bucket).unionByName(whole.filter(F.kll_sketch_get_n_double("k") >= rules.min_source))
    q = F.kll_sketch_get_quantile_double("k", F.array(F.lit(0.25), F.lit(0.75)))
    return both.withColumn("q", q).select("_s", "_h", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))


def _bucket(t: Column, rules: Rules) -> Column:
    return F.floor(F.pmod(t, F.lit(DAY)) / F.lit(rules.hours * HOUR))


def _sudden(w, rules: Rules, up: bool) -> Column:
    """How many times one to three readings, this one among them, exceed (or fall below) those on both sides."""
    v = {k: F.lag("_ok", -k).over(w) if k else F.col("_ok") for k in range(-3, 4)}
    scores = []
    for m in (1, 2, 3):
        for first in range(1 - m, 1):
            run = [v[k] for k in range(first, first + m)]
            sides = [v[first - 1], v[first + m]]
            whole = run[0].isNotNull()
            for x in run[1:]:
                whole &= x.isNotNull()
            if up:
                low = F.least(*run) if m > 1 else run[0]
                side = F.greatest(*sides)
                scores.append(F.when(whole, low / (side + rules.noise)))
            else:
                high = F.greatest(*run) if m > 1 else run[0]
                side = F.when(sides[0].isNotNull() & sides[1].isNotNull(), F.least(*sides))
                scores.append(F.when(whole, side / (high + rules.noise)))
    return F.coalesce(F.greatest(*scores), F.lit(0.0))


def _judged(b: DataFrame, w, rules: Rules, possible: Column) -> DataFrame:
    """b with _up and _down, how sudden the reading's change is, and _stuck, in the order of the window w."""
    b = b.withColumn("_ok", F.when(possible, F.col("_v")))
    b = b.withColumn("_up", F.lit(0.0) if rules.log_fence else _sudden(w, rules, True))
    b = b.withColumn("_ok", F.when(F.col("_up") <= rules.jump[1], F.col("_ok")))  # the next round looks at what is left
    b = b.withColumn("_down", F.lit(0.0) if rules.log_fence else _sudden(w, rules, False))
    n = rules.still
    back = w.rowsBetween(1 - n, 0)
    spread = F.max("_ok").over(back) - F.min("_ok").over(back)
    calm = (F.count("_ok").over(back) >= n - (n > 6)) & (F.min("_ok").over(back) > 0)
    calm &= spread <= F.least(F.lit(rules.still_abs), F.max("_ok").over(back) * rules.still_rel) + 1e-9
    b = b.withColumn("_calm", calm.cast("int"))
    return b.withColumn("_stuck", F.col("_ok").isNotNull() & (F.max("_calm").over(w.rowsBetween(0, n - 1)) == 1))


def implausible(df: DataFrame, id: str, source: str, time: str, value: str, rules: Rules) -> DataFrame:
    """(row_id, reason) of the implausible rows, each once; reason is 'impossible', 'fence', 'jump' or 'stuck' (the first that holds).

    The defined cases: null, NaN and the missing marks are no readings and are neither flagged nor neighbours; rows without source or
    time are only held against the physical limits; null ids are not reported; repeated deliveries (same source, time and value) are one
    reading for all rules, and each of their ids is reported; readings at one time are ordered by value; sources with few
    readings have no fences; an empty table gives no rows. Columns but those named are ignored.
    """
    r = df.select(F.col(id).alias("_id"), F.col(source).alias("_s"), micros(F.col(time)).alias("_t"), F.col(value).cast("double").alias("_v"))
    r = r.filter(F.col("_v").isNotNull() & ~F.isnan("_v") & ~F.col("_v").isin(*rules.missing)) if rules.missing else r.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    possible = F.col("_v").between(rules.lowest, rules.highest) & (F.col("_v") < float("inf"))
    placed = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    lost = r.filter(~placed & ~possible).select(F.col("_id").alias("row_id"), F.lit("impossible").alias("reason"))
    r = r.filter(placed)

    # one shuffle by source and block serves the merging of repeats, the windows of blocks, and the table of their ends
    b = r.withColumn("_block", F.floor(F.col("_t") / F.lit(rules.block))).repartition("_s", "_block")
    b = b.groupBy("_s", "_block", "_t", "_v").agg(F.min("_id").alias("_id"), F.count("*").alias("_n"))
    own = Window.partitionBy("_s", "_block").orderBy("_t", "_v")
    place, many = F.row_number().over(own), F.count("*").over(Window.partitionBy("_s", "_block"))
    b = b.withColumn("_end", F.least(place - 1, many - place))  # readings between this one and the nearer end
    inner = _judged(b, own, rules, possible).filter(F.col("_end") >= rules.reach)
    outer = _judged(b.filter(F.col("_end") < 2 * rules.reach), Window.partitionBy("_s").orderBy("_t", "_v"), rules, possible).filter(F.col("_end") < rules.reach)
    b = inner.unionByName(outer)
    least = rules.jump[1]

    if not rules.log_fence:  # only these rows are held against the fences
        b = b.filter(~possible | F.col("_stuck") | (F.col("_up") > least) | (F.col("_down") > least))
    f = cut(fences(r, rules))  # a few rows a source: merged once, and joined by their true size
    part, whole = f.filter("_h IS NOT NULL").select("_s", "_h", F.struct("q1", "q3").alias("fp")), f.filter("_h IS NULL").select("_s", F.struct("q1", "q3").alias("fw"))
    b = b.withColumn("_h", _bucket(F.col("_t"), rules)).join(part, ["_s", "_h"], "left").join(whole, "_s", "left").withColumn("f", F.coalesce("fp", "fw"))
    iqr = F.col("f.q3") - F.col("f.q1")
    if rules.log_fence:
        x = F.log(F.greatest(F.col("_v"), F.lit(1e-12)))
        wide = F.greatest(iqr * rules.fence, F.lit(rules.width))
        out, jump = (x > F.col("f.q3") + wide) | (x < F.col("f.q1") - wide), F.lit(False)
    else:
        fence = F.col("f.q3") + rules.fence * iqr
        out = F.lit(False)
        hi, lo = rules.jump
        jump = ((F.col("_up") > hi) & (F.col("_v") > fence)) | ((F.col("_up") > lo) & (F.col("_v") > rules.far * fence))
        jump |= (F.col("_down") > hi) & ((F.col("_v") + rules.noise) * F.col("_down") > fence)
    reason = F.when(~possible, "impossible").when(out, "fence").when(jump, "jump").when(F.col("_stuck"), "stuck")
    found = cut(b.withColumn("reason", reason).filter("reason IS NOT NULL").select("_s", "_t", "_v", "_id", "_n", "reason"))  # read twice
    # what was delivered several times is one reading up to here; its deliveries are looked up by its source, time and value
    again = r.join(found.filter("_n > 1").select("_s", "_t", "_v", "reason"), ["_s", "_t", "_v"]).select(F.col("_id").alias("row_id"), "reason")
    found = found.filter("_n = 1").select(F.col("_id").alias("row_id"), "reason").unionByName(again)
    rank = F.min(F.struct(F.array_position(F.array(*map(F.lit, ("impossible", "fence", "jump", "stuck"))), F.col("reason")).alias("k"), "reason")).alias("m")
    return found.unionByName(lost).filter("row_id IS NOT NULL").groupBy("row_id").agg(rank).select("row_id", F.col("m.reason").alias("reason"))
