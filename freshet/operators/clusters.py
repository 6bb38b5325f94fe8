"""Reports that belong together: links by time and distance, and their connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.times import micros
from freshet.operators.nearby import haversine_km
from freshet.operators.series import running_total
from freshet.session import cut


def report_links(df: DataFrame, group: str, id: str, time: str, lat: str, lon: str, gap_hours: float, km: float) -> DataFrame:
    """(a, b): pairs of reports of one group at most gap_hours and km apart.

    Each report is looked up in its own bucket of time and latitude and the next ones, so that only near reports meet, and reports at one
    place and time are one node, linked by their common key.
    """
    deg = km / 111.0
    n = gap_hours * 3600 * 1e6
    p = df.select(F.col(group).alias("g"), F.col(id).alias("id"), micros(F.col(time)).alias("t"), F.col(lat).alias("y"), F.col(lon).alias("x")).dropna()
    p = p.groupBy("g", "t", "y", "x").agg(F.min("id").alias("id"))
    b = p.withColumn("bt", F.floor(F.col("t") / n)).withColumn("by", F.floor(F.col("y") / deg))
    near = F.explode(F.expr("flatten(transform(array(-1, 0, 1), i -> transform(array(-1, 0, 1), j -> struct(bt + i AS bt, by + j AS by))))"))
    a = b.select("g", F.col("id").alias("a"), F.col("t").alias("ta"), F.col("y").alias("ya"), F.col("x").alias("xa"), near.alias("q")).select("g", "a", "ta", "ya", "xa", "q.bt", "q.by")
    j = a.join(b, ["g", "bt", "by"]).filter("a < id").filter(F.abs(F.col("ta") - F.col("t")) <= n)
    return j.filter(haversine_km(F.col("ya"), F.col("xa"), F.col("y"), F.col("x")) <= km).select("a", F.col("id").alias("b"))


def circle_links(df: DataFrame, group: str, id: str, time: str, lat: str, lon: str, radius: str, gap_hours: float, buffer_km: float, most_degrees: float = 0.6) -> DataFrame:
    """(a, b): pairs of reports of one group whose times are at most gap_hours and whose latitudes at most most_degrees apart, and whose circles, each wider by buffer_km, touch.

    Only reports of the same or neighbouring buckets of time, latitude and longitude meet; a bucket of longitude is as wide as the two widest circles
    at 72 degrees of latitude, nearer to the poles there is one bucket. Rows with a null in any of the columns link to nothing.
    """
    n = gap_hours * 3600 * 1e6
    p = df.select(F.col(group).alias("g"), F.col(id).alias("id"), micros(F.col(time)).alias("t"), F.col(lat).alias("y"), F.col(lon).alias("x"), F.col(radius).cast("double").alias("r")).dropna()
    widest = 2 * ((p.agg(F.max("r")).first()[0] or 0.0) + buffer_km)
    deg = max(widest, 1.0) / (111.0 * 0.3)
    b = p.withColumns({"bt": F.floor(F.col("t") / n), "by": F.floor(F.col("y") / most_degrees), "bx": F.when(F.abs("y") < 72, F.floor(F.col("x") / deg))})
    next_ = lambda c: F.explode(F.array(*[F.col(c) + k for k in (-1, 0, 1)]))
    a = b.select("g", F.col("id").alias("a"), F.col("t").alias("ta"), F.col("y").alias("ya"), F.col("x").alias("xa"), F.col("r").alias("ra"), next_("bt").alias("bt"), "by", "bx")
    a = a.withColumn("by", next_("by")).withColumn("bx", F.explode(F.expr("if(bx IS NULL, array(CAST(NULL AS BIGINT)), array(bx - 1, bx, bx + 1, NULL))")))
    same = (F.abs(F.col("ta") - F.col("t")) <= n) & (F.abs(F.col("ya") - F.col("y")) <= most_degrees) & (haversine_km(F.col("ya"), F.col("xa"), F.col("y"), F.col("x")) <= F.col("ra") + F.col("r") + 2 * buffer_km)
    none = F.lit(1 << 40)
    j = a.withColumn("bx", F.coalesce("bx", none)).join(b.withColumn("bx", F.coalesce("bx", none)), ["g", "bt", "by", "bx"]).filter("a <> id").filter(same)
    return j.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component): the least id that can be reached over links(a, b).

    Large-star and small-star rounds: every node links its neighbours to the least of them, until nothing changes. The rounds grow with the logarithm
    of the longest chain; each is one pre-aggregated shuffle, kept in the shared folder.
    """
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u <> v").distinct()
        low2 = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low2, "u").select("u", "v", "m")
        new = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct()
        new = cut(new.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), edges)
        mark = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        edges = new
        if mark == last:
            break
        last = mark
    at = edges.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.select(F.col("id")).distinct().join(at, F.col("id") == F.col("u"), "left").select("id", F.coalesce("v", "id").alias("component"))


def numbered(df: DataFrame, group: str, component: str, time: str, id: str) -> DataFrame:
    """(component, cluster_id): '<group>_<k>', k counting the components of a group in the order of their first report (by time, then id)."""
    first = df.groupBy(F.col(group).alias("_g"), F.col(component).alias("component")).agg(F.min(F.struct(F.col(time).alias("t"), F.col(id).alias("i"))).alias("_first"))
    run = running_total(first, ["_g", "_first"], F.lit(1).cast("bigint"), "_row", "_all")
    low = run.groupBy("_g").agg(F.min("_row").alias("_low"))
    return run.join(low, "_g").select("component", F.concat_ws("_", F.col("_g").cast("string"), (F.col("_row") - F.col("_low") + 1).cast("string")).alias("cluster_id"))
