"""Queries that put the operators together: rain of storms over footprints, reports and gages by unit, catchment series, forcing, clusters of circles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions import geo, text, times
from freshet.operators import catalog, clusters, matching, nearby, series, storms
from freshet.operators.regrid import usable
from freshet.operators.timestamps import to_utc
from freshet.plans.reference import _HOURLY, QUERIES, SQL, _hourly, query, r
from freshet.sources.tables import table

# --- rain of storms --------------------------------------------------------------------------------------------------------

_STORM = f"""{_HOURLY}, c AS (SELECT DISTINCT cell_id, (cell_id // 7000) // 500 * 100 + (cell_id % 7000) // 500 AS zone, (cell_id // 7000) // 250 * 100 + (cell_id % 7000) // 250 AS unit, cos(radians(55 - (cell_id // 7000 + 0.5) * 0.01)) AS w FROM h),
s AS (SELECT DISTINCT storm_index, (cell_id // 7000) // 500 * 100 + (cell_id % 7000) // 500 AS zone, time_bucket(INTERVAL 1 HOUR, win_start) AS t0, time_bucket(INTERVAL 1 HOUR, win_end) + INTERVAL 1 HOUR AS t1 FROM event_windows WHERE cell_id IS NOT NULL),
g AS (SELECT storm_index, cell_id, unit, w, t0, unnest(generate_series(t0 - INTERVAL 5 HOUR, t1, INTERVAL 1 HOUR)) AS hour FROM s JOIN c USING (zone)),
x AS (SELECT g.*, h.v FROM g LEFT JOIN h ON h.cell_id = g.cell_id AND h.hour = g.hour),
y AS (SELECT *, coalesce(v, 0) AS s1, sum(coalesce(v, 0)) OVER (q ROWS 2 PRECEDING) AS s3, sum(coalesce(v, 0)) OVER (q ROWS 5 PRECEDING) AS s6 FROM x WINDOW q AS (PARTITION BY storm_index, cell_id ORDER BY hour)),
k AS (SELECT storm_index, cell_id, unit, w, count(*) FILTER (v > 100) >= 4 OR count(*) FILTER (v > 150) >= 3 AS hot, sum(CASE WHEN hour >= t0 THEN coalesce(v, 0) ELSE 0 END) AS ep, sum(CASE WHEN hour < t0 THEN coalesce(v, 0) ELSE 0 END) AS pre,
 round(max(s1) FILTER (hour >= t0), 6) AS m1, round(max(s3) FILTER (hour >= t0), 6) AS m3, round(max(s6) FILTER (hour >= t0), 6) AS m6, min_by(hour, (-round(s6, 6), hour)) FILTER (hour >= t0) AS h6 FROM y GROUP BY 1, 2, 3, 4)"""

_RAIN = "round(sum(w) * pow(111.32 * 0.01, 2), 4) AS km2, count(*) FILTER (hot)::BIGINT AS n_hot, " + ", ".join(
    f"round(max({c}) FILTER (NOT hot), 4) AS {c}_max, round(sum({c} * w) FILTER (NOT hot) / sum(w) FILTER (NOT hot), 4) AS {c}_mean" for c in ("ep", "pre", "m1", "m3", "m6")
)


def _storm_hours(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every hour of each storm for each cell seen in its zone of 5 by 5 degrees, units being quarters of zones; and the same by cell."""
    h = _hourly(spark, sf)
    part = lambda n: F.floor(geo.cell_row(F.col("cell")) / n) * 100 + F.floor(geo.cell_column(F.col("cell")) / n)
    c = h.select(F.col("cell_id").alias("cell")).distinct().filter("cell IS NOT NULL")
    c = c.select("cell", part(500).alias("zone"), part(250).alias("unit"), F.cos(F.radians(geo.cell_lat(F.col("cell")))).alias("w"))
    w = table(spark, sf, "event_windows").filter("cell_id IS NOT NULL").select(F.col("storm_index").alias("storm"), F.col("cell_id").alias("cell"), "win_start", "win_end").withColumn("zone", part(500)).drop("cell").distinct()
    g = matching.hours_touched(w.join(c, "zone"), "win_start", "win_end", 5, 1).withColumn("t0", times.floor_to(F.col("win_start"), 3600))
    x = g.join(h.select(F.col("cell_id").alias("cell"), "hour", "v"), ["cell", "hour"], "left").select("storm", "cell", "unit", "w", "t0", "hour", "v")
    k = storms.cell_rain(x)
    return x, k.withColumns({f"m{d}": F.round(f"m{d}", 6) for d in storms.ROLL})


def _rain(d: DataFrame, by: list[str]) -> DataFrame:
    kinds = [f"{c}_{m}" for c in ("ep", "pre", "m1", "m3", "m6") for m in ("max", "mean")]
    return d.select(*by, r("km2").alias("km2"), "n_hot", *[r(k).alias(k) for k in kinds])


@query(f"WITH {_STORM} SELECT storm_index, unit::BIGINT AS unit, {_RAIN} FROM k GROUP BY 1, 2")
def storm_unit_rain(spark: SparkSession, sf: str) -> DataFrame:
    """Rain totals, rolling maxima and area of every unit a storm's footprint touches, without cells that are stuck high."""
    _, k = _storm_hours(spark, sf)
    return _rain(storms.footprint_rain(k, ["storm", "unit"]), [F.col("storm").alias("storm_index"), "unit"])


@query(f"WITH {_STORM} SELECT storm_index, min_by(h6, (-m6, cell_id)) FILTER (NOT hot) AS t6, {_RAIN} FROM k GROUP BY 1")
def storm_footprint_rain(spark: SparkSession, sf: str) -> DataFrame:
    """The same of the whole footprint, with the hour of the highest six-hour sum."""
    _, k = _storm_hours(spark, sf)
    return _rain(storms.footprint_rain(k, ["storm"]), [F.col("storm").alias("storm_index"), "t6"])


@query(f"""WITH {_STORM}, j AS (SELECT x.*, hot AND coalesce(v > 100, false) AS bad FROM x JOIN k USING (storm_index, cell_id) WHERE hour >= t0)
SELECT storm_index, hour, round(CASE WHEN count(*) FILTER (bad) > 0 THEN (avg(v) * count(*) - sum(v) FILTER (bad)) / greatest(count(*) - count(*) FILTER (bad), 1) ELSE avg(v) END, 4) AS mean, max(v) FILTER (NOT bad) AS top FROM j GROUP BY 1, 2""")
def storm_hourly_rain(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly series of each storm's footprint, rebuilt after stuck cells were taken out."""
    x, k = _storm_hours(spark, sf)
    return storms.hourly_rain(x, k).select(F.col("storm").alias("storm_index"), "hour", r("mean").alias("mean"), "top")


# --- reports, impacts and gages by unit ------------------------------------------------------------------------------------

_EDGES = "e AS (SELECT huc8, r[i].x AS x1, r[i].y AS y1, r[i + 1].x AS x2, r[i + 1].y AS y2 FROM (SELECT huc8, r, unnest(range(1, len(r))) AS i FROM (SELECT huc8, unnest(rings) AS r FROM (SELECT DISTINCT huc8, rings FROM huc8_units))))"


def _in_unit(points: str, key: str, lat: str, lon: str) -> str:
    """SQL: (key, huc8) of points in units, the least unit of several."""
    ok = f"NOT isnan({lat}) AND NOT isnan({lon}) AND abs({lat}) <= 90 AND abs({lon}) <= 180 AND NOT ({lat} = 0 AND {lon} = 0)"
    return f"""(SELECT {key}, min(huc8) AS huc8 FROM (SELECT p.{key}, e.huc8 FROM (SELECT DISTINCT {key}, {lat} AS y, {lon} AS x FROM {points} WHERE {ok}) p JOIN e ON (e.x1 <= p.x) <> (e.x2 <= p.x)
 WHERE e.y1 + (p.x - e.x1) * (e.y2 - e.y1) / (e.x2 - e.x1) > p.y GROUP BY p.{key}, p.x, p.y, e.huc8 HAVING count(*) % 2 = 1) GROUP BY 1)"""


_UNITS = f"""{_EDGES}, ev AS (SELECT c.episode_id, u.huc8, count(*) AS n, sum(coalesce(damage_total_usd, 0)) AS damage FROM (SELECT DISTINCT * FROM storm_clusters) c JOIN {_in_unit("storm_clusters", "cluster_id", "centroid_lat", "centroid_lon")} u USING (cluster_id) WHERE episode_id IS NOT NULL GROUP BY 1, 2),
ls AS (SELECT l.episode_id, u.huc8, count(*) AS n FROM lsrs l JOIN {_in_unit("lsrs", "lsr_id", "lat", "lon")} u USING (lsr_id) WHERE episode_id IS NOT NULL GROUP BY 1, 2),
ga AS (SELECT huc8, count(DISTINCT STAID) AS n, array_to_string(list_sort(list_distinct(list(STAID))), ';') AS ids FROM {_in_unit("gages", "STAID", "LAT_GAGE", "LNG_GAGE")} GROUP BY 1),
eh AS (SELECT coalesce(ev.episode_id, ls.episode_id) AS episode_id, coalesce(ev.huc8, ls.huc8) AS huc8, coalesce(ev.n, 0)::BIGINT AS n_events, coalesce(ls.n, 0)::BIGINT AS n_lsr, round(coalesce(damage, 0), 2) AS damage_usd FROM ev FULL JOIN ls ON ev.episode_id = ls.episode_id AND ev.huc8 = ls.huc8)"""


def _unit_of(df: DataFrame, units: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    g = nearby.containing(df, units, (key, lat, lon), "huc8", "rings")
    return g.groupBy(F.col("left_key").alias(key)).agg(F.min("region").alias("huc8"))


def _episode_units(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(episode_id, huc8, n_events, n_lsr, damage_usd), and the gages of each unit."""
    c, ls, g, u = (table(spark, sf, t) for t in ("storm_clusters", "lsrs", "gages", "huc8_units"))
    ev = c.distinct().join(_unit_of(c, u, "cluster_id", "centroid_lat", "centroid_lon"), "cluster_id")
    ev = ev.select("episode_id", "huc8", F.lit(1).alias("e"), F.lit(0).alias("l"), F.coalesce("damage_total_usd", F.lit(0.0)).alias("d"))
    lr = ls.join(_unit_of(ls, u, "lsr_id", "lat", "lon"), "lsr_id").select("episode_id", "huc8", F.lit(0).alias("e"), F.lit(1).alias("l"), F.lit(0.0).alias("d"))
    eh = ev.unionByName(lr).filter("episode_id IS NOT NULL").groupBy("episode_id", "huc8").agg(F.sum("e").alias("n_events"), F.sum("l").alias("n_lsr"), r(F.sum("d"), 2).alias("damage_usd"))
    ga = _unit_of(g, u, "STAID", "LAT_GAGE", "LNG_GAGE").groupBy("huc8").agg(F.count_distinct("STAID").alias("n_gages"), F.array_join(F.array_sort(F.collect_set("STAID")), ";").alias("gage_ids"))
    return eh, ga


@query(f"""WITH {_UNITS} SELECT episode_id, huc8, n_events, n_lsr, n_events + n_lsr AS n_reports, CASE WHEN n_events + n_lsr > 0 THEN 1 ELSE 0 END::BIGINT AS flooded, damage_usd, coalesce(ga.n, 0)::BIGINT AS n_gages, coalesce(ga.ids, '') AS gage_ids FROM eh LEFT JOIN ga USING (huc8)""")
def episode_units(spark: SparkSession, sf: str) -> DataFrame:
    """Reports, damage and gages of every unit in which an episode was reported."""
    eh, ga = _episode_units(spark, sf)
    d = eh.join(ga, "huc8", "left").withColumn("n_reports", F.col("n_events") + F.col("n_lsr"))
    return d.select("episode_id", "huc8", "n_events", "n_lsr", "n_reports", (F.col("n_reports") > 0).cast("bigint").alias("flooded"), "damage_usd", F.coalesce("n_gages", F.lit(0)).cast("bigint").alias("n_gages"), F.coalesce("gage_ids", F.lit("")).alias("gage_ids"))


@query(f"""WITH {_UNITS}, p AS (SELECT huc8, count(DISTINCT episode_id) AS n, sum(n_events) AS e, sum(n_lsr) AS l FROM eh GROUP BY 1)
SELECT u.huc8, name, coalesce(p.n, 0)::BIGINT AS n_episodes, coalesce(p.e, 0)::BIGINT AS n_events_total, coalesce(p.l, 0)::BIGINT AS n_lsr_total, coalesce(ga.n, 0)::BIGINT AS n_gages FROM (SELECT DISTINCT huc8, name FROM huc8_units) u LEFT JOIN p USING (huc8) LEFT JOIN ga USING (huc8)""")
def unit_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Every unit with its episodes, events, reports and gages, zeros where there were none."""
    eh, ga = _episode_units(spark, sf)
    p = eh.groupBy("huc8").agg(F.count_distinct("episode_id").alias("n_episodes"), F.sum("n_events").alias("n_events_total"), F.sum("n_lsr").alias("n_lsr_total"))
    d = table(spark, sf, "huc8_units").select("huc8", "name").distinct().join(p, "huc8", "left").join(ga, "huc8", "left")
    return d.fillna(0).select("huc8", "name", "n_episodes", "n_events_total", "n_lsr_total", "n_gages")


@query(f"""WITH {_UNITS} SELECT episode_id, count(*)::BIGINT AS n_huc8, array_to_string(list_sort(list(huc8)), ';') AS huc8_list, sum(coalesce(ga.n, 0))::BIGINT AS n_gages FROM eh LEFT JOIN ga USING (huc8) GROUP BY 1""")
def episode_unit_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The units of each episode in order, and how many gages lie in them."""
    eh, ga = _episode_units(spark, sf)
    return eh.join(ga, "huc8", "left").groupBy("episode_id").agg(F.count("*").alias("n_huc8"), F.array_join(F.array_sort(F.collect_set("huc8")), ";").alias("huc8_list"), F.sum(F.coalesce("n_gages", F.lit(0))).alias("n_gages"))


# --- catchment series and forcing ------------------------------------------------------------------------------------------

_CROSSWALK = f"""{_EDGES}, pc AS (SELECT DISTINCT cell_id, 55 - (cell_id // 7000 + 0.5) * 0.01 AS y, -130 + (cell_id % 7000 + 0.5) * 0.01 AS x FROM precip_scans WHERE cell_id IS NOT NULL),
cw AS (SELECT cell_id, min(huc8) AS huc8, cos(radians(min(y))) AS w FROM (SELECT pc.cell_id, pc.y, e.huc8 FROM pc JOIN e ON (e.x1 <= pc.x) <> (e.x2 <= pc.x) WHERE e.y1 + (pc.x - e.x1) * (e.y2 - e.y1) / (e.x2 - e.x1) > pc.y GROUP BY ALL HAVING count(*) % 2 = 1) GROUP BY 1)"""


def _crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """(cell_id, huc8, w): the unit that holds the centre of each cell seen, and its weight."""
    i = F.col("cell_id")
    c = table(spark, sf, "precip_scans").select("cell_id").distinct().filter("cell_id IS NOT NULL").select("cell_id", geo.cell_lat(i).alias("lat"), geo.cell_lon(i).alias("lon"))
    return _unit_of(c, table(spark, sf, "huc8_units"), "cell_id", "lat", "lon").withColumn("w", F.cos(F.radians(geo.cell_lat(i))))


@query(f"WITH {_CROSSWALK} SELECT huc8, cell_id, round(w / sum(w) OVER (PARTITION BY huc8), 8) AS weight FROM cw")
def unit_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """Cells by the unit around their centre, with weights that add up to 1 in each unit."""
    return _crosswalk(spark, sf).select("huc8", "cell_id", r(F.col("w") / F.sum("w").over(Window.partitionBy("huc8")), 8).alias("weight"))


@query(f"""WITH {_CROSSWALK}, b AS (SELECT cell_id, time_bucket(INTERVAL 15 MINUTE, time) AS step_start, avg(precip_rate::DOUBLE) AS v FROM precip_scans WHERE precip_rate >= 0 AND isfinite(precip_rate) GROUP BY 1, 2)
SELECT huc8, step_start, count(*)::BIGINT AS n_cells, round(sum(w * v) / sum(w) * 0.25, 5) AS depth FROM b JOIN cw USING (cell_id) GROUP BY 1, 2""")
def unit_rain_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Depth of rain by unit and quarter of an hour: the mean over its cells that were seen, by weight."""
    p = table(spark, sf, "precip_scans").filter(usable(F.col("precip_rate")))
    b = series.resample(p, "cell_id", "time", 900, {"v": F.avg(F.col("precip_rate").cast("double"))}, dense=False).join(_crosswalk(spark, sf), "cell_id")
    m = b.groupBy("huc8", "step_start").agg(F.count("*").alias("n_cells"), (F.sum(F.col("w") * F.col("v")) / F.sum("w") * 0.25).alias("depth"))
    return m.select("huc8", "step_start", "n_cells", r("depth", 5).alias("depth"))


def _source_steps(source: str, name: str) -> str:
    return f"""{name} AS (SELECT storm_index, cell_id, ((epoch_us(t) - epoch_us(win_start)) // 900000000)::BIGINT AS step, avg(v) * 0.25 AS depth FROM (SELECT DISTINCT storm_index, cell_id, win_start, win_end FROM event_windows) w
 JOIN (SELECT cell_id, time AS t, precip_rate::DOUBLE AS v FROM precip_scans WHERE source = '{source}' AND precip_rate >= 0 AND isfinite(precip_rate)) p USING (cell_id) WHERE t >= win_start AND t < win_end GROUP BY 1, 2, 3)"""


def _window_steps(spark: SparkSession, sf: str, source: str | None, name: str) -> DataFrame:
    """(storm_index, cell_id, step, name): depth in the 15-minute steps of each window, from one source or all; windows meet scans by day."""
    day = lambda c: F.floor(times.micros(c) / F.lit(86_400_000_000))
    w = table(spark, sf, "event_windows").select("storm_index", "cell_id", "win_start", "win_end").distinct()
    w = w.withColumn("day", F.explode(F.sequence(day(F.col("win_start")), day(F.col("win_end")))))
    p = table(spark, sf, "precip_scans").filter(usable(F.col("precip_rate")))
    p = (p.filter(F.col("source") == source) if source else p).select("cell_id", "time", F.col("precip_rate").cast("double").alias("v"), day(F.col("time")).alias("day"))
    j = w.join(p, ["cell_id", "day"]).filter("time >= win_start AND time < win_end")
    step = F.floor((times.micros(F.col("time")) - times.micros(F.col("win_start"))) / F.lit(900_000_000))
    return j.groupBy("storm_index", "cell_id", step.alias("step")).agg((F.avg("v") * 0.25).alias(name))


@query(f"""WITH {_source_steps("aws", "a")}, {_source_steps("isu", "b")}, na AS (SELECT storm_index, max(step) + 1 AS n FROM a GROUP BY 1), nb AS (SELECT storm_index, max(step) + 1 AS n FROM b GROUP BY 1)
SELECT a.storm_index, a.cell_id, a.step, least(na.n, nb.n)::BIGINT AS n_steps, round(a.depth, 5) AS depth_a, round(b.depth, 5) AS depth_b FROM a JOIN b ON b.storm_index = a.storm_index AND b.cell_id = a.cell_id AND b.step = a.step JOIN na ON na.storm_index = a.storm_index JOIN nb ON nb.storm_index = a.storm_index WHERE a.step < least(na.n, nb.n)""")
def forcing_join(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources' series of the same storms, cell and step by step, as long as the shorter one; what only one of them has is left out."""
    a, b = _window_steps(spark, sf, "aws", "a"), _window_steps(spark, sf, "isu", "b")
    n = lambda d, c: d.groupBy("storm_index").agg((F.max("step") + 1).alias(c))
    j = a.join(b, ["storm_index", "cell_id", "step"]).join(n(a, "na"), "storm_index").join(n(b, "nb"), "storm_index").withColumn("n_steps", F.least("na", "nb")).filter("step < n_steps")
    return j.select("storm_index", "cell_id", "step", "n_steps", r("a", 5).alias("depth_a"), r("b", 5).alias("depth_b"))


@query(f"""WITH {_source_steps("aws", "a").replace("source = 'aws' AND ", "")}, w AS (SELECT storm_index, sum(datediff('minute', win_start, win_end) // 15)::BIGINT AS steps FROM (SELECT DISTINCT storm_index, cell_id, win_start, win_end FROM event_windows) GROUP BY 1),
t AS (SELECT storm_index, count(*) AS n, sum(depth) AS total FROM a GROUP BY 1)
SELECT w.storm_index, steps, coalesce(n, 0)::BIGINT AS observed, round(total, 4) AS total, coalesce(total, 0) < 1 AS dry, CASE WHEN coalesce(n, 0) >= 0.95 * steps THEN 'full' WHEN n >= 0.9 * steps THEN 'good' WHEN n >= 0.8 * steps THEN 'fair' ELSE 'incomplete' END AS gate FROM w LEFT JOIN t USING (storm_index)""")
def storm_gates(spark: SparkSession, sf: str) -> DataFrame:
    """How much of each window was observed (0.95, 0.90, 0.80 of its steps), its total in mm, and whether that is under 1 mm."""
    w = table(spark, sf, "event_windows").select("storm_index", "cell_id", "win_start", "win_end").distinct()
    n = F.floor((times.micros(F.col("win_end")) - times.micros(F.col("win_start"))) / F.lit(900_000_000))
    t = _window_steps(spark, sf, None, "depth").groupBy("storm_index").agg(F.count("*").alias("n"), F.sum("depth").alias("total"))
    d = w.groupBy("storm_index").agg(F.sum(n).alias("steps")).join(t, "storm_index", "left").withColumn("observed", F.coalesce("n", F.lit(0).cast("bigint")))
    share = lambda s: F.col("observed") >= s * F.col("steps")
    gate = F.when(share(0.95), "full").when(share(0.9), "good").when(share(0.8), "fair").otherwise("incomplete")
    return d.select("storm_index", "steps", "observed", r("total").alias("total"), (F.coalesce("total", F.lit(0.0)) < 1).alias("dry"), gate.alias("gate"))


@query("""
WITH w AS (SELECT DISTINCT storm_index, cell_id, time_bucket(INTERVAL 1 HOUR, win_start) AS hour FROM event_windows),
j AS (SELECT w.*, p.obs_id, p.source, p.time, row_number() OVER (PARTITION BY w.storm_index, w.cell_id, w.hour ORDER BY CASE p.source WHEN 'iem' THEN 0 WHEN 'aws' THEN 1 ELSE 2 END, abs(epoch_us(p.time) - epoch_us(w.hour)), p.time, p.obs_id) AS k
 FROM w JOIN precip_scans p ON p.cell_id = w.cell_id AND p.time BETWEEN w.hour - INTERVAL 10 MINUTE AND w.hour + INTERVAL 10 MINUTE WHERE p.source IS NOT NULL AND p.precip_rate >= 0 AND isfinite(p.precip_rate))
SELECT w.storm_index, w.cell_id, w.hour, j.obs_id, CASE WHEN j.time = w.hour THEN j.source ELSE j.source || '@' || strftime(j.time, '%H%M%S') END AS label FROM w LEFT JOIN j ON j.storm_index = w.storm_index AND j.cell_id = w.cell_id AND j.hour = w.hour AND j.k = 1""")
def hourly_scan_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """The scan at the full hour of each window, or within ten minutes of it, from the first source that has one, and where it came from."""
    w = table(spark, sf, "event_windows").select("storm_index", "cell_id", times.floor_to(F.col("win_start"), 3600).alias("hour")).distinct()
    p = table(spark, sf, "precip_scans").filter(F.col("source").isNotNull() & usable(F.col("precip_rate")))
    p = p.withColumn("place", F.when(F.col("source") == "iem", 0).when(F.col("source") == "aws", 1).otherwise(2))
    d = matching.nearest_in_time(w, p, "cell_id", "hour", "time", 600, ["obs_id", "source", "time"], "place")
    label = F.when(F.col("nearest_time") == F.col("hour"), F.col("nearest_source")).otherwise(F.concat(F.col("nearest_source"), F.lit("@"), F.date_format("nearest_time", "HHmmss")))
    return d.select("storm_index", "cell_id", "hour", F.col("nearest_obs_id").alias("obs_id"), label.alias("label"))


# --- peaks and clusters ----------------------------------------------------------------------------------------------------

_PEAKS = """p AS (SELECT DISTINCT event_id, CASE WHEN length(s) >= 8 THEN s ELSE lpad(s, 8, '0') END AS site, v FROM (SELECT event_id, regexp_replace(trim(STAID), '\\.0$', '') AS s, peak_flow_cfs AS v FROM site_events))"""


@query(f"""WITH {_PEAKS}, e AS (SELECT site, v, 100.0 * row_number() OVER w / (count(*) OVER (PARTITION BY site) + 1) AS x FROM p WHERE v > 0 WINDOW w AS (PARTITION BY site ORDER BY v DESC, event_id)),
g AS (SELECT site, max(x) FILTER (x <= 25) AS x1, min(x) FILTER (x > 25) AS x2, max_by(v, x) FILTER (x <= 25) AS v1, min_by(v, x) FILTER (x > 25) AS v2 FROM e GROUP BY 1),
q AS (SELECT site, coalesce(v1 + (v2 - v1) * (25 - x1) / (x2 - x1), v1, v2) AS q FROM g)
SELECT event_id, site, v AS peak, round(q, 6)::DOUBLE AS threshold FROM p JOIN q USING (site) WHERE round(v, 6) >= round(q, 6)""")
def peaks_over_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Flood peaks that reach what their own gage exceeds a quarter of the time."""
    p = table(spark, sf, "site_events").select("event_id", text.site_id(F.col("STAID")).alias("site"), F.col("peak_flow_cfs").alias("peak")).distinct()
    q = series.value_at_exceedance(p, "site", "peak", "event_id", 25.0)
    return p.join(q, "site").filter("round(peak, 6) >= round(q, 6)").select("event_id", "site", "peak", r("q", 6).alias("threshold"))


_CIRCLES = """p AS (SELECT event_id AS id, min(water_year) AS g, min(peak_time) AS t, min(gage_lat) AS y, min(gage_lon) AS x, least(coalesce(min(duration_hours), 1), 20)::DOUBLE AS rad FROM site_events WHERE water_year IS NOT NULL AND gage_lat IS NOT NULL AND gage_lon IS NOT NULL AND peak_time IS NOT NULL AND NOT isnan(gage_lat) AND NOT isnan(gage_lon) GROUP BY 1),
l AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.g = b.g AND a.id < b.id AND abs(epoch_us(a.t) - epoch_us(b.t)) <= 86400000000 AND abs(a.y - b.y) <= 0.6
 WHERE 2 * 6371 * asin(sqrt(least(pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2), 1))) <= a.rad + b.rad + 10),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), w(s, v) AS (SELECT id, id FROM p UNION SELECT w.s, e.b FROM w JOIN e ON e.a = w.v), c AS (SELECT s AS id, min(v) AS component FROM w GROUP BY 1),
f AS (SELECT component, min(g) AS g, min((t, p.id)) AS first FROM c JOIN p USING (id) GROUP BY 1), k AS (SELECT component, g || '_' || row_number() OVER (PARTITION BY g ORDER BY first) AS cluster_id FROM f)"""


def _circles(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Flood peaks as circles, and (id, component) of those that touch within a day and a water year, with 5 km around each."""
    e = table(spark, sf, "site_events").dropna(subset=["water_year", "gage_lat", "gage_lon", "peak_time"])
    p = e.groupBy(F.col("event_id").alias("id")).agg(F.min("water_year").alias("g"), F.min("peak_time").alias("t"), F.min("gage_lat").alias("y"), F.min("gage_lon").alias("x"), F.least(F.coalesce(F.min("duration_hours"), F.lit(1)), F.lit(20)).cast("double").alias("rad"))
    return p, clusters.components(p, clusters.circle_links(p, "g", "id", "t", "y", "x", "rad", 24.0, 5.0))


@query(f"WITH RECURSIVE {_CIRCLES} SELECT id, cluster_id FROM c JOIN k USING (component)")
def circle_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Cluster names: the water year and a number by first appearance in it."""
    p, c = _circles(spark, sf)
    return c.join(clusters.numbered(p.join(c, "id"), "g", "component", "t", "id"), "component").select("id", "cluster_id")


@query(f"""WITH RECURSIVE {_CIRCLES}, o AS (SELECT id, min(cz_timezone) AS z, min(volume_acreft) AS vol FROM (SELECT event_id AS id, * FROM site_events) GROUP BY 1), j AS (SELECT cluster_id, p.*, z, vol FROM c JOIN k USING (component) JOIN p USING (id) JOIN o USING (id)),
m AS (SELECT cluster_id, z, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, z) AS i FROM j WHERE z IS NOT NULL GROUP BY 1, 2)
SELECT j.cluster_id, count(*)::BIGINT AS n, min(t) AS begin_time, max(t) AS end_time, round(avg(y), 4) AS lat, round(avg(x), 4) AS lon, count(DISTINCT j.z)::BIGINT AS n_zones, array_to_string(list_sort(list_distinct(list(j.z))), ', ') AS zones, min(m.z) AS main_zone, round(sum(vol), 2) AS volume
FROM j LEFT JOIN m ON m.cluster_id = j.cluster_id AND m.i = 1 GROUP BY 1""")
def circle_cluster_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Each cluster's times, centre, zones, commonest zone (the least of ties) and sums; a sum of nothing stays null."""
    p, c = _circles(spark, sf)
    o = table(spark, sf, "site_events").groupBy(F.col("event_id").alias("id")).agg(F.min("cz_timezone").alias("z"), F.min("volume_acreft").alias("vol"))
    j = p.join(c, "id").join(clusters.numbered(p.join(c, "id"), "g", "component", "t", "id"), "component").join(o, "id")
    m = j.filter("z IS NOT NULL").groupBy("cluster_id", "z").agg(F.count("*").alias("k")).groupBy("cluster_id").agg(F.min_by("z", F.struct(-F.col("k"), F.col("z"))).alias("main_zone"))
    g = j.groupBy("cluster_id").agg(
        F.count("*").alias("n"), F.min("t").alias("begin_time"), F.max("t").alias("end_time"), r(F.avg("y")).alias("lat"), r(F.avg("x")).alias("lon"), F.count_distinct("z").alias("n_zones"),
        F.array_join(F.array_sort(F.collect_set("z")), ", ").alias("zones"), r(F.sum("vol"), 2).alias("volume"),
    )
    return g.join(m, "cluster_id", "left")


@query()
def reports_of_episodes(spark: SparkSession, sf: str) -> DataFrame:
    """Reports in the time of an episode and one of its counties, or within a quarter of a degree of its corner's box where they have no county."""
    ls, e = table(spark, sf, "lsrs"), table(spark, sf, "episodes").distinct()
    rep = to_utc(ls, "valid_utc", None, ("lsr_id", "county_fips", "lat", "lon"), "t", "UTC").filter("status = 'ok'")
    rep = rep.select(F.col("lsr_id").alias("report_id"), "t", F.col("county_fips").alias("county"), "lat", "lon")
    a = to_utc(e, "begin_utc", None, ("episode_id", "end_utc", "county_fips", "min_lat", "min_lon"), "t0", "UTC").filter("status = 'ok'").drop("status")
    z = to_utc(a, "end_utc", None, ("episode_id", "t0", "county_fips", "min_lat", "min_lon"), "t1", "UTC").drop("status")
    box = F.struct(F.col("min_lat"), F.col("min_lon"), (F.col("min_lat") + 0.5).alias("max_lat"), (F.col("min_lon") + 0.5).alias("max_lon"))
    ep = z.select("episode_id", "t0", F.coalesce("t1", "t0").alias("t1"), F.split(F.coalesce("county_fips", F.lit("")), ";").alias("counties"), box.alias("box"))
    return matching.interval_set_match(rep, ep)


# --- catalog ---------------------------------------------------------------------------------------------------------------

_UP = "coalesce(list_min(list_filter([1, 2, 3, 5, 10, 15, 20, 25, 30, 40, 50, 75, 100, 150, 200, 250, 300, 400, 500, 750, 1000, 1500, 2000, 3000, 5000, 7500, 10000], lambda l: l >= {v}))::DOUBLE, ceil({v} / 1000) * 1000)"
_NEXT = "coalesce(list_min(list_filter([1, 2, 3, 5, 10, 15, 20, 25, 30, 40, 50, 75, 100, 150, 200, 250, 300, 400, 500, 750, 1000, 1500, 2000, 3000, 5000, 7500, 10000], lambda l: l > {v}))::DOUBLE, {v} + 1000)"
_MONEY = "(CASE WHEN {v} / pow(10, floor(log10({v}))) <= 1 THEN 1 WHEN {v} / pow(10, floor(log10({v}))) <= 2.5 THEN 2.5 WHEN {v} / pow(10, floor(log10({v}))) <= 5 THEN 5 ELSE 10 END * pow(10, floor(log10({v}))))"


def _break_sql(values: str, up: str, more: str) -> str:
    """SQL: the five breaks of values(v), one step on from the other."""
    steps = ["b0 AS (SELECT *, " + up.format(v="r1") + " AS x1 FROM w)"]
    for i in range(2, 6):
        steps.append(f"b{i - 1} AS (SELECT *, CASE WHEN {up.format(v=f'r{i}')} <= x{i - 1} THEN {more.format(v=f'x{i - 1}')} ELSE {up.format(v=f'r{i}')} END AS x{i} FROM b{i - 2})")
    raw = ", ".join(f"max(v) FILTER (k = least(floor({q} * n), n - 1)) AS r{i + 1}" for i, q in enumerate((0.3, 0.55, 0.75, 0.88, 0.96)))
    rows = " UNION ALL ".join(f"SELECT {i}::BIGINT AS i, x{i + 1}::DOUBLE AS value FROM b4" for i in range(5))
    return f"WITH v AS (SELECT v::DOUBLE AS v, row_number() OVER (ORDER BY v) - 1 AS k, count(*) OVER () AS n FROM ({values}) WHERE v > 0), w AS (SELECT {raw} FROM v), {', '.join(steps)} {rows}"


@query(_break_sql("SELECT count(*) AS v FROM lsrs WHERE episode_id IS NOT NULL GROUP BY episode_id", _UP, _NEXT))
def report_count_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Breaks for a map of reports by episode, in round numbers."""
    n = table(spark, sf, "lsrs").filter("episode_id IS NOT NULL").groupBy("episode_id").agg(F.count("*").alias("v"))
    return catalog.ladder_breaks(n, "v", (0.3, 0.55, 0.75, 0.88, 0.96))


@query(_break_sql("SELECT damage_total_usd AS v FROM (SELECT DISTINCT * FROM storm_clusters)", _MONEY, _MONEY.replace("{v}", "({v} * 1.5)")))
def damage_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Breaks for a map of damage, in round amounts."""
    return catalog.ladder_breaks(table(spark, sf, "storm_clusters").distinct(), "damage_total_usd", (0.3, 0.55, 0.75, 0.88, 0.96), money=True)


@query("""
WITH e AS (SELECT DISTINCT episode_id, states, n_lsr, fatalities, injuries, damage_usd, min_lat, try_cast(regexp_extract(begin_utc, '(20[0-9][0-9])', 1) AS INT) AS y FROM episodes), t AS (SELECT greatest(max(damage_usd), 100000) AS top FROM e)
SELECT episode_id, y::BIGINT AS year FROM e, t WHERE y BETWEEN 2015 AND 2022 AND list_has_any(list_transform(string_split(states, ','), lambda s: trim(s)), ['TX', 'OK', 'AZ', 'IL', 'NC']) AND n_lsr >= 1 AND damage_usd >= round(pow(10, 4 + 15 / 100 * (log10(top) - 4))) AND min_lat >= 28""")
def catalog_matches(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog's filter: years, any of some states, least numbers where they ask something, a logarithmic slider for damage, a range with an open top."""
    e = table(spark, sf, "episodes").select("episode_id", "states", "n_lsr", "fatalities", "injuries", "damage_usd", "min_lat", F.regexp_extract("begin_utc", "(20[0-9][0-9])", 1).try_cast("int").alias("y")).distinct()
    top = e.agg(F.greatest(F.max("damage_usd"), F.lit(100000)).alias("top"))
    ok = F.col("y").between(2015, 2022) & catalog.any_of(F.col("states"), ["TX", "OK", "AZ", "IL", "NC"]) & catalog.at_least({"n_lsr": 1, "fatalities": 0, "injuries": 0})
    d = e.filter(ok & catalog.open_range(F.col("min_lat"), 28.0, 90.0, 90.0)).crossJoin(F.broadcast(top))  # one row
    return d.filter(F.col("damage_usd") >= catalog.slider_amount(F.lit(15.0), F.col("top"))).select("episode_id", F.col("y").cast("bigint").alias("year"))


@query("""
SELECT primary_state, count(*)::BIGINT AS n, round_even(1000.0 * sum(damage_total_usd) / sum(sum(damage_total_usd)) OVER (), 0)::INT AS share, round_even(10.0 * avg(footprint_radius_km / 100), 0)::INT AS width
FROM (SELECT DISTINCT * FROM storm_clusters) GROUP BY 1""")
def damage_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Each state's share of all damage in thousandths, and its mean radius, a percent of old records brought to a ratio, likewise."""
    c = table(spark, sf, "storm_clusters").distinct().groupBy("primary_state").agg(F.count("*").alias("n"), F.sum("damage_total_usd").alias("d"), F.avg(catalog.as_ratio(F.col("footprint_radius_km"), F.lit(None))).alias("w"))
    whole = c.agg(F.sum("d").alias("all"))
    return c.crossJoin(F.broadcast(whole)).select("primary_state", "n", catalog.permille(F.col("d") / F.col("all")).alias("share"), catalog.permille(F.col("w") / 100).alias("width"))  # one row
