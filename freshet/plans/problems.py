"""Queries of the numbered data-preparation problems in the core, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators import hierarchy, nearby
from freshet.operators.regrid import regrid
from freshet.functions.text import site_id
from freshet.operators.spikes import FLOOD_PEAK, RAIN_RATE, implausible
from freshet.operators.timestamps import to_utc
from freshet.sources.tables import table


def p1_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Implausible readings of both tables with the reason."""
    rain = implausible(table(spark, sf, "precip_scans"), "obs_id", "cell_id", "time", "precip_rate", RAIN_RATE)
    peaks = table(spark, sf, "site_events").withColumn("site", site_id(F.col("STAID")))
    flood = implausible(peaks, "event_id", "site", "peak_time", "peak_flow_cfs", FLOOD_PEAK)
    return rain.select(F.lit("precip_scans").alias("table_name"), "row_id", "reason").unionByName(flood.select(F.lit("site_events").alias("table_name"), "row_id", "reason"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_reasons(spark, sf).select("table_name", "row_id")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy.summary(table(spark, sf, "network")).withColumnRenamed("n_up", "n_up_divides")


def p2_paths(spark: SparkSession, sf: str) -> DataFrame:
    h = hierarchy.build_hierarchy(table(spark, sf, "network"))
    return hierarchy.paths(h).select("id", F.array_join("path", ">").alias("path"))


def p2_upstream(spark: SparkSession, sf: str) -> DataFrame:
    """Everything upstream of every id, itself included, with its divide_id; see hierarchy.upstream."""
    n = table(spark, sf, "network")
    return hierarchy.upstream(hierarchy.build_hierarchy(n), n).withColumnRenamed("value", "divide_id")


def p3_series(spark: SparkSession, sf: str) -> DataFrame:
    """Every 15-minute step of every window, amounts in mm to the nanometre."""
    d = regrid(table(spark, sf, "precip_scans"), table(spark, sf, "event_windows"), "cell_id", "time", "precip_rate", "storm_index", "win_start", "win_end")
    return d.withColumns({"amount": F.round("amount", 6), "covered": F.round("covered", 6)})


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_series(spark, sf).filter("n_readings = 0").select("storm_index", "step")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    clusters, gages, units = (table(spark, sf, t) for t in ("storm_clusters", "gages", "huc8_units"))
    at = ("cluster_id", "centroid_lat", "centroid_lon")
    g = nearby.near(clusters, gages, 10.0, at, ("STAID", "LAT_GAGE", "LNG_GAGE"))
    u = nearby.containing(clusters, units, at, "huc8", "rings")
    g = g.select(F.col("left_key").alias("cluster_id"), F.lit("gage").alias("relation"), F.col("right_key").alias("target_id"))
    return g.unionByName(u.select(F.col("left_key").alias("cluster_id"), F.lit("huc8").alias("relation"), F.col("region").alias("target_id")))


def _time_texts(spark: SparkSession, sf: str) -> DataFrame:
    """(table_name, row_key, field_name, text, zone) of the six fields."""

    def of(name: str, key: str, fields: tuple[str, ...], zone: str | None) -> DataFrame:
        cols = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields]))
        z = F.col(zone) if zone else F.lit("UTC")
        d = table(spark, sf, name).select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("row_key"), cols.alias("f"), z.alias("zone"))
        return d.select("table_name", "row_key", "f.field_name", "f.text", "zone").filter("text IS NOT NULL")

    both = ("BEGIN_DATE_TIME", "END_DATE_TIME")
    parts = [of("site_events", "event_id", both, "cz_timezone"), of("storm_clusters", "cluster_id", both, "cz_timezone"), of("episodes", "episode_id", ("begin_utc",), None), of("lsrs", "lsr_id", ("valid_utc",), None)]
    return reduce(DataFrame.unionByName, parts)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    t = to_utc(_time_texts(spark, sf), "text", "zone", ("table_name", "row_key", "field_name")).filter("status = 'ok'")
    return t.select("table_name", "row_key", "field_name", F.date_format("utc", "yyyy-MM-dd HH:mm:ss").alias("utc_text")).distinct()


QUERIES = {"p1_found": p1_found, "p1_reasons": p1_reasons, "p2_found": p2_found, "p2_paths": p2_paths, "p2_upstream": p2_upstream, "p3_found": p3_found, "p3_series": p3_series, "p4_found": p4_found, "p5_found": p5_found}

SQL = {
    "p2_found": """
WITH RECURSIVE r AS (SELECT trim(id) AS id, min(trim(toid)) FILTER (WHERE trim(toid) IN (SELECT trim(id) FROM network)) AS p FROM network WHERE id IS NOT NULL GROUP BY 1),
walk(s, node) AS (SELECT id, p FROM r WHERE p IS NOT NULL UNION SELECT s, r.p FROM walk JOIN r ON r.id = walk.node WHERE r.p IS NOT NULL),
circle AS (SELECT DISTINCT s AS id FROM walk WHERE s = node),
bad AS (SELECT DISTINCT s AS id FROM walk WHERE node IN (SELECT id FROM circle)),
up(id, node, k) AS (SELECT id, id, 0 FROM r WHERE id NOT IN (SELECT id FROM bad) UNION ALL SELECT up.id, r.p, k + 1 FROM up JOIN r ON r.id = up.node WHERE r.p IS NOT NULL),
roots AS (SELECT up.id, up.node AS root_id, up.k AS depth FROM up JOIN r ON r.id = up.node WHERE r.p IS NULL),
n AS (SELECT up.node AS id, count(DISTINCT d.divide_id) AS n FROM up JOIN network d ON trim(d.id) = up.id GROUP BY 1)
SELECT r.id, CASE WHEN bad.id IS NULL THEN roots.root_id ELSE 'CYCLE' END AS root_id,
  CASE WHEN bad.id IS NULL THEN roots.depth ELSE -1 END::BIGINT AS depth, CASE WHEN bad.id IS NULL THEN n.n ELSE -1 END::BIGINT AS n_up_divides
FROM r LEFT JOIN roots USING (id) LEFT JOIN n USING (id) LEFT JOIN bad USING (id)""",
    "p2_paths": """
WITH RECURSIVE r AS (SELECT trim(id) AS id, min(trim(toid)) FILTER (WHERE trim(toid) IN (SELECT trim(id) FROM network)) AS p FROM network WHERE id IS NOT NULL GROUP BY 1),
down(id, path) AS (SELECT id, id FROM r WHERE p IS NULL UNION ALL SELECT r.id, r.id || '>' || down.path FROM down JOIN r ON r.p = down.id)
SELECT r.id, down.path FROM r LEFT JOIN down USING (id)""",
    "p2_upstream": """
WITH RECURSIVE r AS (SELECT trim(id) AS id, min(trim(toid)) FILTER (WHERE trim(toid) IN (SELECT trim(id) FROM network)) AS p FROM network WHERE id IS NOT NULL GROUP BY 1),
free(id) AS (SELECT id FROM r WHERE p IS NULL UNION ALL SELECT r.id FROM free JOIN r ON r.p = free.id),
up(id, node) AS (SELECT id, id FROM free UNION ALL SELECT up.id, r.p FROM up JOIN r ON r.id = up.node WHERE r.p IS NOT NULL),
d AS (SELECT DISTINCT trim(id) AS id, divide_id FROM network WHERE divide_id IS NOT NULL)
SELECT up.node AS id, up.id AS descendant, d.divide_id FROM up LEFT JOIN d ON d.id = up.id
UNION ALL SELECT id, NULL, NULL FROM r WHERE id NOT IN (SELECT id FROM free)""",
    "p4_found": """
WITH c AS (SELECT DISTINCT cluster_id, centroid_lat AS y, centroid_lon AS x FROM storm_clusters WHERE NOT isnan(centroid_lat) AND NOT isnan(centroid_lon) AND abs(centroid_lat) <= 90 AND abs(centroid_lon) <= 180 AND NOT (centroid_lat = 0 AND centroid_lon = 0)),
g AS (SELECT DISTINCT STAID, LAT_GAGE AS y, LNG_GAGE AS x FROM gages WHERE NOT isnan(LAT_GAGE) AND NOT isnan(LNG_GAGE) AND abs(LAT_GAGE) <= 90 AND abs(LNG_GAGE) <= 180 AND NOT (LAT_GAGE = 0 AND LNG_GAGE = 0)),
e AS (SELECT huc8, r[i].x AS x1, r[i].y AS y1, r[i + 1].x AS x2, r[i + 1].y AS y2 FROM (SELECT huc8, r, unnest(range(1, len(r))) AS i FROM (SELECT huc8, unnest(rings) AS r FROM huc8_units)))
SELECT DISTINCT c.cluster_id, 'gage' AS relation, g.STAID AS target_id FROM c JOIN g ON abs(c.y - g.y) < 0.1
 WHERE 2 * 6371 * asin(sqrt(least(1, pow(sin(radians(g.y - c.y) / 2), 2) + cos(radians(c.y)) * cos(radians(g.y)) * pow(sin(radians(g.x - c.x) / 2), 2)))) <= 10
UNION ALL SELECT DISTINCT cluster_id, 'huc8', huc8 FROM (SELECT c.cluster_id, c.x, c.y, e.huc8 FROM c JOIN e ON (e.x1 <= c.x) <> (e.x2 <= c.x) WHERE e.y1 + (c.x - e.x1) * (e.y2 - e.y1) / (e.x2 - e.x1) > c.y GROUP BY ALL HAVING count(*) % 2 = 1)""",
    "p3_series": """
WITH w AS (SELECT DISTINCT storm_index, cell_id, win_start, win_end FROM event_windows), s AS (SELECT *, unnest(range(0, datediff('minute', win_start, win_end) // 15)) AS step FROM w),
u AS (SELECT cell_id, epoch_us(time) AS t, precip_rate::DOUBLE AS v FROM precip_scans WHERE precip_rate >= 0 AND isfinite(precip_rate)), l AS (SELECT *, lag(t) OVER (PARTITION BY cell_id ORDER BY t, v) AS t0 FROM u),
x AS (SELECT cell_id, t, v, CASE WHEN t - t0 <= 3600000000 THEN t0 END AS t0 FROM l), b AS (SELECT *, unnest(range(coalesce(t0, t) // 900000000, t // 900000000 + 1)) AS bin FROM x),
o AS (SELECT *, CASE WHEN t0 IS NOT NULL THEN greatest(least(t, (bin + 1) * 900000000) - greatest(t0, bin * 900000000), 0) END AS part FROM b),
g AS (SELECT cell_id, bin, count(*) FILTER (bin = t // 900000000) AS n, sum(part * v / 3600000000.0) AS amount, sum(part) / 900000000.0 AS covered FROM o GROUP BY 1, 2)
SELECT s.storm_index, s.step::BIGINT AS step, s.win_start + to_minutes(15 * s.step) AS step_start, coalesce(g.n, 0)::BIGINT AS n_readings, round(g.amount, 6) AS amount, round(coalesce(g.covered, 0), 6)::DOUBLE AS covered,
 CASE WHEN g.n > 0 THEN 'observed' WHEN g.covered > 0 THEN 'filled' ELSE 'empty' END AS status FROM s LEFT JOIN g ON g.cell_id = s.cell_id AND g.bin = epoch_us(s.win_start) // 900000000 + s.step""",
    "p3_found": """
WITH w AS (SELECT DISTINCT storm_index, cell_id, win_start, win_end FROM event_windows WHERE cell_id IS NOT NULL AND win_start IS NOT NULL AND win_end IS NOT NULL),
s AS (SELECT storm_index, cell_id, unnest(range(0, datediff('minute', win_start, win_end) // 15)) AS step, win_start FROM w),
t AS (SELECT storm_index, cell_id, step, win_start + to_minutes(15 * step) AS a FROM s),
g AS (SELECT DISTINCT cell_id, time_bucket(INTERVAL 15 MINUTE, time) AS a FROM precip_scans WHERE precip_rate >= 0 AND isfinite(precip_rate))
SELECT t.storm_index, t.step::BIGINT AS step FROM t LEFT JOIN g ON g.cell_id = t.cell_id AND g.a = t.a WHERE g.a IS NULL""",
}
