"""Queries of the flood-episode operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions import geo, physics, text, times
from freshet.operators import catalog, clusters, geometry, hierarchy, matching, nearby, series, zonal
from freshet.operators.regrid import usable
from freshet.plans import problems
from freshet.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r(c: Column | str, n: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


# --- assembly and roll-ups -------------------------------------------------------------------------------------------------


@query("""
SELECT episode_id, count(*)::BIGINT AS n, sum(n_reports)::BIGINT AS n_reports, round(sum(damage_total_usd), 2) AS damage,
  array_to_string(list_sort(list_distinct(list(primary_state))), ',') AS states,
  floor(min(centroid_lat) FILTER (ok) * 100) / 100 AS min_lat, ceil(max(centroid_lat) FILTER (ok) * 100) / 100 AS max_lat, min(duration_hours) AS min_hours
FROM (SELECT DISTINCT *, centroid_lat IS NOT NULL AND NOT isnan(centroid_lat) AND NOT isnan(centroid_lon) AND abs(centroid_lat) <= 90 AND abs(centroid_lon) <= 180 AND NOT (centroid_lat = 0 AND centroid_lon = 0) AS ok FROM storm_clusters)
WHERE episode_id IS NOT NULL GROUP BY 1""")
def episode_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Reports to episodes: counts, sums, distinct states in order, bounds of the places."""
    c = table(spark, sf, "storm_clusters").dropDuplicates().filter("episode_id IS NOT NULL")
    lat = F.when(nearby.has_place(F.col("centroid_lat"), F.col("centroid_lon")), F.col("centroid_lat"))
    return c.groupBy("episode_id").agg(
        F.count("*").alias("n"), F.sum("n_reports").alias("n_reports"), r(F.sum("damage_total_usd"), 2).alias("damage"),
        F.array_join(F.array_sort(F.collect_set("primary_state")), ",").alias("states"),
        (F.floor(F.min(lat) * 100) / 100).alias("min_lat"), (F.ceil(F.max(lat) * 100) / 100).alias("max_lat"), F.min("duration_hours").alias("min_hours"),
    )


@query("""
SELECT site, wy, count(*)::BIGINT AS n, max(v) AS top, min(v) AS low FROM (
  SELECT CASE WHEN length(s) >= 8 THEN s ELSE lpad(s, 8, '0') END AS site, (year(peak_time) + CASE WHEN month(peak_time) >= 10 THEN 1 ELSE 0 END)::BIGINT AS wy, v
  FROM (SELECT DISTINCT event_id, regexp_replace(trim(STAID), '\\.0$', '') AS s, peak_time, peak_flow_cfs AS v FROM site_events))
WHERE v > 0 GROUP BY 1, 2""")
def water_year_rollup(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "site_events").select("event_id", text.site_id(F.col("STAID")).alias("site"), "peak_time", F.col("peak_flow_cfs").alias("v")).distinct()
    return e.filter("v > 0").groupBy("site", times.water_year(F.col("peak_time")).alias("wy")).agg(F.count("*").alias("n"), F.max("v").alias("top"), F.min("v").alias("low"))


@query("""
SELECT n_name AS unit, year(o_orderdate)::BIGINT AS y, count(DISTINCT o_custkey)::BIGINT AS ep, count(*)::BIGINT AS ev, round(sum(o_totalprice), 2) AS damage
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((n_name, year(o_orderdate)), (n_name), ())""")
def unit_year_cube(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct episodes don't add up over units, so each grouping set counts them itself."""
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    d = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(F.col("n_name").alias("unit"), big(F.year("o_orderdate")).alias("y"), "o_custkey", "o_totalprice")
    return d.groupingSets([["unit", "y"], ["unit"], []], "unit", "y").agg(F.count_distinct("o_custkey").alias("ep"), F.count("*").alias("ev"), r(F.sum("o_totalprice"), 2).alias("damage"))


@query("SELECT event_type AS cause, count(*)::BIGINT AS n, count(DISTINCT user_id)::BIGINT AS users FROM events WHERE NOT regexp_matches(lower(coalesce(event_type, 'not specified')), 'error|dam|levee') GROUP BY 1")
def cause_histogram(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").filter(~F.lower(F.coalesce("event_type", F.lit("not specified"))).rlike("error|dam|levee"))
    return e.groupBy(F.col("event_type").alias("cause")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("""
SELECT typetext, wfo, n FROM (SELECT typetext, wfo, count(*)::BIGINT AS n, row_number() OVER (PARTITION BY typetext ORDER BY count(*) DESC, wfo) AS k FROM lsrs WHERE wfo IS NOT NULL GROUP BY 1, 2) WHERE k = 1""")
def most_common_office(spark: SparkSession, sf: str) -> DataFrame:
    """The mode of each group, the least of ties."""
    c = table(spark, sf, "lsrs").filter("wfo IS NOT NULL").groupBy("typetext", "wfo").agg(F.count("*").alias("n"))
    m = c.groupBy("typetext").agg(F.min_by(F.struct("wfo", "n"), F.struct(-F.col("n"), F.col("wfo"))).alias("m"))
    return m.select("typetext", "m.wfo", "m.n")


@query("""
SELECT state, count(*)::BIGINT AS n, sum(damage_usd)::BIGINT AS damage, rank() OVER (ORDER BY sum(damage_usd) DESC)::BIGINT AS place
FROM (SELECT DISTINCT episode_id, damage_usd, unnest(string_split(states, ',')) AS state FROM episodes) GROUP BY 1""")
def state_rank(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "episodes").select("episode_id", "damage_usd", F.explode(F.split("states", ",")).alias("state")).distinct()
    g = e.groupBy("state").agg(F.count("*").alias("n"), F.sum("damage_usd").alias("damage"))
    return g.withColumn("place", big(F.rank().over(Window.orderBy(F.col("damage").desc()))))


@query("SELECT user_id, " + ", ".join(f"sum(value::DECIMAL(18, 6)) FILTER (event_type = '{k}')::DOUBLE / nullif(count(value) FILTER (event_type = '{k}'), 0) AS {k}_mean" for k in ("view", "click", "purchase")) + " FROM events GROUP BY 1")
def pivot_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Means by kind in columns; sums are decimal, so that no order of rows changes them."""
    kinds = ["view", "click", "purchase"]
    g = table(spark, sf, "events").groupBy("user_id").pivot("event_type", kinds)
    p = g.agg(F.sum(F.col("value").cast("decimal(18,6)")).cast("double").alias("s"), F.count("value").alias("n"))
    return p.select("user_id", *[F.try_divide(F.col(f"{k}_s"), F.col(f"{k}_n")).alias(f"{k}_mean") for k in kinds])


@query("SELECT l_returnflag AS flag, l_linestatus AS status, count(*)::BIGINT AS n, quantile_cont(l_quantity, 0.25) AS q25, median(l_quantity) AS q50, quantile_cont(l_quantity, 0.9) AS q90, round(stddev_samp(l_quantity), 6) AS sd FROM lineitem GROUP BY 1, 2")
def describe_groups(spark: SparkSession, sf: str) -> DataFrame:
    p = lambda q: F.percentile("l_quantity", F.lit(q))
    g = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
    return g.agg(F.count("*").alias("n"), p(0.25).alias("q25"), p(0.5).alias("q50"), p(0.9).alias("q90"), r(F.stddev_samp("l_quantity"), 6).alias("sd"))


@query("""
SELECT band, count(*)::BIGINT AS n, round(avg(o_totalprice), 4) AS mean FROM (SELECT o_totalprice, CASE WHEN d > -0.1 AND d <= 10 THEN 1 WHEN d <= 50 THEN 2 WHEN d <= 90 THEN 3 ELSE 4 END::BIGINT AS band
FROM (SELECT o_totalprice, o_orderkey % 101 AS d FROM orders)) GROUP BY 1""")
def bands(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderkey") % 101
    band = F.when((d > -0.1) & (d <= 10), 1).when(d <= 50, 2).when(d <= 90, 3).otherwise(4)
    return table(spark, sf, "orders").groupBy(big(band).alias("band")).agg(F.count("*").alias("n"), r(F.avg("o_totalprice")).alias("mean"))


@query("""
WITH p AS (SELECT o_custkey, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS prior FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1)
SELECT o_orderkey, round(coalesce(p.prior, (SELECT avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'), 0.0), 6)::DOUBLE AS prior
FROM orders LEFT JOIN p USING (o_custkey) WHERE o_orderdate >= TIMESTAMP '1997-01-01'""")
def train_prior(spark: SparkSession, sf: str) -> DataFrame:
    """A group's rate in the time before, or the rate of all where the group had none."""
    o = table(spark, sf, "orders").withColumn("y", (F.col("o_orderstatus") == "F").cast("double"))
    cut = F.expr("TIMESTAMP_NTZ '1997-01-01'")
    train = o.filter(F.col("o_orderdate") < cut)
    prior = train.groupBy("o_custkey").agg(F.avg("y").alias("p"))
    whole = train.agg(F.avg("y").alias("g"))
    d = o.filter(F.col("o_orderdate") >= cut).join(prior, "o_custkey", "left").crossJoin(F.broadcast(whole))  # one row
    return d.select("o_orderkey", r(F.coalesce("p", "g", F.lit(0.0)), 6).alias("prior"))


@query("""
SELECT count(*) FILTER (f AND o)::BIGINT AS hits, count(*) FILTER (NOT f AND o)::BIGINT AS misses, count(*) FILTER (f AND NOT o)::BIGINT AS false_alarms,
 round(count(*) FILTER (f AND o) / greatest(count(*) FILTER (o), 1), 3) AS pod, round(count(*) FILTER (f AND NOT o) / greatest(count(*) FILTER (f), 1), 3) AS far,
 round(count(*) FILTER (f AND o) / greatest(count(*) FILTER (f OR o), 1), 3) AS csi
FROM (SELECT coalesce(l_quantity >= 30, false) AS f, coalesce(l_discount > 0.05, false) AS o FROM lineitem)""")
def warning_scores(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.contingency(table(spark, sf, "lineitem"), F.col("l_quantity") >= 30, F.col("l_discount") > 0.05)


@query("SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS f, count(*) FILTER (o_orderstatus = 'O')::BIGINT AS o, count(*) FILTER (o_orderstatus = 'P')::BIGINT AS p FROM orders GROUP BY 1")
def crosstab(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)
    return p.select("priority", *[F.col(c).alias(c.lower()) for c in "FOP"])


# --- text, time and number functions ---------------------------------------------------------------------------------------


@query("""
WITH t AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN abs(round(c_acctbal))::BIGINT || 'K' WHEN 1 THEN round(abs(c_acctbal), 1) || 'm' WHEN 2 THEN '' WHEN 3 THEN CASE WHEN c_custkey % 4 = 1 THEN '2.5T' ELSE 'bad' END WHEN 4 THEN NULL ELSE abs(round(c_acctbal))::BIGINT || ' B' END AS s FROM customer)
SELECT c_custkey, s, CASE WHEN f < 1e12 THEN coalesce(n * f, 0) ELSE 0 END AS amount, n * f AS amount_or_null FROM (SELECT c_custkey, s, try_cast(regexp_extract(trim(s), '^([0-9.]+)\\s*[KMBTkmbt]?$', 1) AS DOUBLE) AS n,
 CASE upper(right(trim(s), 1)) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 WHEN 'T' THEN 1e12 ELSE 1.0 END::DOUBLE AS f FROM t)""")
def damage_amounts(spark: SparkSession, sf: str) -> DataFrame:
    k, v = F.col("c_custkey") % 6, F.abs("c_acctbal")
    whole = big(F.abs(F.round("c_acctbal"))).cast("string")
    s = F.when(k == 0, F.concat(whole, F.lit("K"))).when(k == 1, F.concat(F.round(v, 1).cast("string"), F.lit("m"))).when(k == 2, "").when((k == 3) & (F.col("c_custkey") % 4 == 1), "2.5T").when(k == 3, "bad").when(k == 5, F.concat(whole, F.lit(" B")))
    c = table(spark, sf, "customer").select("c_custkey", s.alias("s"))
    return c.select("c_custkey", "s", text.money(F.col("s")).alias("amount"), text.money(F.col("s"), None).alias("amount_or_null"))


@query("""
SELECT o_orderkey, CASE WHEN d IS NULL THEN NULL ELSE d + to_hours(-z) END AS utc FROM (
 SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN -6 WHEN 1 THEN -5 ELSE 0 END AS z,
  CASE WHEN dd > day(last_day(make_date(y, m, 1))) THEN NULL ELSE make_timestamp(y, m, dd, least(greatest(hhmm // 100, 0), 23), least(greatest(hhmm % 100, 0), 59), 0) END AS d
 FROM (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, (o_orderkey % 31 + 1) AS dd, (o_orderkey * 37) % 2700 AS hhmm FROM orders))""")
def local_to_utc(spark: SparkSession, sf: str) -> DataFrame:
    """YYYYMM, DD and HHMM numbers with a zone like 'CST-6'; hours and minutes out of range are held, impossible days are null."""
    o = table(spark, sf, "orders").withColumn("ym", F.year("o_orderdate") * 100 + F.month("o_orderdate")).withColumn("dd", F.col("o_orderkey") % 31 + 1).withColumn("hhmm", (F.col("o_orderkey") * 37) % 2700)
    zone = F.when(F.col("o_orderkey") % 3 == 0, "CST-6").when(F.col("o_orderkey") % 3 == 1, "EST-5").otherwise("X")
    t = times.from_parts(F.col("ym"), F.col("dd"), F.col("hhmm"))
    return o.select("o_orderkey", F.timestamp_add("HOUR", -text.zone_hours(zone), t).alias("utc"))


@query("""
SELECT lsr_id, regexp_replace(regexp_replace(trim(regexp_replace(coalesce(narrative, ''), '\\s+', ' ', 'g')), '_ ', ', ', 'g'), '_$', ',') AS clean,
 coalesce(regexp_matches(lower(narrative), 'culvert|road'), false) AS roads, coalesce(regexp_matches(lower(narrative), 'rain'), false) AS rain FROM lsrs""")
def clean_narratives(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("narrative")
    return table(spark, sf, "lsrs").select("lsr_id", text.clean_text(n).alias("clean"), text.has_word(n, "culvert|road").alias("roads"), text.has_word(n, "rain").alias("rain"))


@query("""
SELECT city, array_to_string(list_transform(regexp_extract_all(city, '([A-Za-z]+|[^A-Za-z]+)'), lambda x: upper(x[1]) || lower(x[2:])), '') AS title, count(*)::BIGINT AS n FROM lsrs WHERE city IS NOT NULL GROUP BY 1""")
def titled_places(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "lsrs").filter("city IS NOT NULL").groupBy("city").agg(F.count("*").alias("n"))
    return c.select("city", text.title_case(F.col("city")).alias("title"), "n")


@query("""
SELECT id, CASE WHEN trim(toid) IN ('', 'nan', 'None') THEN NULL ELSE trim(toid) END AS toid, regexp_extract(id, '^([a-z]+)-', 1) AS kind, try_cast(split_part(id, '-', 2) AS BIGINT) AS number,
 count(*)::BIGINT AS n FROM network GROUP BY 1, 2, 3, 4""")
def network_ids(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("id")
    n = table(spark, sf, "network").select("id", text.clean_id(F.col("toid")).alias("toid"), text.id_kind(i).alias("kind"), F.split_part(i, F.lit("-"), F.lit(2)).try_cast("bigint").alias("number"))
    return n.groupBy("id", "toid", "kind", "number").agg(F.count("*").alias("n"))


@query("""
SELECT storm_index, cell_id, time_bucket(INTERVAL 1 HOUR, win_start) AS first_hour, time_bucket(INTERVAL 1 HOUR, win_end + INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND) AS last_hour,
 make_timestamp((epoch_us(win_start) + epoch_us(win_end)) // 2) AS middle, epoch_us(win_start) / 60000000.0 AS minutes FROM (SELECT DISTINCT * FROM event_windows)""")
def window_times(spark: SparkSession, sf: str) -> DataFrame:
    a, b = F.col("win_start"), F.col("win_end")
    w = table(spark, sf, "event_windows").distinct()
    return w.select("storm_index", "cell_id", times.floor_to(a, 3600).alias("first_hour"), times.ceil_to(b, 3600).alias("last_hour"), times.midpoint(a, b).alias("middle"), (times.micros(a) / 6e7).alias("minutes"))


@query("""
SELECT p_partkey, CASE u WHEN 'mm' THEN v WHEN 'kg m-2' THEN v WHEN 'in' THEN v * 25.4 WHEN 'mm/h' THEN v * 0.25 WHEN 'in/h' THEN v * 25.4 * 0.25 END::DOUBLE AS depth
FROM (SELECT p_partkey, p_size::DOUBLE AS v, CASE p_partkey % 6 WHEN 0 THEN 'mm' WHEN 1 THEN 'kg m-2' WHEN 2 THEN 'in' WHEN 3 THEN 'mm/h' WHEN 4 THEN 'in/h' ELSE 'furlong' END AS u FROM part)""")
def step_depths(spark: SparkSession, sf: str) -> DataFrame:
    u = F.element_at(F.array(*map(F.lit, ("mm", "kg m-2", "in", "mm/h", "in/h", "furlong"))), (F.col("p_partkey") % 6 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", physics.step_depth_mm(F.col("p_size").cast("double"), u, 0.25).alias("depth"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, (l_quantity - 10)::DOUBLE AS temp, ((80 + l_tax * 100) * 1000)::DOUBLE AS pres, (l_discount / 10)::DOUBLE AS q, (l_quantity / 10)::DOUBLE AS u, (l_linenumber - 3)::DOUBLE AS v, ((l_orderkey % 9) * 100)::DOUBLE AS dsw, (250 + l_quantity)::DOUBLE AS dlw FROM lineitem),
y AS (SELECT *, CASE WHEN q > 0.02 THEN q / 1000.0 ELSE q END AS spfh, pres / 1000.0 AS kpa, sqrt(u ** 2 + v ** 2) * 4.87 / ln(67.8 * 10 - 5.42) AS u2, 0.6108 * exp((17.27 * temp) / (temp + 237.3)) AS es FROM x),
z AS (SELECT *, 0.000665 * kpa AS gamma, (spfh * kpa) / (0.622 + 0.378 * spfh) AS ea, (4098 * es) / (temp + 237.3) ** 2 AS delta, (1 - 0.23) * (dsw * 0.0036) + (dlw * 0.0036 - 0.98 * (4.903e-9 / 24.0) * (temp + 273.15) ** 4) AS rn FROM y),
n AS (SELECT *, CASE WHEN rn > 0 THEN 0.1 * rn ELSE 0.5 * rn END AS gr, CASE WHEN rn > 0 THEN 0.24 ELSE 0.96 END AS cd FROM z)
SELECT l_orderkey, l_linenumber::BIGINT AS line, round(greatest((0.408 * delta * (rn - gr) + gamma * (37.0 / (temp + 273.15)) * u2 * (es - ea)) / (delta + gamma * (1 + cd * u2)), 0.0), 5)::DOUBLE AS et FROM n""")
def evapotranspiration(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    q, d = F.col("l_quantity").cast("double"), lambda c: c.cast("double")
    et = physics.hourly_reference_et(q - 10, d((80 + F.col("l_tax") * 100) * 1000), d(F.col("l_discount") / 10), q / 10, d(F.col("l_linenumber") - 3), d((F.col("l_orderkey") % 9) * 100), 250 + q)
    return li.select("l_orderkey", big("l_linenumber").alias("line"), r(et, 5).alias("et"))


@query("""SELECT event_type, count(*)::BIGINT AS n, sum(try_cast(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k, count(*) FILTER (json_extract_string(props, '$.k') IS NULL)::BIGINT AS missing FROM events GROUP BY 1""")
def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    k = F.from_json("props", "k STRING")["k"]
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k.try_cast("bigint")).alias("k"), F.count_if(k.isNull()).alias("missing"))


@query("""
SELECT cell_id, array_to_string(list_sort(list(product || ':' || n)), ';') AS counts, sum(n)::BIGINT AS n FROM (SELECT cell_id, coalesce(product, '?') AS product, count(*)::BIGINT AS n FROM precip_scans GROUP BY 1, 2) GROUP BY 1""")
def product_counters(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "precip_scans").groupBy("cell_id", F.coalesce("product", F.lit("?")).alias("product")).agg(F.count("*").alias("n"))
    m = c.groupBy("cell_id").agg(F.map_from_entries(F.collect_list(F.struct("product", "n"))).alias("m"), F.sum("n").alias("n"))
    return m.select("cell_id", F.array_join(F.array_sort(F.transform(F.map_entries("m"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))), ";").alias("counts"), "n")


# --- time series -----------------------------------------------------------------------------------------------------------

_HOURLY = """h AS (SELECT cell_id, time_bucket(INTERVAL 1 HOUR, time) AS hour, round(sum(precip_rate::DOUBLE), 2) AS v FROM precip_scans WHERE precip_rate >= 0 AND precip_rate < 1000 GROUP BY 1, 2)"""


def _hourly(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "precip_scans").filter((F.col("precip_rate") >= 0) & (F.col("precip_rate") < 1000))
    return p.groupBy("cell_id", times.floor_to(F.col("time"), 3600).alias("hour")).agg(F.round(F.sum(F.col("precip_rate").cast("double")), 2).alias("v"))


@query("""
WITH b AS (SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS t, max(value) AS v FROM events GROUP BY 1, 2), e AS (SELECT user_id, unnest(generate_series(min(t), max(t), INTERVAL 6 HOUR)) AS t FROM b GROUP BY 1)
SELECT e.user_id, e.t AS step_start, b.v AS top FROM e LEFT JOIN b ON b.user_id = e.user_id AND b.t = e.t""")
def resample_max_dense(spark: SparkSession, sf: str) -> DataFrame:
    return series.resample(table(spark, sf, "events"), "user_id", "ts", 6 * 3600, {"top": F.max("value")})


@query("""
WITH b AS (SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS t, min_by(value, (ts, event_id)) AS v FROM events WHERE value IS NOT NULL GROUP BY 1, 2), e AS (SELECT user_id, unnest(generate_series(min(t), max(t), INTERVAL 6 HOUR)) AS t FROM b GROUP BY 1)
SELECT e.user_id, e.t AS step_start, last_value(b.v IGNORE NULLS) OVER (PARTITION BY e.user_id ORDER BY e.t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM e LEFT JOIN b ON b.user_id = e.user_id AND b.t = e.t""")
def resample_first_filled(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").filter("value IS NOT NULL")
    d = series.resample(e, "user_id", "ts", 6 * 3600, {"first": F.min_by("value", F.struct("ts", "event_id"))})
    return series.fill_forward(d, "user_id", "step_start", "first", "v").select("user_id", "step_start", "v")


@query("""SELECT cell_id, time_bucket(INTERVAL 15 MINUTE, time) AS step_start, count(*)::BIGINT AS n, round(avg(precip_rate::DOUBLE) * 0.25, 4) AS depth FROM precip_scans WHERE precip_rate >= 0 AND isfinite(precip_rate) GROUP BY 1, 2""")
def resample_mean_depth(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "precip_scans").filter(usable(F.col("precip_rate")))
    return series.resample(p, "cell_id", "time", 900, {"n": F.count("*"), "depth": F.round(F.avg(F.col("precip_rate").cast("double")) * 0.25, 4)}, dense=False)


@query(f"""WITH {_HOURLY} SELECT cell_id, hour, v AS s1, round(sum(v) OVER (w RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW), 2) AS s3, round(sum(v) OVER (w RANGE BETWEEN INTERVAL 5 HOUR PRECEDING AND CURRENT ROW), 2) AS s6
FROM h WINDOW w AS (PARTITION BY cell_id ORDER BY hour)""")
def rolling_1_3_6h(spark: SparkSession, sf: str) -> DataFrame:
    d = series.rolling_sums(_hourly(spark, sf), "cell_id", "hour", "v", (1, 3, 6))
    return d.select("cell_id", "hour", r("s1", 2).alias("s1"), r("s3", 2).alias("s3"), r("s6", 2).alias("s6"))


@query(f"""WITH {_HOURLY} SELECT cell_id, max(v) AS peak, min(hour) FILTER (v = m) AS peak_hour FROM (SELECT *, max(v) OVER (PARTITION BY cell_id) AS m FROM h) GROUP BY 1""")
def rolling_peak_hour(spark: SparkSession, sf: str) -> DataFrame:
    return series.rolling_peak(_hourly(spark, sf), "cell_id", "hour", "v")


@query(f"""WITH {_HOURLY} SELECT cell_id, hour, round(c, 4) AS covered, CASE WHEN c >= 0.8 THEN round(t, 2) END AS total FROM (SELECT cell_id, hour, count(v) OVER w / 6.0 AS c, sum(v) OVER w AS t FROM h
WINDOW w AS (PARTITION BY cell_id ORDER BY hour RANGE BETWEEN INTERVAL 5 HOUR PRECEDING AND CURRENT ROW))""")
def rolling_total_covered(spark: SparkSession, sf: str) -> DataFrame:
    d = series.rolling_coverage(_hourly(spark, sf), "cell_id", "hour", "v", 6, 0.8)
    return d.select("cell_id", "hour", r("covered").alias("covered"), r("total", 2).alias("total"))


@query("""SELECT event_id, user_id, round(100.0 * row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) / (count(*) OVER (PARTITION BY user_id) + 1), 6)::DOUBLE AS exceedance FROM events WHERE value > 0""")
def flow_exceedance(spark: SparkSession, sf: str) -> DataFrame:
    return series.exceedance(table(spark, sf, "events"), "user_id", "value", "event_id").select("event_id", "user_id", r("exceedance", 6).alias("exceedance"))


@query("""
WITH e AS (SELECT user_id, value AS v, 100.0 * row_number() OVER w / (count(*) OVER (PARTITION BY user_id) + 1) AS x FROM events WHERE value > 0 WINDOW w AS (PARTITION BY user_id ORDER BY value DESC, event_id)),
n AS (SELECT *, lead(x) OVER w AS x2, lead(v) OVER w AS v2, lag(x) OVER w AS x0 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY x))
SELECT user_id, round(CASE WHEN x <= 25 AND x2 > 25 THEN v + (v2 - v) * (25 - x) / (x2 - x) ELSE v END, 6)::DOUBLE AS q FROM n WHERE (x <= 25 AND x2 > 25) OR (x0 IS NULL AND x > 25) OR (x2 IS NULL AND x <= 25)""")
def flow_quantile(spark: SparkSession, sf: str) -> DataFrame:
    return series.value_at_exceedance(table(spark, sf, "events"), "user_id", "value", "event_id", 25.0).select("user_id", r("q", 6).alias("q"))


_SESSION = """s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS session FROM
(SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 7 HOUR THEN 0 ELSE 1 END AS n FROM events))"""


@query(f"WITH {_SESSION} SELECT user_id, session, count(*)::BIGINT AS n, min(ts) AS first_ts, max(ts) AS last_ts, round(sum(value), 4) AS total FROM s GROUP BY 1, 2")
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    s = series.sessions(table(spark, sf, "events"), "user_id", "ts", 7 * 3600)
    return s.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), r(F.sum("value")).alias("total"))


@query(f"""
WITH {_SESSION}, d AS (SELECT DISTINCT ON (user_id, session, ts) * FROM s WHERE value IS NOT NULL ORDER BY user_id, session, ts, event_id),
l AS (SELECT *, lag(value) OVER w AS q0, epoch_us(ts) / 1e6 AS t, lag(epoch_us(ts) / 1e6) OVER w AS t0, max(value) OVER (PARTITION BY user_id, session) AS m FROM d WINDOW w AS (PARTITION BY user_id, session ORDER BY ts))
SELECT user_id, session, count(*)::BIGINT AS n, round(coalesce(sum((value + q0) / 2 * (t - t0)), 0) / 43560, 6) AS volume, round(coalesce(sum(abs(value - q0)), 0) / nullif(greatest(sum(value), 0), 0), 6) AS flashiness,
 max(value) AS peak, min(ts) FILTER (value = m) AS peak_time, round((min(t) FILTER (value = m) - min(t)) / 3600, 6) AS hours_to_peak FROM l GROUP BY 1, 2""")
def hydrographs(spark: SparkSession, sf: str) -> DataFrame:
    """Volume, flashiness and peak of each session; of readings at one time the first counts."""
    s = series.sessions(table(spark, sf, "events"), "user_id", "ts", 7 * 3600).filter("value IS NOT NULL")
    d = s.groupBy("user_id", "session", "ts").agg(F.min_by("value", "event_id").alias("value"))
    h = series.hydrograph_metrics(d, ["user_id", "session"], "ts", "value")
    return h.select("user_id", "session", "n", r("volume_acreft", 6).alias("volume"), r("flashiness", 6).alias("flashiness"), "peak", "peak_time", r("hours_to_peak", 6).alias("hours_to_peak"))


@query("SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) * 7 // count(*) OVER ())::BIGINT AS shard FROM orders")
def time_shards(spark: SparkSession, sf: str) -> DataFrame:
    return series.shard(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 7).select("o_orderkey", "shard")


@query("""
SELECT storm_index, size, (sum(size) OVER (ORDER BY storm_index) - size)::BIGINT AS start, (sum(size) OVER (ORDER BY storm_index))::BIGINT AS stop FROM (SELECT storm_index, sum(datediff('minute', win_start, win_end) // 15)::BIGINT AS size FROM (SELECT DISTINCT * FROM event_windows) GROUP BY 1)""")
def packed_offsets(spark: SparkSession, sf: str) -> DataFrame:
    w = table(spark, sf, "event_windows").distinct()
    n = F.floor((times.micros(F.col("win_end")) - times.micros(F.col("win_start"))) / F.lit(900_000_000))
    return series.offsets(w.groupBy("storm_index").agg(F.sum(n).alias("size")), "storm_index", "size").select("storm_index", "size", "start", "stop")


# --- joins -----------------------------------------------------------------------------------------------------------------


@query("""
WITH r AS (SELECT event_id AS report_id, ts AS t, CASE WHEN user_id % 7 = 0 THEN '' ELSE (user_id % 50)::VARCHAR END AS county, (user_id % 60)::DOUBLE AS lat, (user_id % 90)::DOUBLE AS lon FROM events WHERE event_type = 'error'),
e AS (SELECT event_id AS episode_id, ts AS t0, ts + INTERVAL 1 HOUR AS t1, [(user_id % 50)::VARCHAR, ((user_id + 1) % 50)::VARCHAR] AS counties, user_id % 60 - 1 AS a, user_id % 90 - 1 AS b, user_id % 60 + 1 AS c, user_id % 90 + 1 AS d FROM events WHERE event_type = 'purchase')
SELECT DISTINCT report_id, episode_id FROM r JOIN e ON r.t BETWEEN e.t0 - INTERVAL 3 HOUR AND e.t1 + INTERVAL 6 HOUR
WHERE (county <> '' AND list_contains(counties, county)) OR (county = '' AND lat BETWEEN a - 0.25 AND c + 0.25 AND lon BETWEEN b - 0.25 AND d + 0.25)""")
def interval_set_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Reports in the time window and one of the counties of episodes, or in their box where a report has no county."""
    e, u = table(spark, sf, "events"), F.col("user_id")
    county = F.when(u % 7 == 0, "").otherwise((u % 50).cast("string"))
    rep = e.filter("event_type = 'error'").select(F.col("event_id").alias("report_id"), F.col("ts").alias("t"), county.alias("county"), (u % 60).cast("double").alias("lat"), (u % 90).cast("double").alias("lon"))
    box = F.struct((u % 60 - 1).cast("double").alias("min_lat"), (u % 90 - 1).cast("double").alias("min_lon"), (u % 60 + 1).cast("double").alias("max_lat"), (u % 90 + 1).cast("double").alias("max_lon"))
    ep = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("episode_id"), F.col("ts").alias("t0"), (F.col("ts") + F.expr("INTERVAL '1' HOUR")).alias("t1"), F.array((u % 50).cast("string"), ((u + 1) % 50).cast("string")).alias("counties"), box.alias("box"))
    return matching.interval_set_match(rep, ep)


@query("""
WITH w AS (SELECT DISTINCT storm_index, cell_id, win_start FROM event_windows), j AS (SELECT w.storm_index, w.cell_id, w.win_start, p.time, p.obs_id, row_number() OVER (PARTITION BY w.storm_index, w.cell_id, w.win_start ORDER BY abs(epoch_us(p.time) - epoch_us(w.win_start)), p.time, p.obs_id) AS k
 FROM w JOIN precip_scans p ON p.cell_id = w.cell_id AND p.time BETWEEN w.win_start - INTERVAL 10 MINUTE AND w.win_start + INTERVAL 10 MINUTE)
SELECT w.storm_index, w.cell_id, w.win_start, j.obs_id AS nearest_obs_id FROM w LEFT JOIN j ON j.storm_index = w.storm_index AND j.cell_id = w.cell_id AND j.win_start = w.win_start AND j.k = 1""")
def nearest_scan(spark: SparkSession, sf: str) -> DataFrame:
    w = table(spark, sf, "event_windows").select("storm_index", "cell_id", "win_start").distinct()
    return matching.nearest_in_time(w, table(spark, sf, "precip_scans"), "cell_id", "win_start", "time", 600, ["obs_id"])


@query("""
SELECT hour, count(*)::BIGINT AS active FROM (SELECT unnest(generate_series(time_bucket(INTERVAL 1 HOUR, win_start) - INTERVAL 5 HOUR, time_bucket(INTERVAL 1 HOUR, win_end) + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour FROM (SELECT DISTINCT * FROM event_windows)) GROUP BY 1""")
def active_hours(spark: SparkSession, sf: str) -> DataFrame:
    h = matching.hours_touched(table(spark, sf, "event_windows").distinct(), "win_start", "win_end", 5, 1)
    return h.groupBy("hour").agg(F.count("*").alias("active"))


@query("""
SELECT p.event_id, v.value AS last_view FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' AND value IS NOT NULL GROUP BY 1, 2) v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def as_of_view(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    p, v = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.filter("event_type = 'view'").select("user_id", "ts", "value")
    return matching.as_of(p, v, "user_id", "ts", "ts", "value", "last_view").select("event_id", "last_view")


@query("""
SELECT 'semi' AS kind, count(*)::BIGINT AS n, sum(c_custkey)::BIGINT AS keys FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'anti', count(*)::BIGINT, sum(c_custkey)::BIGINT FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'both', count(*)::BIGINT, sum(k)::BIGINT FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'either', count(*)::BIGINT, sum(k)::BIGINT FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)""")
def set_operations(spark: SparkSession, sf: str) -> DataFrame:
    c, o, s = (table(spark, sf, t) for t in ("customer", "orders", "supplier"))
    on = c.c_custkey == o.o_custkey
    a, b = c.select(F.col("c_nationkey").alias("k")), s.select(F.col("s_nationkey").alias("k"))
    parts = {"semi": c.join(o, on, "left_semi").select(F.col("c_custkey").alias("k")), "anti": c.join(o, on, "left_anti").select(F.col("c_custkey").alias("k")), "both": a.intersect(b), "either": a.union(b).distinct()}
    out = [d.agg(F.count("*").alias("n"), F.sum("k").cast("bigint").alias("keys")).select(F.lit(n).alias("kind"), "n", "keys") for n, d in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("SELECT coalesce(n_nationkey, k)::BIGINT AS key, n_name AS name, n AS customers FROM nation FULL JOIN (SELECT c_nationkey + 5 AS k, count(*)::BIGINT AS n FROM customer GROUP BY 1) ON k = n_nationkey")
def outer_upsert(spark: SparkSession, sf: str) -> DataFrame:
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer").groupBy((F.col("c_nationkey") + 5).alias("k")).agg(F.count("*").alias("customers"))
    return n.join(c, n.n_nationkey == c.k, "full").select(big(F.coalesce("n_nationkey", "k")).alias("key"), F.col("n_name").alias("name"), "customers")


@query("""
SELECT doc_id, repo, commit_sha FROM (SELECT doc_id, repo, commit_sha, row_number() OVER (PARTITION BY repo, commit_sha ORDER BY ingested_at NULLS FIRST, doc_id) AS k FROM documents) WHERE k = 1""")
def first_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """The first row of each key, by partial minima before the shuffle."""
    d = table(spark, sf, "documents").groupBy("repo", "commit_sha").agg(F.min(F.struct("ingested_at", "doc_id")).alias("m"))
    return d.select("m.doc_id", "repo", "commit_sha")


@query("""
WITH a AS (SELECT cell_id, time_bucket(INTERVAL 15 MINUTE, time) AS t, avg(precip_rate::DOUBLE) AS v FROM precip_scans WHERE precip_rate >= 0 AND isfinite(precip_rate) AND source = 'aws' GROUP BY 1, 2),
b AS (SELECT cell_id, time_bucket(INTERVAL 15 MINUTE, time) AS t, avg(precip_rate::DOUBLE) AS v FROM precip_scans WHERE precip_rate >= 0 AND isfinite(precip_rate) AND source = 'isu' GROUP BY 1, 2)
SELECT coalesce(a.cell_id, b.cell_id) AS cell_id, coalesce(a.t, b.t) AS step_start, round(coalesce(a.v, b.v), 4) AS rate, CASE WHEN a.v IS NULL THEN 'isu' ELSE 'aws' END AS source FROM a FULL JOIN b ON a.cell_id = b.cell_id AND a.t = b.t""")
def product_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The preferred source where it has the step, else the other one: one conditional aggregation, no join."""
    p = table(spark, sf, "precip_scans").filter(usable(F.col("precip_rate")) & F.col("source").isin("aws", "isu"))
    v = F.col("precip_rate").cast("double")
    g = series.resample(p, "cell_id", "time", 900, {s: F.avg(F.when(F.col("source") == s, v)) for s in ("aws", "isu")}, dense=False)
    return g.select("cell_id", "step_start", r(F.coalesce("aws", "isu")).alias("rate"), F.when(F.col("aws").isNull(), "isu").otherwise("aws").alias("source"))


# --- grids and areas -------------------------------------------------------------------------------------------------------

_CELLS = """c AS (SELECT *, cell_id // 7000 AS row, cell_id % 7000 AS col, pow(111.32 * 0.01, 2) * cos(radians(55 - (cell_id // 7000 + 0.5) * 0.01)) AS w, (cell_id // 7000) // 500 AS zone, time_bucket(INTERVAL 1 HOUR, time) AS hour,
 CASE WHEN precip_rate >= 0 AND isfinite(precip_rate) THEN precip_rate::DOUBLE END AS v FROM precip_scans)"""


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    cell = F.col("cell_id")
    d = table(spark, sf, "precip_scans").withColumns({"row": geo.cell_row(cell), "col": geo.cell_column(cell), "w": geo.cell_km2(geo.cell_lat(cell)), "hour": times.floor_to(F.col("time"), 3600), "v": zonal.present(F.col("precip_rate"))})
    return d.withColumn("zone", big(F.floor(F.col("row") / 500)))


@query(f"WITH {_CELLS} SELECT zone, hour, round(sum(w * v) / nullif(sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END), 0), 5) AS mean FROM c GROUP BY 1, 2")
def area_weighted_mean(spark: SparkSession, sf: str) -> DataFrame:
    return zonal.area_mean(_cells(spark, sf), ["zone", "hour"], F.col("v"), F.col("w")).select("zone", "hour", r("mean", 5).alias("mean"))


@query(f"WITH {_CELLS} SELECT zone, round(sum(w * v) / nullif(sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END), 0), 5) AS mean, max(v) AS top, " + ", ".join(f"round(sum(CASE WHEN v >= {t} THEN w ELSE 0 END) / sum(w), 6) AS cov{t}" for t in (1, 2, 5, 10, 25, 50, 100)) + " FROM c GROUP BY 1")
def threshold_coverage(spark: SparkSession, sf: str) -> DataFrame:
    ts = (1, 2, 5, 10, 25, 50, 100)
    d = zonal.coverage(_cells(spark, sf), ["zone"], F.col("v"), F.col("w"), ts)
    return d.select("zone", r("mean", 5).alias("mean"), F.col("max").alias("top"), *[r(F.col("cov")[i], 6).alias(f"cov{t}") for i, t in enumerate(ts)])


@query(f"WITH {_CELLS} SELECT zone, round(sum(w * v) / nullif(sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END), 0), 5) AS mean, min(v) AS low, max(v) AS top, round(sum(CASE WHEN v >= 5 THEN w ELSE 0 END) / nullif(sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END), 0), 6) AS share, round(sum(CASE WHEN v IS NOT NULL THEN w ELSE 0 END) / sum(w), 6) AS valid FROM c GROUP BY 1")
def zonal_statistics(spark: SparkSession, sf: str) -> DataFrame:
    d = zonal.zonal(_cells(spark, sf), ["zone"], F.col("v"), F.col("w"), 5.0)
    return d.select("zone", r("mean", 5).alias("mean"), F.col("min").alias("low"), F.col("max").alias("top"), r("share", 6).alias("share"), r("valid", 6).alias("valid"))


@query(f"WITH {_HOURLY} SELECT cell_id FROM h GROUP BY 1 HAVING count(*) FILTER (v > 100) >= 4 OR count(*) FILTER (v > 150) >= 3")
def hot_cells(spark: SparkSession, sf: str) -> DataFrame:
    return zonal.hot_cells(_hourly(spark, sf), ["cell_id"], "v")


@query("SELECT DISTINCT cell_id, cell_id // 7000 AS row, cell_id % 7000 AS col, round(55 - (cell_id // 7000 + 0.5) * 0.01, 6)::DOUBLE AS lat, round(-130 + (cell_id % 7000 + 0.5) * 0.01, 6)::DOUBLE AS lon FROM precip_scans WHERE cell_id IS NOT NULL")
def cell_positions(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "precip_scans").select("cell_id").distinct().filter("cell_id IS NOT NULL")
    i = F.col("cell_id")
    return c.select("cell_id", geo.cell_row(i).alias("row"), geo.cell_column(i).alias("col"), r(geo.cell_lat(i), 6).alias("lat"), r(geo.cell_lon(i), 6).alias("lon"))


@query("""
WITH g AS (SELECT DISTINCT STAID, LAT_GAGE AS la, LNG_GAGE AS lo FROM gages WHERE LAT_GAGE IS NOT NULL AND NOT isnan(LAT_GAGE) AND abs(LAT_GAGE) <= 90), b AS (SELECT STAID, floor((55 - la) / 0.01)::BIGINT AS r, floor((lo + 130) / 0.01)::BIGINT AS c FROM g WHERE la <= 55 AND la > 20 AND lo >= -130 AND lo < -60)
SELECT STAID, (r + dr) * 7000 + c + dc AS cell FROM b, (SELECT unnest(range(-2, 3)) AS dr), (SELECT unnest(range(-2, 3)) AS dc) WHERE r + dr BETWEEN 0 AND 3499 AND c + dc BETWEEN 0 AND 6999 GROUP BY 1, 2""")
def cell_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 x 5 cells around each gage."""
    g = table(spark, sf, "gages").filter("NOT isnan(LAT_GAGE) AND LAT_GAGE > 20 AND LAT_GAGE <= 55 AND LNG_GAGE >= -130 AND LNG_GAGE < -60").select("STAID", F.floor((55 - F.col("LAT_GAGE")) / 0.01).alias("r"), F.floor((F.col("LNG_GAGE") + 130) / 0.01).alias("c")).distinct()
    g = g.withColumn("r", F.explode(F.expr("sequence(r - 2, r + 2)"))).withColumn("c", F.explode(F.expr("sequence(c - 2, c + 2)"))).filter("r BETWEEN 0 AND 3499 AND c BETWEEN 0 AND 6999")
    return g.select("STAID", (F.col("r") * 7000 + F.col("c")).alias("cell")).distinct()


@query("""
WITH e AS (SELECT huc8, r[i].x AS x1, r[i].y AS y1, r[i + 1].x AS x2, r[i + 1].y AS y2 FROM (SELECT huc8, r, unnest(range(1, len(r))) AS i FROM (SELECT huc8, unnest(rings) AS r FROM huc8_units)))
SELECT l.lsr_id AS lsr_id, e.huc8 FROM lsrs l JOIN e ON (e.x1 <= l.lon) <> (e.x2 <= l.lon) WHERE e.y1 + (l.lon - e.x1) * (e.y2 - e.y1) / (e.x2 - e.x1) > l.lat GROUP BY 1, 2 HAVING count(*) % 2 = 1""")
def reports_in_units(spark: SparkSession, sf: str) -> DataFrame:
    d = nearby.containing(table(spark, sf, "lsrs"), table(spark, sf, "huc8_units"), ("lsr_id", "lat", "lon"), "huc8", "rings")
    return d.select(F.col("left_key").alias("lsr_id"), F.col("region").alias("huc8"))


_NEAREST = """
WITH e AS (SELECT huc8, r[i].x AS ax, r[i].y AS ay, r[i + 1].x AS bx, r[i + 1].y AS by_ FROM (SELECT huc8, r, unnest(range(1, len(r))) AS i FROM (SELECT huc8, unnest(rings) AS r FROM huc8_units))),
o AS (SELECT *, ax < bx OR (ax = bx AND ay <= by_) AS on_ FROM e), s AS (SELECT DISTINCT huc8, CASE WHEN on_ THEN ax ELSE bx END AS x1, CASE WHEN on_ THEN ay ELSE by_ END AS y1, CASE WHEN on_ THEN bx ELSE ax END AS x2, CASE WHEN on_ THEN by_ ELSE ay END AS y2 FROM o),
g AS (SELECT DISTINCT STAID, LNG_GAGE AS x, LAT_GAGE AS y FROM gages), q AS (SELECT DISTINCT x, y FROM g WHERE NOT isnan(x) AND NOT isnan(y) AND abs(y) <= 90 AND abs(x) <= 180 AND NOT (x = 0 AND y = 0)),
d AS (SELECT x, y, huc8, x1, y1, x2, y2, least(greatest(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / nullif((x2 - x1) ** 2 + (y2 - y1) ** 2, 0), 0), 1) AS t FROM q, s),
m AS (SELECT x, y, huc8, min(round(sqrt((x - (x1 + t * (x2 - x1))) ** 2 + (y - (y1 + t * (y2 - y1))) ** 2), 8)) AS distance FROM d GROUP BY 1, 2, 3),
n AS (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY distance, huc8) AS k FROM m)
SELECT g.STAID AS point_id, n.huc8 AS line_id, n.distance FROM g LEFT JOIN n ON n.x = g.x AND n.y = g.y AND n.k = 1"""


@query(f"SELECT point_id, distance FROM ({_NEAREST}) WHERE distance IS NOT NULL")
def nearest_outline(spark: SparkSession, sf: str) -> DataFrame:
    """The distance in degrees from each gage with a place to the nearest unit's outline, however far."""
    return nearest_outline_all(spark, sf).filter("distance IS NOT NULL").select("point_id", "distance")


@query(_NEAREST)
def nearest_outline_all(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest unit's outline and its distance in degrees for each gage and place, however far; nulls for gages without a place."""
    at = lambda k: F.struct(F.col("r")[k]["x"].alias("x"), F.col("r")[k]["y"].alias("y"))
    ring = table(spark, sf, "huc8_units").select(F.col("huc8").alias("line_id"), F.explode("rings").alias("r")).filter("size(r) > 1")
    ends = ring.withColumn("i", F.explode(F.expr("sequence(1, size(r) - 1)"))).select("line_id", at(F.col("i") - 1).alias("a"), at(F.col("i")).alias("b"))
    # both sides of a border run the same way, so their distances are equal
    e = ends.select("line_id", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().select("line_id", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))
    g = table(spark, sf, "gages").select("STAID", "LNG_GAGE", "LAT_GAGE").distinct()
    placed = nearby.has_place(F.col("LAT_GAGE"), F.col("LNG_GAGE"))
    p = g.select(F.col("STAID").alias("point_id"), F.when(placed, F.col("LNG_GAGE")).alias("x"), F.when(placed, F.col("LAT_GAGE")).alias("y"))
    return geometry.nearest_line_all(p, e, 1.0).select("point_id", "line_id", r("distance", 8).alias("distance"))


@query("""
SELECT a.STAID AS a, b.STAID AS b, round(2 * 6371 * asin(sqrt(least(pow(sin(radians(b.LAT_GAGE - a.LAT_GAGE) / 2), 2) + cos(radians(a.LAT_GAGE)) * cos(radians(b.LAT_GAGE)) * pow(sin(radians(b.LNG_GAGE - a.LNG_GAGE) / 2), 2), 1))), 4) AS km
FROM (SELECT DISTINCT STAID, LAT_GAGE, LNG_GAGE FROM gages WHERE NOT isnan(LAT_GAGE) AND abs(LAT_GAGE) <= 90 AND abs(LNG_GAGE) <= 180 AND NOT (LAT_GAGE = 0 AND LNG_GAGE = 0)) a
JOIN (SELECT DISTINCT STAID, LAT_GAGE, LNG_GAGE FROM gages WHERE NOT isnan(LAT_GAGE) AND abs(LAT_GAGE) <= 90 AND abs(LNG_GAGE) <= 180 AND NOT (LAT_GAGE = 0 AND LNG_GAGE = 0)) b
ON a.STAID < b.STAID AND abs(a.LAT_GAGE - b.LAT_GAGE) < 0.2 WHERE 2 * 6371 * asin(sqrt(least(pow(sin(radians(b.LAT_GAGE - a.LAT_GAGE) / 2), 2) + cos(radians(a.LAT_GAGE)) * cos(radians(b.LAT_GAGE)) * pow(sin(radians(b.LNG_GAGE - a.LNG_GAGE) / 2), 2), 1))) <= 15""")
def gages_nearby(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "gages")
    at = ("STAID", "LAT_GAGE", "LNG_GAGE")
    return nearby.near(g, g, 15.0, at, at).filter("left_key < right_key").select(F.col("left_key").alias("a"), F.col("right_key").alias("b"), r("km").alias("km"))


@query("""
WITH k AS (SELECT 6378137.0::DOUBLE AS a, sqrt(2 / 298.257222101 - pow(1 / 298.257222101, 2))::DOUBLE AS e), s AS (SELECT *, sin(radians(29.5)) AS s1, sin(radians(45.5)) AS s2, sin(radians(23)) AS s0 FROM k),
q AS (SELECT a, e, cos(radians(29.5)) / sqrt(1 - pow(e * s1, 2)) AS m1, cos(radians(45.5)) / sqrt(1 - pow(e * s2, 2)) AS m2, (1 - e * e) * (s1 / (1 - pow(e * s1, 2)) - ln((1 - e * s1) / (1 + e * s1)) / (2 * e)) AS q1,
 (1 - e * e) * (s2 / (1 - pow(e * s2, 2)) - ln((1 - e * s2) / (1 + e * s2)) / (2 * e)) AS q2, (1 - e * e) * (s0 / (1 - pow(e * s0, 2)) - ln((1 - e * s0) / (1 + e * s0)) / (2 * e)) AS q0 FROM s),
n AS (SELECT *, (m1 * m1 - m2 * m2) / (q2 - q1) AS n FROM q), c AS (SELECT *, m1 * m1 + n * q1 AS c FROM n),
g AS (SELECT DISTINCT STAID, sin(radians(LAT_GAGE)) AS sl, radians(LNG_GAGE + 96) AS d FROM gages WHERE NOT isnan(LAT_GAGE) AND NOT isnan(LNG_GAGE) AND abs(LAT_GAGE) <= 90 AND abs(LNG_GAGE) <= 180 AND NOT (LAT_GAGE = 0 AND LNG_GAGE = 0)),
p AS (SELECT STAID, n * d AS th, a * sqrt(c.c - n * (1 - e * e) * (sl / (1 - pow(e * sl, 2)) - ln((1 - e * sl) / (1 + e * sl)) / (2 * e))) / n AS rho, a * sqrt(c.c - n * q0) / n AS rho0 FROM g, c)
SELECT DISTINCT STAID, round(rho * sin(th), 3) AS x, round(rho0 - rho * cos(th), 3) AS y FROM p""")
def equal_area_positions(spark: SparkSession, sf: str) -> DataFrame:
    x, y = geo.equal_area_xy(F.col("LAT_GAGE"), F.col("LNG_GAGE"))
    return table(spark, sf, "gages").filter(nearby.has_place(F.col("LAT_GAGE"), F.col("LNG_GAGE"))).select("STAID", r(x, 3).alias("x"), r(y, 3).alias("y")).distinct()


_ALBERS = """k AS (SELECT 6378137.0::DOUBLE AS a, sqrt(2 / 298.257222101 - pow(1 / 298.257222101, 2))::DOUBLE AS e), s_ AS (SELECT *, sin(radians(29.5)) AS s1, sin(radians(45.5)) AS s2, sin(radians(23)) AS s0 FROM k),
q_ AS (SELECT a, e, cos(radians(29.5)) / sqrt(1 - pow(e * s1, 2)) AS m1, cos(radians(45.5)) / sqrt(1 - pow(e * s2, 2)) AS m2, (1 - e * e) * (s1 / (1 - pow(e * s1, 2)) - ln((1 - e * s1) / (1 + e * s1)) / (2 * e)) AS q1,
 (1 - e * e) * (s2 / (1 - pow(e * s2, 2)) - ln((1 - e * s2) / (1 + e * s2)) / (2 * e)) AS q2, (1 - e * e) * (s0 / (1 - pow(e * s0, 2)) - ln((1 - e * s0) / (1 + e * s0)) / (2 * e)) AS q0 FROM s_),
c_ AS (SELECT a, e, q0, n, m1 * m1 + n * q1 AS c FROM (SELECT *, (m1 * m1 - m2 * m2) / (q2 - q1) AS n FROM q_))"""


@query(f"""
WITH {_ALBERS}, u AS (SELECT DISTINCT huc8, rings FROM huc8_units), r AS (SELECT huc8, k, rings[k] AS r FROM (SELECT huc8, rings, unnest(range(1, len(rings) + 1)) AS k FROM u)),
v AS (SELECT huc8, k, i, r[i].x AS x, r[i].y AS y FROM (SELECT huc8, k, r, unnest(range(1, len(r) + 1)) AS i FROM r WHERE len(r) > 3)),
m AS (SELECT huc8, k, i, rho * sin(th) AS px, -rho * cos(th) AS py FROM (SELECT v.*, n * radians(x + 96) AS th, a * sqrt(c - n * (1 - e * e) * (sin(radians(y)) / (1 - pow(e * sin(radians(y)), 2)) - ln((1 - e * sin(radians(y))) / (1 + e * sin(radians(y)))) / (2 * e))) / n AS rho FROM v, c_)),
t AS (SELECT p.huc8, p.k, abs(sum(p.px * q.py - q.px * p.py)) / 2 AS area FROM m p JOIN m q ON q.huc8 = p.huc8 AND q.k = p.k AND q.i = p.i + 1 GROUP BY 1, 2),
e1 AS (SELECT p.huc8, p.k, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2 FROM v p JOIN v q ON q.huc8 = p.huc8 AND q.k = p.k AND q.i = p.i + 1),
d AS (SELECT huc8, k, count(*) AS odd FROM (SELECT f.huc8, f.k, e1.k AS o FROM v f JOIN e1 ON e1.huc8 = f.huc8 AND e1.k <> f.k AND f.i = 1 AND (e1.x1 <= f.x) <> (e1.x2 <= f.x) WHERE e1.y1 + (f.x - e1.x1) * (e1.y2 - e1.y1) / (e1.x2 - e1.x1) > f.y GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1) GROUP BY 1, 2)
SELECT t.huc8 AS region, round(sum(CASE WHEN coalesce(odd, 0) % 2 = 0 THEN area ELSE -area END) / 1e6, 3) AS km2 FROM t LEFT JOIN d ON d.huc8 = t.huc8 AND d.k = t.k GROUP BY 1""")
def unit_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of the units in the equal-area projection, holes taken off."""
    return _unit_areas(_projected(table(spark, sf, "huc8_units").select("huc8", "rings").dropDuplicates(["huc8"]))).select("region", r("km2", 3).alias("km2"))


def _projected(units: DataFrame, key: str = "huc8") -> DataFrame:
    return units.select(key, geo.projected(F.col("rings")).alias("rings"))


def _unit_areas(projected: DataFrame) -> DataFrame:
    return geometry.region_area(projected, "huc8", "rings").select("region", (F.col("area") / 1e6).alias("km2"))


@query()
def unit_cell_fractions(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of quarter-degree cells that each unit covers."""
    return geometry.cell_fractions(table(spark, sf, "huc8_units"), "huc8", "rings", 0.25)


# --- graphs and clusters ---------------------------------------------------------------------------------------------------


@query("""
WITH RECURSIVE n AS (SELECT p_partkey AS id, CASE WHEN p_partkey > 1 THEN p_partkey // 2 END AS up FROM part), w(id, a) AS (SELECT id, id FROM n UNION ALL SELECT w.id, n.up FROM w JOIN n ON n.id = w.a WHERE n.up IS NOT NULL)
SELECT a::VARCHAR AS id, id::VARCHAR AS descendant FROM w""")
def upstream_closure(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of a node and what lies under it, over a tree of the parts' keys."""
    n = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_partkey") > 1, F.expr("p_partkey div 2").cast("string")).alias("toid"))
    h = hierarchy.build_hierarchy(n)
    return hierarchy.descendants(h, n)


@query("""SELECT trim(a.id) AS up, trim(b.id) AS down, trim(b.toid) AS further FROM (SELECT DISTINCT trim(id) AS id, trim(toid) AS toid FROM network) a JOIN (SELECT DISTINCT trim(id) AS id, trim(toid) AS toid FROM network) b ON a.toid = b.id WHERE a.id LIKE 'wb-%'""")
def two_steps_down(spark: SparkSession, sf: str) -> DataFrame:
    """Waterbody to nexus to waterbody, as two equality joins."""
    n = table(spark, sf, "network").select(F.trim("id").alias("id"), F.trim("toid").alias("toid")).distinct()
    a, b = n.filter("id LIKE 'wb-%'").select(F.col("id").alias("up"), F.col("toid").alias("k")), n.select(F.col("id").alias("k"), F.col("toid").alias("further"))
    return a.join(b, "k").select("up", F.col("k").alias("down"), "further")


_LINKS = """p AS (SELECT min(event_id) AS id, water_year AS g, peak_time AS t, gage_lat AS y, gage_lon AS x FROM site_events WHERE gage_lat IS NOT NULL AND peak_time IS NOT NULL AND NOT isnan(gage_lat) GROUP BY 2, 3, 4, 5),
l AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.g = b.g AND a.id < b.id AND abs(epoch_us(a.t) - epoch_us(b.t)) <= 86400000000
 WHERE 2 * 6371 * asin(sqrt(least(pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2), 1))) <= 60)"""


@query(f"""
WITH RECURSIVE {_LINKS}, e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), w(s, v) AS (SELECT id, id FROM p UNION SELECT w.s, e.b FROM w JOIN e ON e.a = w.v)
SELECT s AS id, min(v) AS component FROM w GROUP BY 1""")
def report_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Flood peaks within a day and 60 km of each other, and of those linked in turn."""
    e = table(spark, sf, "site_events").filter("NOT isnan(gage_lat)")
    links = clusters.report_links(e, "water_year", "event_id", "peak_time", "gage_lat", "gage_lon", 24.0, 60.0)
    nodes = e.dropna(subset=["gage_lat", "peak_time"]).groupBy("water_year", "peak_time", "gage_lat", "gage_lon").agg(F.min("event_id").alias("id"))
    return clusters.components(nodes, links)


@query(f"""
WITH RECURSIVE {_LINKS}, e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), w(s, v) AS (SELECT id, id FROM p UNION SELECT w.s, e.b FROM w JOIN e ON e.a = w.v), c AS (SELECT s AS id, min(v) AS component FROM w GROUP BY 1)
SELECT component, count(*)::BIGINT AS n, min(p.t) AS begin_time, max(p.t) AS end_time, min(p.y) AS min_lat, max(p.y) AS max_lat FROM c JOIN p USING (id) GROUP BY 1""")
def cluster_rollup(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "site_events").filter("NOT isnan(gage_lat)")
    p = e.dropna(subset=["gage_lat", "peak_time"]).groupBy("water_year", "peak_time", "gage_lat", "gage_lon").agg(F.min("event_id").alias("id"))
    c = report_clusters(spark, sf).join(p, "id")
    return c.groupBy("component").agg(F.count("*").alias("n"), F.min("peak_time").alias("begin_time"), F.max("peak_time").alias("end_time"), F.min("gage_lat").alias("min_lat"), F.max("gage_lat").alias("max_lat"))


@query("""
WITH n AS (SELECT DISTINCT trim(id) AS id, trim(toid) AS toid FROM network), k AS (SELECT DISTINCT trim(id) AS id FROM network WHERE vpuid IN ('01', '02', '08'))
SELECT n.id AS up, n.toid AS down FROM n WHERE n.id IN (SELECT id FROM k) AND n.toid IN (SELECT id FROM k)""")
def induced_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Links whose two ends belong to the chosen regions."""
    n = table(spark, sf, "network").select(F.trim("id").alias("up"), F.trim("toid").alias("down"), "vpuid")
    k = n.filter(F.col("vpuid").isin("01", "02", "08")).select(F.col("up").alias("k")).distinct()
    return n.select("up", "down").distinct().join(k, F.col("up") == F.col("k"), "left_semi").join(k, F.col("down") == F.col("k"), "left_semi")


# --- storms ----------------------------------------------------------------------------------------------------------------


@query(f"""
WITH {_HOURLY}, w AS (SELECT DISTINCT storm_index, cell_id, time_bucket(INTERVAL 1 HOUR, win_start) AS t0, time_bucket(INTERVAL 1 HOUR, win_end) + INTERVAL 1 HOUR AS t1 FROM event_windows),
g AS (SELECT w.storm_index, w.t0, w.cell_id, unnest(generate_series(w.t0 - INTERVAL 5 HOUR, w.t1, INTERVAL 1 HOUR)) AS hour FROM w),
x AS (SELECT g.*, coalesce(h.v, 0) AS v FROM g LEFT JOIN h ON h.cell_id = g.cell_id AND h.hour = g.hour),
y AS (SELECT storm_index, t0, hour, v AS s1, round(sum(v) OVER (PARTITION BY storm_index ORDER BY hour ROWS 2 PRECEDING), 2) AS s3, round(sum(v) OVER (PARTITION BY storm_index ORDER BY hour ROWS 5 PRECEDING), 2) AS s6 FROM x),
z AS (SELECT *, max(s6) OVER (PARTITION BY storm_index) AS m6 FROM y WHERE hour >= t0)
SELECT storm_index, max(s1) AS max1, max(s3) AS max3, max(s6) AS max6, min(hour) FILTER (s6 = m6) AS hour6 FROM z GROUP BY 1""")
def storm_rain_peaks(spark: SparkSession, sf: str) -> DataFrame:
    """The highest 1, 3 and 6 hour sums in each storm's hours, looking back 5 hours; missing hours count as 0, the first hour of ties holds."""
    w = table(spark, sf, "event_windows").select("storm_index", "cell_id", "win_start", "win_end").distinct()
    g = matching.hours_touched(w, "win_start", "win_end", 5, 1).withColumn("t0", times.floor_to(F.col("win_start"), 3600))
    x = g.join(_hourly(spark, sf), ["cell_id", "hour"], "left")
    y = series.rolling_sums(x.withColumn("v", F.coalesce("v", F.lit(0.0))), "storm_index", "hour", "v", (1, 3, 6)).filter("hour >= t0")
    y = y.select("storm_index", "hour", "s1", r("s3", 2).alias("s3"), r("s6", 2).alias("s6"))
    return y.groupBy("storm_index").agg(F.max("s1").alias("max1"), F.max("s3").alias("max3"), F.max("s6").alias("max6"), F.min_by("hour", F.struct(-F.col("s6"), F.col("hour"))).alias("hour6"))


@query("""
WITH w AS (SELECT DISTINCT storm_index, cell_id, win_start, win_end FROM event_windows), s AS (SELECT storm_index, cell_id, unnest(generate_series(win_start, win_end - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS a FROM w),
g AS (SELECT cell_id, time_bucket(INTERVAL 15 MINUTE, time) AS a, count(*) AS n FROM precip_scans WHERE precip_rate >= 0 AND isfinite(precip_rate) GROUP BY 1, 2)
SELECT storm_index, count(*)::BIGINT AS steps, count(g.n)::BIGINT AS observed, sum(coalesce(g.n, 0))::BIGINT AS readings, count(g.n) >= 0.9 * count(*) AS passes,
 array_to_string(list(coalesce(g.n, 0)::VARCHAR ORDER BY s.a), ' ') AS packed FROM s LEFT JOIN g USING (cell_id, a) GROUP BY 1""")
def window_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Steps, observed steps and readings of each window, whether nine tenths are observed, and the counts packed in order."""
    d = problems.p3_series(spark, sf)
    g = d.groupBy("storm_index").agg(F.count("*").alias("steps"), F.count_if(F.col("n_readings") > 0).alias("observed"), F.sum("n_readings").alias("readings"), F.array_sort(F.collect_list(F.struct("step", "n_readings"))).alias("p"))
    packed = F.array_join(F.transform("p", lambda x: x["n_readings"].cast("string")), " ")
    return g.select("storm_index", "steps", "observed", "readings", (F.col("observed") >= 0.9 * F.col("steps")).alias("passes"), packed.alias("packed"))


@query()
def episode_footprints(spark: SparkSession, sf: str) -> DataFrame:
    """Units that half a degree around each episode's corner touches: shared km2 and share of the unit in the equal-area projection.

    A unit is kept if 1 percent of it or 10 km2 are touched, or if a report of the episode lies in it.
    """
    e = table(spark, sf, "episodes").select("episode_id", "min_lat", "min_lon").distinct().filter(nearby.has_place(F.col("min_lat"), F.col("min_lon")))
    at = lambda dx, dy: F.struct((F.col("min_lon") + dx).alias("x"), (F.col("min_lat") + dy).alias("y"))
    e = e.withColumn("rings", F.array(F.array(at(0, 0), at(0.5, 0), at(0.5, 0.5), at(0, 0.5), at(0, 0))))
    all_units = table(spark, sf, "huc8_units").select("huc8", "rings").dropDuplicates(["huc8"])
    units = _projected(all_units)
    o = geometry.overlaps(_projected(e, "episode_id"), units, ("episode_id", "rings"), ("huc8", "rings"), 100_000.0).withColumn("km2", F.col("area") / 1e6)
    a = _unit_areas(units).select(F.col("region").alias("right_key"), F.col("km2").alias("whole"))
    ls = table(spark, sf, "lsrs")
    reported = nearby.containing(ls, all_units, ("lsr_id", "lat", "lon"), "huc8", "rings").join(ls.select(F.col("lsr_id").alias("left_key"), "episode_id"), "left_key")
    reported = reported.groupBy("episode_id", F.col("region").alias("huc8")).agg(F.count("*").alias("n_lsr"))
    d = o.join(a, "right_key").select(F.col("left_key").alias("episode_id"), F.col("right_key").alias("huc8"), "km2", (F.col("km2") / F.col("whole")).alias("share"))
    d = d.join(reported, ["episode_id", "huc8"], "left").fillna(0, ["n_lsr"])
    kept = (F.col("share") >= 0.01) | (F.col("km2") >= 10) | (F.col("n_lsr") > 0)
    return d.select("episode_id", "huc8", r("km2", 1).alias("km2"), r("share", 4).alias("share"), "n_lsr", kept.cast("int").alias("kept"))


@query()
def simple_outlines(spark: SparkSession, sf: str) -> DataFrame:
    """Unit outlines with vertices left out that lie within a twentieth of a degree of the line kept."""
    return geometry.simplify(table(spark, sf, "huc8_units"), "huc8", "rings", 0.05)


@query("""
SELECT DISTINCT episode_id, states, damage_usd FROM episodes WHERE list_has_any(string_split(states, ','), ['TX', 'OK', 'CO']) AND damage_usd > 0 AND regexp_matches(lower(episode_narrative), 'rain|storm') AND min_lat BETWEEN 25 AND 45""")
def episode_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Any of some states, damage, a word in the narrative, and a range of latitudes."""
    e = table(spark, sf, "episodes")
    wanted = F.arrays_overlap(F.split("states", ","), F.array(*map(F.lit, ("TX", "OK", "CO")))) & (F.col("damage_usd") > 0)
    return e.filter(wanted & text.has_word(F.col("episode_narrative"), "rain|storm") & F.col("min_lat").between(25, 45)).select("episode_id", "states", "damage_usd").distinct()


# --- catalog ---------------------------------------------------------------------------------------------------------------


@query("""
SELECT episode_id, damage_usd, n_lsr::BIGINT AS n_lsr, row_number() OVER (ORDER BY coalesce(damage_usd, -1) DESC, episode_id)::BIGINT AS rank FROM (SELECT DISTINCT episode_id, damage_usd, n_lsr, fatalities FROM episodes) WHERE n_lsr >= 2 ORDER BY rank LIMIT 200""")
def catalog_top(spark: SparkSession, sf: str) -> DataFrame:
    """The report of the 200 costliest episodes with at least two reports."""
    e = table(spark, sf, "episodes").select("episode_id", "damage_usd", "n_lsr", "fatalities").distinct().filter(catalog.at_least({"n_lsr": 2, "fatalities": 0}))
    return catalog.top(e, "damage_usd", "episode_id", 200).select("episode_id", "damage_usd", big("n_lsr").alias("n_lsr"), "rank")


@query("""
SELECT 0::BIGINT AS stage, 'all' AS name, count(*)::BIGINT AS n FROM e UNION ALL SELECT 1, 'reported', count(*) FILTER (n_lsr > 0)::BIGINT FROM e UNION ALL SELECT 2, 'costly', count(*) FILTER (n_lsr > 0 AND damage_usd > 0)::BIGINT FROM e
UNION ALL SELECT 3, 'deadly', count(*) FILTER (n_lsr > 0 AND damage_usd > 0 AND fatalities > 0)::BIGINT FROM e""".replace(" FROM e", " FROM (SELECT DISTINCT episode_id, n_lsr, damage_usd, fatalities FROM episodes)"))
def episode_funnel(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "episodes").select("episode_id", "n_lsr", "damage_usd", "fatalities").distinct()
    return catalog.funnel(e, [("all", F.lit(True)), ("reported", F.col("n_lsr") > 0), ("costly", F.col("damage_usd") > 0), ("deadly", F.col("fatalities") > 0)])


@query("""
WITH v AS (SELECT c_acctbal AS v, row_number() OVER (ORDER BY c_acctbal) - 1 AS k, count(*) OVER () AS n FROM customer WHERE c_acctbal IS NOT NULL), q AS (SELECT unnest([0.3, 0.55, 0.75, 0.88, 0.96])::DOUBLE AS q)
SELECT q, v AS value FROM v, q WHERE k = least(floor(q * n), n - 1)""")
def class_breaks(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.class_breaks(table(spark, sf, "customer"), "c_acctbal", (0.3, 0.55, 0.75, 0.88, 0.96))


@query("""
SELECT c_mktsegment AS segment, CASE WHEN c_acctbal = 0 THEN 0 WHEN c_acctbal <= 1000 THEN 1 WHEN c_acctbal <= 5000 THEN 2 ELSE 3 END::BIGINT AS closed, CASE WHEN c_acctbal < 1000 THEN 1 WHEN c_acctbal < 5000 THEN 2 ELSE 3 END::BIGINT AS half_open, count(*)::BIGINT AS n FROM customer GROUP BY 1, 2, 3""")
def class_assign(spark: SparkSession, sf: str) -> DataFrame:
    """Classes with the upper bound inside (and zero apart), and with it outside."""
    v = F.col("c_acctbal")
    closed = F.when(v == 0, 0).when(v <= 1000, 1).when(v <= 5000, 2).otherwise(3)
    half = F.when(v < 1000, 1).when(v < 5000, 2).otherwise(3)
    return table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment"), big(closed).alias("closed"), big(half).alias("half_open")).agg(F.count("*").alias("n"))


@query()
def episode_json(spark: SparkSession, sf: str) -> DataFrame:
    """One nested document for each episode: totals and its clusters in order."""
    c = table(spark, sf, "storm_clusters").dropDuplicates().filter("episode_id IS NOT NULL")
    part = F.struct("cluster_id", "n_reports", "centroid_lat", "centroid_lon", "primary_state")
    g = c.groupBy("episode_id").agg(F.struct(F.sum("n_reports").alias("reports"), F.count("*").alias("clusters")).alias("totals"), F.array_sort(F.collect_list(part)).alias("clusters"))
    return g.select("episode_id", F.to_json(F.struct("episode_id", "totals", "clusters")).alias("doc"))
