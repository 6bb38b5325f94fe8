"""Mixed timestamp texts and zones to one UTC instant.

A text is brought to its parts by the first of a few patterns that fits, all in JVM expressions. A fixed offset (in the text, or in
the row's zone) gives the instant directly. A wall time in a zone with clock changes is looked up as of the zone's
offset intervals: for each zone and year that occurs, the offsets are sampled day by day, days with a change minute by
minute, and become intervals of local time. One interval around a wall time gives its offset; two mean that the time came twice, none
that it was skipped: in both cases there is no one instant.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.session import cut

# Zone letters of texts and their offsets from UTC in minutes.
ZONE_LETTERS = {
    "Z": 0, "UTC": 0, "GMT": 0,
    "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "AKST": -540, "AKDT": -480, "HST": -600, "HDT": -540, "SST": -660, "CHST": 600,
}
MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"

_ZONE = r"\s*([A-Za-z]+(?:/[A-Za-z0-9_+\-]+)*|[+-]\d{2}(?::?\d{2})?)?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?\s*(?:([AaPp])\.?[Mm]\.?(?![A-Za-z]))?"
#: Pattern, and its parts as year|month|day|hour|minute|second|half of the day|zone.
FORMATS = (
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[Tt ]\s*(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,]\d+)?)?)?)?" + _ZONE + "$", "$1|$2|$3|$4|$5|$6||$7"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})(?:\s+" + _CLOCK + ")?" + _ZONE + "$", "$3|$1|$2|$4|$5|$6|$7|$8"),
    (r"^(?:[A-Za-z]{3,9},\s*)?(\d{1,2})[- ]([A-Za-z]{3})[a-z]*[- ](\d{4}|\d{2})(?:\s+" + _CLOCK + ")?" + _ZONE + "$", "$3|$2|$1|$4|$5|$6|$7|$8"),
    (r"^(?:[A-Za-z]{3,9},\s*)?([A-Za-z]{3})[a-z]*\.? (\d{1,2}),? (\d{4})(?:,?\s+" + _CLOCK + ")?" + _ZONE + "$", "$3|$1|$2|$4|$5|$6|$7|$8"),
    (r"^(\d{4})(\d{2})(\d{2})(?:(\d{2})(\d{2})(\d{2})?)?$", "$1|$2|$3|$4|$5|$6||"),
)
_EPOCH = r"^(\d{10})(?:\d{3}|\d{6}|\.\d+)?$"


def _letters(c: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in ZONE_LETTERS.items() for x in kv]), F.upper(c))


def _signed(c: Column) -> Column:
    """Minutes of +HH, +HHMM or +HH:MM."""
    h, m = F.substring(c, 2, 2).try_cast("int"), F.coalesce(F.regexp_extract(c, r"(\d{2})$", 1).try_cast("int"), F.lit(0))
    m = F.when(F.length(c) > 3, m).otherwise(0)
    return F.when((h <= 18) & (m < 60), F.when(c.startswith("-"), -(h * 60 + m)).otherwise(h * 60 + m))


def parse(df: DataFrame, text: str, zone: str) -> DataFrame:
    """df with local (timestamp_ntz), minutes and name in place of text and zone: the wall time and its offset or its zone's lower-case name.

    zone is used where the text has none: an IANA name, letters, or letters with hours ('CST-6', 'GST10'). All three are null
    where the text can't be read or means no time that exists; minutes and name are null without a known zone. Each step is a projection
    of its own, so that no expression is repeated inside of another.
    """
    kept = [c for c in df.columns if c not in (text, zone)]
    d = df.select(*kept, F.trim(text).alias("_t"), F.trim(zone).alias("_z"))
    canon = None
    for pattern, parts in reversed(FORMATS):
        hit = F.regexp_replace("_t", pattern, parts)
        canon = F.when(F.col("_t").rlike(pattern), hit) if canon is None else F.when(F.col("_t").rlike(pattern), hit).otherwise(canon)
    d = d.withColumn("_p", F.split(canon, r"\|")).withColumn("_epoch", F.regexp_extract("_t", _EPOCH, 1).try_cast("bigint"))
    part = lambda i: F.get("_p", F.lit(i))
    num = lambda i: F.coalesce(part(i).try_cast("int"), F.lit(0))
    d = d.select(
        *kept, "_z", "_epoch", part(0).alias("_year"), part(1).alias("_month"), num(2).alias("_day"), num(3).alias("_hour"), num(4).alias("_minute"),
        num(5).alias("_second"), F.upper(part(6)).alias("_half"), part(7).alias("_own"), F.regexp_extract("_z", r"^[A-Za-z]+([+-]?\d{1,2})$", 1).try_cast("int").alias("_hours"),
    )
    year = F.col("_year").try_cast("int") + F.when(F.length("_year") == 2, 2000).otherwise(0)
    at = F.instr(F.lit(MONTHS), F.upper("_month"))
    month = F.when(F.col("_month").rlike("^[0-9]"), F.col("_month").try_cast("int")).when(at % 3 == 1, ((at - 1) / 3 + 1).cast("int"))
    twelve = F.when(F.col("_hour").between(1, 12), F.col("_hour") % 12 + F.when(F.col("_half") == "P", 12).otherwise(0))
    hour = F.when(F.col("_half") == "", F.when(F.col("_hour") < 24, F.col("_hour"))).otherwise(twelve)
    # Spark takes second 60 as the next minute
    local = F.call_function("try_make_timestamp_ntz", year, month, F.col("_day"), hour, F.col("_minute"), F.when(F.col("_second") < 60, F.col("_second")).cast("decimal(8,6)"))
    own = F.when(F.col("_own").rlike("^[+-]"), _signed(F.col("_own"))).otherwise(_letters(F.col("_own")))
    row = F.when(F.col("_hours").between(-18, 18), F.col("_hours") * 60).otherwise(_letters(F.col("_z")))
    d = d.withColumn("local", local).withColumn("minutes", F.when(F.col("_own") != "", own).otherwise(row).cast("int")).withColumn("name", F.lower(F.when(F.col("_own") != "", F.col("_own")).otherwise(F.col("_z"))))
    epoch = F.col("_epoch").isNotNull()
    instant = F.timestamp_add("SECOND", F.col("_epoch"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
    return d.select(
        *kept, F.when(epoch, instant).otherwise(F.col("local")).alias("local"), F.when(epoch, 0).otherwise(F.col("minutes")).alias("minutes"),
        F.when(~epoch & F.col("minutes").isNull() & F.contains("name", F.lit("/")), F.col("name")).alias("name"),
    )


def offset_intervals(spark: SparkSession, wanted: DataFrame) -> DataFrame:
    """(name, year, spans) for wanted(name, year): spans is an array of struct(lo, hi, minutes) of local time, around that year.

    Names that are no IANA zone are left out. A row holds the few intervals that touch its year, so the table grows only with the
    number of distinct zones and years. Changes are found to the minute.
    """
    names = sorted(zoneinfo.available_timezones())
    known = spark.createDataFrame([(n.lower(), n) for n in names if "/" in n], "name string, zone string")
    day = "INTERVAL '1' DAY"
    years = wanted.distinct().join(F.broadcast(known), "name")  # a few hundred fixed names
    days = years.select("name", "year", "zone", F.explode(F.expr("sequence(try_make_timestamp_ntz(year, 1, 1, 0, 0, 0) - INTERVAL '3' DAY, try_make_timestamp_ntz(year, 12, 31, 0, 0, 0) + INTERVAL '3' DAY, INTERVAL '1' DAY)")).alias("t"))
    offset = lambda t: f"cast(timestampdiff(SECOND, {t}, convert_timezone('UTC', zone, {t})) div 60 AS int)"
    days = days.withColumn("a", F.expr(offset("t"))).withColumn("b", F.expr(offset(f"(t + {day})")))
    first = days.filter("t = try_make_timestamp_ntz(year, 1, 1, 0, 0, 0) - INTERVAL '3' DAY").select("name", "year", "t", F.col("a").alias("minutes"))
    change = days.filter("a <> b").select("name", "year", "zone", F.explode(F.expr(f"sequence(t + INTERVAL '1' MINUTE, t + {day}, INTERVAL '1' MINUTE)")).alias("t"))
    change = change.withColumn("minutes", F.expr(offset("t"))).withColumn("was", F.expr(offset("(t - INTERVAL '1' MINUTE)"))).filter("minutes <> was")
    starts = first.unionByName(change.select("name", "year", "t", "minutes"))
    until = F.lead("t").over(Window.partitionBy("name", "year").orderBy("t"))
    ends = starts.withColumn("u", F.coalesce(until, F.expr("try_make_timestamp_ntz(year, 12, 31, 0, 0, 0) + INTERVAL '4' DAY")))
    wall = lambda c: F.timestamp_add("MINUTE", F.col("minutes"), F.col(c))
    span = F.struct(wall("t").alias("lo"), wall("u").alias("hi"), F.col("minutes"))
    return ends.groupBy("name", "year").agg(F.collect_list(span).alias("spans"))


def to_utc(df: DataFrame, text: str, zone: str | None, keep: tuple[str, ...], out: str = "utc", default_zone: str = "") -> DataFrame:
    """(*keep, out timestamp_ntz, status) of every row; see parse for the texts and zones, default_zone is for rows without a zone.

    status: 'ok'; 'unreadable' (null, unknown form or impossible value); 'no zone' (a wall time without a known zone); 'skipped' or
    'repeated' (a wall time at a clock change). out is null unless 'ok'. Parts that a text lacks count as 0, fractions of
    seconds are cut off. Rows are neither merged nor dropped, an empty table gives an empty result, columns not in keep are ignored.
    """
    z = F.coalesce(F.col(zone), F.lit(default_zone)) if zone else F.lit(default_zone)
    src = df.select(*[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], F.col(text).cast("string").alias("_text"), z.alias("_zone"))
    p = cut(parse(src, "_text", "_zone").withColumn("year", F.year("local")))  # read twice: for the zones that occur, and to place the times
    # only wall times of named zones are joined; the table of intervals is written so that its true size decides on a broadcast
    wall = F.col("local").isNotNull() & F.col("minutes").isNull() & F.col("name").isNotNull()
    walls = p.filter(wall)
    spans = cut(offset_intervals(df.sparkSession, walls.select("name", "year")))
    hit = walls.join(spans, ["name", "year"], "left").withColumn("hit", F.expr("filter(spans, s -> s.lo <= local AND local < s.hi)"))
    hit = hit.withColumn("minutes", F.when(F.size("hit") == 1, F.expr("hit[0].minutes"))).withColumn("n", F.when(F.col("spans").isNotNull(), F.size("hit")))
    p = p.filter(~wall).withColumn("n", F.lit(None).cast("int")).unionByName(hit.drop("spans", "hit"))
    status = (
        F.when(F.col("local").isNull(), "unreadable")
        .when(F.col("minutes").isNotNull(), "ok")
        .when(F.col("n").isNull(), "no zone")
        .when(F.col("n") == 0, "skipped")
        .otherwise("repeated")
    )
    utc = F.when(F.col("local").isNotNull(), F.timestamp_add("MINUTE", -F.col("minutes"), F.col("local")))
    return p.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], utc.alias(out), status.alias("status"))
