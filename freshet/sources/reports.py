"""Readers of report archives: storm event files, report text files, tab-separated service answers and payload scripts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.times import from_parts

# Columns of the two archives.
EVENT_COLUMNS = {
    "EPISODE_ID": "bigint", "EVENT_ID": "bigint", "STATE": "string", "STATE_FIPS": "int", "EVENT_TYPE": "string", "CZ_TYPE": "string", "CZ_FIPS": "int", "CZ_NAME": "string", "CZ_TIMEZONE": "string",
    "BEGIN_YEARMONTH": "int", "BEGIN_DAY": "int", "BEGIN_TIME": "int", "END_YEARMONTH": "int", "END_DAY": "int", "END_TIME": "int", "DEATHS_DIRECT": "int", "DEATHS_INDIRECT": "int", "INJURIES_DIRECT": "int",
    "INJURIES_INDIRECT": "int", "DAMAGE_PROPERTY": "string", "DAMAGE_CROPS": "string", "FLOOD_CAUSE": "string", "BEGIN_LAT": "double", "BEGIN_LON": "double", "END_LAT": "double", "END_LON": "double",
    "EVENT_NARRATIVE": "string", "EPISODE_NARRATIVE": "string",
}
REPORT_COLUMNS = ["VALID", "VALID2", "LAT", "LON", "MAG", "WFO", "TYPECODE", "TYPETEXT", "CITY", "COUNTY", "STATE", "SOURCE", "REMARK", "UGC", "UGCNAME", "QUALIFIER"]


def listed(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files that paths or patterns stand for, those of folders included (one level), by the file system's own listing."""
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for p in [paths] if isinstance(paths, str) else paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        for f in fs.globStatus(at) or []:
            out += [x.getPath().toString() for x in (fs.listStatus(f.getPath()) if f.isDirectory() else [f]) if not x.isDirectory()]
    return sorted(out)


def storm_events(spark: SparkSession, paths: str | list[str], event_type: str | None = "Flash Flood", years: tuple[int, int] | None = None) -> DataFrame:
    """Storm event CSVs (plain or gzip) with a header; columns are taken by name, files may have more. years: only files whose name has _dYYYY in range are read.

    Multi-line quoted texts are kept together. The file's name comes along as source_file.
    """
    if years:
        names = [(p, re.search(r"_d(\d{4})", p.rsplit("/", 1)[-1])) for p in listed(spark, paths)]
        paths = [p for p, m in names if m and years[0] <= int(m[1]) <= years[1]]
        if not paths:
            raise ValueError(f"no files of the years {years[0]} to {years[1]}")
    raw = spark.read.options(header=True, multiLine=True, escape='"', mode="PERMISSIVE").csv(paths)
    raw = raw.withColumn("source_file", F.col("_metadata.file_name"))
    missing = [c for c in ("EPISODE_ID", "EVENT_ID", "EVENT_TYPE") if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    typed = [(F.col(c).try_cast(t) if c in raw.columns else F.lit(None).cast(t)).alias(c) for c, t in EVENT_COLUMNS.items()]
    out = raw.select(*typed, "source_file")
    return out.filter(F.col("EVENT_TYPE") == event_type) if event_type else out


def event_times(df: DataFrame) -> DataFrame:
    """Adds begin_local and end_local from the number columns; an end before the begin, or none, becomes the begin."""
    a = from_parts(F.col("BEGIN_YEARMONTH"), F.col("BEGIN_DAY"), F.col("BEGIN_TIME"))
    z = from_parts(F.col("END_YEARMONTH"), F.col("END_DAY"), F.col("END_TIME"))
    d = df.withColumn("begin_local", a).withColumn("end_local", z)
    return d.withColumn("end_local", F.when(F.col("end_local") >= F.col("begin_local"), F.col("end_local")).otherwise(F.col("begin_local")))


def storm_reports(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Comma-separated report files without quoting, all columns as text.

    Short lines are filled with nulls, lines with too many fields are left out, as are headers and files without one.
    """
    n = len(REPORT_COLUMNS)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    parts = lines.withColumn("p", F.split("value", ",", -1)).filter((F.size("p") <= n) & (F.trim("value") != ""))
    good = lines.filter(F.col("value").startswith("VALID")).select("file").distinct()
    rows = parts.filter(~F.col("value").startswith("VALID")).join(good, "file", "left_semi")
    return rows.select(*[F.get("p", F.lit(i)).alias(c) for i, c in enumerate(REPORT_COLUMNS)])


def tab_answers(spark: SparkSession, paths: str | list[str], columns: list[str]) -> DataFrame:
    """Tab-separated service answers: '#' comments, a header line, a line of widths ('5s\\t15s'), then rows. columns names the fields in order."""
    v = F.col("value")
    rows = spark.read.text(paths).filter(~v.startswith("#") & (F.trim(v) != "") & ~v.rlike(r"^\d+[sdn](\t\d+[sdn])*$"))
    p = rows.withColumn("p", F.split("value", "\t")).filter(F.get("p", F.lit(0)) != columns[0])
    return p.select(*[F.trim(F.get("p", F.lit(i))).alias(c) for i, c in enumerate(columns)])


def script_payload(spark: SparkSession, paths: str | list[str], schema: str | T.DataType) -> DataFrame:
    """`var NAME = {...};` files, one object each: the text from the first brace to the last, read by the schema, with file_name."""
    raw = spark.read.text(paths, wholetext=True)
    body = F.regexp_extract("value", r"(?s)([{\[].*[}\]])", 1)
    return raw.select(F.col("_metadata.file_name").alias("file_name"), F.from_json(body, schema).alias("data"))


def gauge_answers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Landed JSON answers of a gage service to (site, site_name, lat, lon, time, value); blank values are null, only the first value list counts."""
    shape = (
        "value struct<timeSeries: array<struct<sourceInfo: struct<siteName: string, siteCode: array<struct<value: string>>, geoLocation: struct<geogLocation: struct<latitude: double, longitude: double>>>,"
        " values: array<struct<value: array<struct<value: string, dateTime: string>>>>>>>"
    )
    d = spark.read.option("multiLine", True).schema(shape).json(paths).select(F.explode("value.timeSeries").alias("s"))
    d = d.select(F.expr("s.sourceInfo.siteCode[0].value").alias("site"), F.col("s.sourceInfo.siteName").alias("site_name"), F.col("s.sourceInfo.geoLocation.geogLocation").alias("g"), F.explode(F.expr("s.values[0].value")).alias("v"))
    return d.select("site", "site_name", F.col("g.latitude").alias("lat"), F.col("g.longitude").alias("lon"), F.to_timestamp("v.dateTime").alias("time"), F.nullif("v.value", F.lit("")).try_cast("double").alias("value"))
