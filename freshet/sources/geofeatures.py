"""Readers of geographic layers: GeoJSON, and GeoPackage files as a Spark data source."""

from __future__ import annotations

import re
import sqlite3
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

RINGS = "array<array<struct<x: double, y: double>>>"


def geojson(spark: SparkSession, paths: str | list[str], properties: str) -> DataFrame:
    """Features of collections or single features: their properties (a DDL string) and rings, for polygons and multipolygons."""
    shape = f"struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>"
    raw = spark.read.text(paths, wholetext=True)
    text = F.regexp_replace("value", r"(?s)^[^{]*=\s*", "")
    d = raw.select(F.from_json(text, f"struct<features: array<{shape}>>")["features"].alias("many"), F.from_json(text, shape).alias("one"))
    d = d.select(F.explode(F.when(F.col("many").isNotNull(), F.col("many")).otherwise(F.array("one"))).alias("f")).filter("f.geometry IS NOT NULL")
    c = F.col("f.geometry.coordinates")
    poly = F.from_json(c, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(c, "array<array<array<array<double>>>>"))
    pts = F.when(F.col("f.geometry.type") == "MultiPolygon", multi).otherwise(poly)
    rings = F.transform(pts, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return d.select("f.properties.*", rings.alias("rings"))


def rings_of(blob: bytes | None) -> list[list[tuple[float, float]]] | None:
    """Rings of a GeoPackage or plain WKB polygon or multipolygon; null for other geometry."""
    if not blob:
        return None
    at = 0
    if blob[:2] == b"GP":
        at = 8 + (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7]

    def geometry(at: int) -> tuple[list, int]:
        order = "<" if blob[at] else ">"
        kind, n = struct.unpack_from(order + "II", blob, at + 1)
        width = 2 + (kind // 1000 in (1, 2)) + 2 * (kind // 1000 == 3)
        at, out = at + 9, []
        if kind % 1000 == 6:
            for _ in range(n):
                more, at = geometry(at)
                out += more
        elif kind % 1000 == 3:
            for _ in range(n):
                (m,) = struct.unpack_from(order + "I", blob, at)
                xs = struct.unpack_from(f"{order}{m * width}d", blob, at + 4)
                out.append(list(zip(xs[::width], xs[1::width])))
                at += 4 + 8 * m * width
        return out, at

    return geometry(at)[0] or None


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


class _GeoPackageReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.table = schema, options["path"], options["table"]
        if not re.fullmatch(r"\w+", self.table):
            raise ValueError("table must be a plain name")
        self.parts, self.where, self.args = int(options.get("partitions", 8)), [], []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        names = {f.name for f in self.schema if f.name != "rings"}
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute[0] in names:
                self.where.append(f'"{f.attribute[0]}" = ?')
                self.args.append(f.value)
            elif isinstance(f, In) and f.attribute[0] in names and len(f.value) <= 500:
                self.where.append(f'"{f.attribute[0]}" IN ({",".join("?" * len(f.value))})')
                self.args += list(f.value)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            lo, hi = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if lo is None:
            return [_Range(0, 0)]
        size = -(-(hi - lo + 1) // self.parts)
        return [_Range(a, a + size) for a in range(lo, hi + 1, size)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        geom = "geom"
        cols = ", ".join(f'"{geom}"' if f.name == "rings" else f'"{f.name}"' for f in self.schema)
        sql = f'SELECT {cols} FROM "{self.table}" WHERE rowid >= ? AND rowid < ?' + "".join(f" AND {w}" for w in self.where)
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            for row in db.execute(sql, [partition.lo, partition.hi, *self.args]):
                yield tuple(rings_of(v) if f.name == "rings" else v for f, v in zip(self.schema, row))


class GeoPackage(DataSource):
    """spark.read.format("gpkg").schema("id STRING, rings ...").option("table", name).load(path).

    The schema names the columns that are read, `rings` being the geometry; equality and IN filters run inside the file. Rows are
    split by ranges of row ids. The file has to be readable by all executors.
    """

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> str:
        raise ValueError("give the schema of the columns to read")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _GeoPackageReader(schema, self.options)
