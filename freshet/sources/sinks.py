"""Writers: tables in two formats, payload scripts, documents by entity, upserts by day, feature collections and a data dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.session import cut

#: Files at most that a folder of one value or day gets from a write, so that a large one is no single task.
SPLITS = 8


def write_table(df: DataFrame, path: str, csv: bool = False, compression: str = "zstd") -> None:
    """Parquet at path/parquet and, if asked for, CSV with a header and doubled quotes at path/csv, both in parallel parts."""
    df.write.mode("overwrite").option("compression", compression).parquet(f"{path}/parquet")
    if csv:
        df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(f"{path}/csv")


def write_documents(df: DataFrame, path: str, by: str) -> None:
    """One folder of JSON lines for each value of `by`; rows of a value are brought together first, so that a folder has few files (at most SPLITS)."""
    df.repartition(F.col(by), F.pmod(F.xxhash64(*df.columns), F.lit(SPLITS))).write.mode("overwrite").partitionBy(by).json(path)


def write_script(df: DataFrame, path: str, name: str) -> None:
    """A payload script in parallel parts: path/head declares `var NAME = {fields, rows: []};`, each line of path/rows pushes one row.

    The parts, head first, make one script in any order of the rows' files.
    """
    spark = df.sparkSession
    fields = ", ".join(f'"{c}"' for c in df.columns)
    cells = [F.regexp_replace(F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}), r'^\{"v":(.*)\}$', "$1") for c in df.columns]
    spark.range(1).select(F.lit(f'var {name} = {{"fields": [{fields}], "rows": []}};').alias("value")).write.mode("overwrite").text(f"{path}/head")
    df.select(F.concat(F.lit(f"{name}.rows.push(["), F.concat_ws(", ", *cells), F.lit("]);")).alias("value")).write.mode("overwrite").text(f"{path}/rows")


def upsert_days(new: DataFrame, path: str, time: str, keys: list[str]) -> None:
    """Rows of new are put into day folders: existing rows with the same keys give way, other days are not touched.

    The days concerned are read, joined with the new rows, and overwritten; Spark's commit protocol makes each swap whole.
    """
    spark = new.sparkSession
    n = new.withColumn("day", F.to_date(time)).withColumn("_new", F.lit(1))
    try:
        old = spark.read.parquet(path)
    except Exception as e:  # nothing was written yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    if old is not None:
        old = old.withColumn("day", F.to_date("day")).join(n.select("day").distinct(), "day", "left_semi").withColumn("_new", F.lit(0))
        n = n.unionByName(old, allowMissingColumns=True)
    w = Window.partitionBy("day", *keys).orderBy(F.col("_new").desc())
    best = cut(n.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_new"))  # read before it is overwritten
    best.repartition(F.col("day"), F.pmod(F.xxhash64(*keys), F.lit(SPLITS))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def _holds(outer: Column, inner: Column) -> Column:
    """Whether the first point of a ring lies within another ring (an odd number of whose edges is above it)."""
    p = inner[0]

    def above(i: Column) -> Column:
        a, b = F.get(outer, i - 1), F.get(outer, i)
        return ((a["x"] <= p["x"]) != (b["x"] <= p["x"])) & (a["y"] + (p["x"] - a["x"]) * F.try_divide(b["y"] - a["y"], b["x"] - a["x"]) > p["y"])

    return (outer != inner) & (F.size(F.filter(F.sequence(F.lit(1), F.size(outer) - 1), above)) % 2 == 1)


def feature(rings: Column, properties: list[str], digits: int = 5) -> Column:
    """A GeoJSON feature as text: coordinates rounded, properties as they are, nulls kept.

    Rings are told apart by nesting: one within an odd number of others is a hole of the ring around it that lies deepest, the others
    are pieces of their own, so that a MultiPolygon has as many polygons as pieces.
    """
    point = lambda r: F.transform(r, lambda p: F.array(F.round(p["x"], digits), F.round(p["y"], digits)))
    nested = F.transform(rings, lambda r: F.struct(r.alias("r"), F.size(F.filter(rings, lambda o: _holds(o, r))).alias("depth")))
    outer = F.filter(nested, lambda o: o["depth"] % 2 == 0)
    holes = lambda o: F.filter(nested, lambda h: (h["depth"] == o["depth"] + 1) & _holds(o["r"], h["r"]))
    coords = F.transform(outer, lambda o: F.concat(F.array(point(o["r"])), F.transform(holes(o), lambda h: point(h["r"]))))
    geometry = F.struct(F.lit("MultiPolygon").alias("type"), coords.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry")), {"ignoreNullFields": "false"})


def data_dictionary(tables: dict[str, DataFrame], comments: dict[str, str]) -> DataFrame:
    """(table, position, column, type, comment) from the tables' own schemas."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, i, f.name, f.dataType.simpleString(), comments.get(f.name, "")) for t, d in tables.items() for i, f in enumerate(d.schema)]
    return spark.createDataFrame(rows, "table string, position int, column string, type string, comment string")
