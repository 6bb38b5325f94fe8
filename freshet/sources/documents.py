"""Readers of nested documents: one JSON file for each entity, rows given as arrays with field names apart, and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def entity_documents(spark: SparkSession, paths: str | list[str], schema: str | StructType) -> DataFrame:
    """One row for each JSON file of an entity, read by the schema, with the file's name; files that are no JSON are rows of nulls."""
    return spark.read.schema(schema).options(multiLine=True, mode="PERMISSIVE").json(paths).withColumn("file_name", F.col("_metadata.file_name"))


def flattened(df: DataFrame, keep: tuple[str, ...] = (), separator: str = "_") -> DataFrame:
    """df with the fields of its structs, however deep, as columns named by their path; the columns in keep stay whole."""

    def columns(shape: StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in shape:
            at = (*path, f.name)
            if isinstance(f.dataType, StructType) and separator.join(at) not in keep:
                out += columns(f.dataType, at)
            else:
                out.append(F.col(".".join(f"`{x}`" for x in at)).alias(separator.join(at)))
        return out

    return df.select(*columns(df.schema, ()))


def zipped(fields: Column, row: Column) -> Column:
    """The map of a row's values by the names of its fields, as long as both go."""
    n = F.least(F.size(fields), F.size(row))
    return F.map_from_arrays(F.slice(fields, 1, n), F.slice(row, 1, n))
