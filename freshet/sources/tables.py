"""Loading of the project's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "precip_scans event_windows site_events storm_clusters episodes lsrs gages network huc8_units mix_targets"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Temp views with the tables' names, for spark.sql."""
    for n in names or TABLES:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
