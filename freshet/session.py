"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "freshet", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators are written for (UTC, AQE), the package at hand in its Python workers; an existing session is reused."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("FRESHET_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ship(spark)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable in the Python workers of all executors, once an application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-freshet-", dir="/tmp"), "freshet_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join("freshet", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: spark.checkpoint.dir, or what the context already has.

    Only a purely local master, as in tests, gets a folder of its own; a cluster without the setting
    is an error, since a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    if d := spark.conf.get("spark.checkpoint.dir", None):
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    if d := sc.getCheckpointDir():
        return d
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-freshet-", dir="/tmp"))
    return sc.getCheckpointDir()


def cut(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """Write df as a table in the shared checkpoint folder and go on from there.

    instead_of: the table of an earlier round of a loop, which is removed once the new one is written. (A table and
    not checkpoint(), as that carries the optimizer's constraints along, which double with every round of a loop.)
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/freshet-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    if old := getattr(instead_of, "__dict__", {}).get("_cut_path"):
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(old)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
