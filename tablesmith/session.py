"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults a user would set for these workloads; anything passed in ``conf``
# wins, and an existing session keeps its own settings.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "tablesmith",
                  conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Operators never invent a machine-local folder; if the session names
    none, they refuse to checkpoint.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(configured)
    return configured


#: Scratch root of a plain local session that names none; one process, so one folder serves all.
_local_root: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or the checkpoint folder the session set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="tablesmith-"))
    return _local_root[0]


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read back: what several jobs read is computed once,
    and a lost executor costs no more than rereading it."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, where it isn't
    installed there. Once a session; Spark's own file server carries it, so no
    shared folder is needed."""
    sc = spark.sparkContext
    if getattr(sc, "_tablesmith_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tablesmith-"), "tablesmith"), "zip", root, "tablesmith")
    sc.addPyFile(archive)
    sc._tablesmith_shipped = True
