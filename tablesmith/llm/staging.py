"""Tables that cut lineage: written below the shared folder the session names, and read back."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from tablesmith.session import staging_root


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a plain local session without one gets a folder of its own."""
    return staging_root(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and safe from lost executors.

    What earlier steps shuffled and no one can read any more is given up first:
    Spark deletes such files when the driver collects its garbage, which an
    idle driver may not do for half an hour.
    """
    spark = df.sparkSession
    gc.collect()
    spark._jvm.System.gc()
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and nothing reads any more."""
    spark = df.sparkSession
    paths = {f.rpartition("/")[0] for f in df.inputFiles()}
    root = shared_dir(spark).removeprefix("file:").lstrip("/")
    for path in paths:
        if root in path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
