"""Duplicates (D1, D2). Rows are compared null-safely (two missing values
are equal), as a grouping does."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Copies that one row of the expansion unfolds to.
CHUNK = 10_000


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every copy of each duplicated row. Rows are counted per distinct
    value (map-side combined), then each duplicated row is re-expanded to its
    copies in chunks that are dealt out before they unfold: no row-level join,
    and a hot duplicate neither meets in nor leaves from one task."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    g = df.groupBy(*cols).agg(F.count("*").alias("_copies")).filter(F.col("_copies") > 1)
    last = F.floor((F.col("_copies") - 1) / CHUNK).cast("long")
    chunks = g.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_chunk"))
    size = F.least(F.lit(CHUNK).cast("long"), F.col("_copies") - F.col("_chunk") * CHUNK)
    return (chunks.withColumn("_size", size).repartition("_chunk", *cols)
            .select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_size"))).alias("_k")).drop("_k"))


def remove_duplicates(df: DataFrame, subset=None) -> DataFrame:
    """Keep one row of each group of identical rows."""
    return df.dropDuplicates(list(subset) if subset else None)
