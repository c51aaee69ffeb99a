"""Before / after comparison of one column across two versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions import bins as B
from tablesmith.functions.types import is_numeric_type
from tablesmith.operators.eda.groups import label_missing


def compare_before_after(before: DataFrame, after: DataFrame, column: str, bins: int = 30,
                         top: int = 15) -> DataFrame:
    """Numeric column: both histograms on edges shared by the two versions,
    long form with ``phase``. Categorical: the ``top`` most frequent values of
    each version (ties by value)."""
    c = F.col(f"`{column}`")
    tagged = (before.select(F.lit("before").alias("phase"), c.alias("v"))
              .unionByName(after.select(F.lit("after").alias("phase"), c.alias("v"))))
    if is_numeric_type(before.schema[column].dataType):
        r = tagged.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
        lo, hi = float(r["lo"]), float(r["hi"])
        a, b = B.hist_range(lo, hi)
        step = (b - a) / bins
        counts = (tagged.filter(F.col("v").isNotNull())
                  .groupBy("phase", B.hist_bucket(F.col("v").cast("double"), lo, hi, bins).alias("bin"))
                  .agg(F.count("*").alias("count")))
        grid = tagged.select("phase").distinct().select(
            "phase", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
        return grid.join(counts, ["phase", "bin"], "left").select(
            "phase", "bin", (F.lit(a) + F.col("bin") * F.lit(step)).alias("bin_lo"),
            F.coalesce("count", F.lit(0)).cast("long").alias("count"))
    counts = tagged.groupBy("phase", label_missing(F.col("v")).alias("category")).agg(
        F.count("*").alias("count"))
    from pyspark.sql import Window
    w = Window.partitionBy("phase").orderBy(F.col("count").desc(), F.col("category"))
    # ranked within a phase over distinct categories only
    return (counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
            .select("phase", "rank", "category", F.col("count").cast("long")))


def change_summary(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Rows, mean and sd of ``column`` in both versions and their change."""
    c = F.col(f"`{column}`").cast("double")
    b = before.agg(F.count("*").alias("rows_before"), F.avg(c).alias("mean_before"),
                   F.stddev_samp(c).alias("std_before"))
    a = after.agg(F.count("*").alias("rows_after"), F.avg(c).alias("mean_after"),
                  F.stddev_samp(c).alias("std_after"))
    j = b.join(a, how="inner", on=F.lit(True))
    return j.select("*", (F.col("rows_after") - F.col("rows_before")).alias("rows_change"),
                    (F.col("mean_after") - F.col("mean_before")).alias("mean_change"),
                    (F.col("std_after") - F.col("std_before")).alias("std_change"))
