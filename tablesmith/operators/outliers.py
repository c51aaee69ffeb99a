"""IQR outliers (C6 detect, C7 remove, C8 cap)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.quantile import column_quantiles
from tablesmith.functions.types import require_numeric


def iqr_bounds(df: DataFrame, column: str, iqr_multiplier: float = 1.5) -> dict:
    require_numeric(df, [column])
    q = column_quantiles(df, [column], [0.25, 0.75])[column]
    if q is None:
        raise ValueError(f"Column '{column}' has no values")
    q1, q3 = float(q[0]), float(q[1])
    iqr = q3 - q1
    return {"q1": q1, "q3": q3, "iqr": iqr, "lower_bound": q1 - iqr_multiplier * iqr,
            "upper_bound": q3 + iqr_multiplier * iqr}


def outlier_flag(df: DataFrame, column: str, iqr_multiplier: float = 1.5,
                 flag: str = "is_outlier") -> DataFrame:
    b = iqr_bounds(df, column, iqr_multiplier)
    c = F.col(f"`{column}`")
    return df.withColumn(flag, F.coalesce((c < b["lower_bound"]) | (c > b["upper_bound"]),
                                          F.lit(False)))


def detect_outliers(df: DataFrame, column: str, iqr_multiplier: float = 1.5) -> DataFrame:
    """One row of q1, q3, iqr, bounds and the outlier count."""
    b = iqr_bounds(df, column, iqr_multiplier)
    c = F.col(f"`{column}`")
    n = df.agg(F.count_if((c < b["lower_bound"]) | (c > b["upper_bound"])).alias("n")).first()["n"]
    return df.sparkSession.createDataFrame(
        [(column, b["q1"], b["q3"], b["iqr"], b["lower_bound"], b["upper_bound"], int(n))],
        "column string, q1 double, q3 double, iqr double, lower_bound double, "
        "upper_bound double, n_outliers long")


def detect_outliers_lazy(df: DataFrame, column: str, iqr_multiplier: float = 1.5) -> DataFrame:
    """C6 as a plan: fences from the quartiles, count in the same job."""
    b = iqr_bounds(df, column, iqr_multiplier)
    c = F.col(f"`{column}`")
    return df.agg(F.count_if((c < b["lower_bound"]) | (c > b["upper_bound"])).alias("n_outliers")).select(
        F.lit(column).alias("column"), F.lit(b["q1"]).alias("q1"), F.lit(b["q3"]).alias("q3"),
        F.lit(b["iqr"]).alias("iqr"), F.lit(b["lower_bound"]).alias("lower_bound"),
        F.lit(b["upper_bound"]).alias("upper_bound"), F.col("n_outliers").cast("long"))


def handle_outliers(df: DataFrame, column: str, action: str = "remove",
                    iqr_multiplier: float = 1.5) -> DataFrame:
    """C7 ``remove`` keeps rows inside the fences (missing rows go too);
    C8 ``cap`` clips to the fences and keeps missing values (trap T21)."""
    b = iqr_bounds(df, column, iqr_multiplier)
    c = F.col(f"`{column}`")
    if action == "remove":
        return df.filter((c >= b["lower_bound"]) & (c <= b["upper_bound"]))
    if action == "cap":
        capped = F.least(F.greatest(c.cast("double"), F.lit(b["lower_bound"])), F.lit(b["upper_bound"]))
        return df.withColumn(column, F.when(c.isNull(), F.lit(None).cast("double")).otherwise(capped))
    raise ValueError(f"{action!r} is no outlier action: remove or cap")
