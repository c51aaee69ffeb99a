"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.quantile import quantiles_by
from tablesmith.functions.types import require_categorical, require_numeric

MISSING = "<<MISSING>>"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def label_missing(c: Column) -> Column:
    """Categorical value with missing shown as its own label."""
    return F.coalesce(c.cast("string"), F.lit(MISSING))


def group_box_stats(df: DataFrame, value: str, by: str, hue: str | None = None) -> DataFrame:
    """Count, mean, sd, min, quartiles (linear interpolation), max of
    ``value`` per ``by`` (and ``hue``). Rows missing ``value`` or ``by`` are
    dropped; a missing hue is kept as its own group. Quartiles are read from
    counts of distinct values by ranges, so no task holds a whole group."""
    require_numeric(df, [value])
    keys = [_c(by).cast("string").alias("group")]
    if hue and hue != by:
        keys.append(_c(hue).cast("string").alias("hue_value"))
    v = _c(value).cast("double")
    rows = df.filter(_c(value).isNotNull() & _c(by).isNotNull()).select(*keys, v.alias("v"))
    names = [k for k in ("group", "hue_value") if k in rows.columns]
    g = rows.groupBy(*names).agg(F.count("v").alias("count"), F.avg("v").alias("mean"),
                                 F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    q = quantiles_by(rows, F.col("v"), [0.25, 0.5, 0.75], {n: F.col(n) for n in names})
    on = [g[n].eqNullSafe(q[n]) for n in names]
    return g.join(q, on[0] if len(on) == 1 else on[0] & on[1]).select(
        *[g[n] for n in names], "count", "mean", "std", "min", F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max")


def group_bar(df: DataFrame, value: str, by: str, hue: str | None = None) -> DataFrame:
    """A10: mean, count and sd of ``value`` per group."""
    require_numeric(df, [value])
    keys = [_c(by).cast("string").alias("group")]
    if hue and hue != by:
        keys.append(_c(hue).cast("string").alias("hue_value"))
    v = _c(value).cast("double")
    return (df.filter(_c(value).isNotNull() & _c(by).isNotNull()).groupBy(*keys)
            .agg(F.avg(v).alias("value"), F.count(v).alias("count"), F.stddev_samp(v).alias("std")))


def contingency(df: DataFrame, x: str, y: str) -> DataFrame:
    """Long-form contingency table; missing is its own label, and a pair
    of labels that never meet has a row with n = 0. The label lists are the
    table's sides, so their product is its size."""
    require_categorical(df, [x, y])
    counts = df.groupBy(label_missing(_c(x)).alias("x_value"),
                        label_missing(_c(y)).alias("y_value")).agg(F.count("*").alias("n"))
    sides = counts.select("x_value").distinct().join(counts.select("y_value").distinct(), how="inner", on=F.lit(True))
    return sides.join(counts, ["x_value", "y_value"], "left").select(
        "x_value", "y_value", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def contingency_wide(df: DataFrame, x: str, y: str, max_labels: int = 1000) -> DataFrame:
    """A11, wide: one row per y label, one column per x label; more than ``max_labels`` columns are refused."""
    labels = [r[0] for r in df.select(label_missing(_c(x)).alias("v")).distinct().limit(max_labels + 1).collect()]
    if len(labels) > max_labels:
        raise ValueError(f"{x} has more than {max_labels} distinct values")
    return (df.select(label_missing(_c(x)).alias("x_value"), label_missing(_c(y)).alias(y))
            .groupBy(f"`{y}`").pivot("x_value", sorted(labels)).count().na.fill(0))
