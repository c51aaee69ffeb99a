"""Distributed ranks over a table of distinct values.

Average ranks (Spearman, Mann-Whitney) need, for each distinct value, the
total weight of all smaller values. A window ordered over the whole table
would move every row to one task, so the value range is cut into buckets at
approximate quantiles: a window runs inside each bucket, and a tiny table of
bucket totals (``keys x buckets`` rows, broadcast) supplies the offsets.

Callers aggregate to distinct values first, so hot values are already one
row each and buckets stay balanced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.session import shuffle_partitions


def bucket_of(value: Column, bounds: list[float]) -> Column:
    """How many of the ascending ``bounds`` are at or below ``value``, by halving: log2 comparisons a row."""
    def part(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(bounds[mid]), part(lo, mid)).otherwise(part(mid + 1, hi))

    return part(0, len(bounds)).cast("int")


def _bounds(df: DataFrame, value: str, n_buckets: int | None) -> list[float]:
    n = n_buckets or max(1, shuffle_partitions(df.sparkSession))
    if n == 1:
        return []
    found = df.approxQuantile(value, [i / n for i in range(1, n)], 1.0 / (4 * n))
    return sorted({float(q) for q in found if q is not None})


def cumulative_below(df: DataFrame, value: str, weights: list[str], keys: list[str] | None = None,
                     n_buckets: int | None = None) -> DataFrame:
    """Add ``<w>_below`` = sum of ``w`` over rows of the same ``keys`` whose
    ``value`` is smaller. ``(keys, value)`` must be unique in ``df``."""
    keys = list(keys or [])
    d = df.withColumn("_bk", bucket_of(F.col(value), _bounds(df, value, n_buckets)))
    totals = d.groupBy(*keys, "_bk").agg(*[F.sum(w).alias(w) for w in weights])
    w_off = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_bk", *[
        F.coalesce(F.sum(w).over(w_off), F.lit(0)).alias(f"_off_{w}") for w in weights])
    w_in = Window.partitionBy(*keys, "_bk").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inner = d.select("*", *[F.coalesce(F.sum(w).over(w_in), F.lit(0)).alias(f"_in_{w}")
                            for w in weights])
    # offsets has at most (#keys x n_buckets) rows: a bounded broadcast.
    off = F.broadcast(offsets)
    same = inner["_bk"] == off["_bk"]
    for k in keys:  # a missing key is a key of its own
        same = same & inner[k].eqNullSafe(off[k])
    return inner.join(off, same, "inner").select(
        *[inner[c] for c in df.columns],
        *[(F.col(f"_off_{w}") + F.col(f"_in_{w}")).alias(f"{w}_below") for w in weights])


def least_from(df: DataFrame, value: str, measure: str, keys: list[str] | None = None, n_buckets: int | None = None) -> DataFrame:
    """Add ``<measure>_least``: the least ``measure`` of the rows of the same
    ``keys`` whose ``value`` is the row's or greater, by the same buckets as
    ``cumulative_below``."""
    keys = list(keys or [])
    d = df.withColumn("_bk", bucket_of(F.col(value), _bounds(df, value, n_buckets)))
    later = Window.partitionBy(*keys).orderBy(F.col("_bk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy(*keys, "_bk").agg(F.min(measure).alias("_m")).select(*keys, "_bk", F.min("_m").over(later).alias("_after"))
    own = Window.partitionBy(*keys, "_bk").orderBy(F.col(value).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inner = d.withColumn("_own", F.min(measure).over(own))
    same = inner["_bk"] == totals["_bk"]
    for k in keys:
        same = same & inner[k].eqNullSafe(totals[k])
    # (#keys x buckets) rows at most; a plain join where there are many keys
    return inner.join(totals, same, "inner").select(*[inner[c] for c in df.columns], F.least("_own", "_after").alias(f"{measure}_least"))
