"""Exact quantiles and modes that no single task computes.

Values are counted per key (map-side first), ranked by cumulative counts over
ranges of values, and the value at each wanted rank is read where it lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.ranks import cumulative_below
from tablesmith.session import staged


def quantiles_by(df: DataFrame, value: Column, probs: list[float], keys: dict[str, Column] | None = None) -> DataFrame:
    """(keys..., q): the quantiles of ``value`` per key by linear interpolation
    between neighbouring ranks, as an array in the order of ``probs``. Missing
    values don't count; a key without values has no row."""
    keys = keys or {"_all": F.lit(0)}
    names = list(keys)
    counts = (df.select(*[c.alias(n) for n, c in keys.items()], value.cast("double").alias("_v")).where("_v IS NOT NULL")
              .groupBy(*names, "_v").agg(F.count("*").alias("_c")))
    counts = staged(counts, "value-counts")  # bounds, totals, ranks and sizes all read it
    ranked = cumulative_below(counts, "_v", ["_c"], names)
    sizes = counts.groupBy(*names).agg((F.sum("_c") - 1).alias("_last"))
    same = [ranked[n].eqNullSafe(sizes[n]) for n in names]
    placed = ranked.join(sizes, same[0] if len(same) == 1 else same[0] & same[1], "inner").select(
        *[ranked[n] for n in names], "_v", "_c", "_c_below", "_last")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_c_below") <= rank) & (rank < F.col("_c_below") + F.col("_c")), F.col("_v")))

    def quantile(p: float) -> Column:
        place = F.col("_last") * F.lit(float(p))
        low, high = F.floor(place), F.ceil(place)
        return F.struct(at(low).alias("a"), at(high).alias("b"), F.max(place - low).alias("f"))

    found = placed.groupBy(*names).agg(F.array(*[quantile(p) for p in probs]).alias("_q"))
    return found.select(*[n for n in names if n != "_all"], F.transform(
        "_q", lambda x: F.when(x["a"] == x["b"], x["a"]).otherwise((1 - x["f"]) * x["a"] + x["f"] * x["b"])).alias("q"))


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[float] | None]:
    """Quantiles of whole columns: columns x probs numbers; None for a column without values."""
    if not columns:
        return {}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("v"))
                                         for i, c in enumerate(columns)])).alias("x")).select("x.*")
    got = {r["i"]: list(r["q"]) for r in quantiles_by(long, F.col("v"), probs, {"i": F.col("i")}).collect()}
    return {c: got.get(i) for i, c in enumerate(columns)}


def column_modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent value of each column, the smallest on ties; None for a column without values."""
    out = {}
    for c in columns:
        counts = df.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").alias("v")).agg(F.count("*").alias("n"))
        out[c] = counts.agg(F.min_by("v", F.struct(F.negate("n"), "v")).alias("m")).first()["m"]
    return out


