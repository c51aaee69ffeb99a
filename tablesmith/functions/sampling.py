"""Repeatable samples: the rows with the smallest hashes of their values.

The hash is MD5 over a text of the values (floating numbers to six decimals),
which any engine can repeat. Samples are for display; statistics use all rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.types import validate_columns
from tablesmith.session import staged

#: Hexadecimal digits of a hash that thresholds compare.
_DIGITS = 15
#: Groups whose sizes are broadcast, at most; more are joined by shuffle, with the same rows.
BROADCAST_GROUPS = 100_000


def row_hash(df: DataFrame, columns: list[str], seed: int = 0) -> Column:
    def text(name: str) -> Column:
        c = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            c = F.floor(c.cast("double") * 1e6 + 0.5)
        return F.coalesce(c.cast("string"), F.lit("~"))

    return F.md5(F.concat_ws("|", *[text(c) for c in columns], F.lit(str(seed))))


def sample_rows(df: DataFrame, columns: list[str], max_points: int | None, group: str | None = None, seed: int = 0) -> DataFrame:
    """Up to ``max_points`` rows of ``columns``, in all or per value of ``group`` (one of the columns; missing is a value).

    In all: a top-k that keeps ``max_points`` rows a task. Per group: the
    groups are counted (a few groups' sizes go to the rows, which stay where they are), a threshold lets about the wanted number of each
    group's rows through, and only those are ranked; a group whose threshold
    let too few through, as equal rows have equal hashes, is ranked whole, by a
    window that again keeps ``max_points`` a task. All rows if there is no limit.
    """
    validate_columns(df, columns)
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    if max_points is None:
        return rows
    rows = rows.withColumn("_k", row_hash(df, columns, seed))
    order = ["_k", *[F.col(f"`{c}`") for c in columns]]
    if group is None:
        return rows.orderBy(*order).limit(max_points).drop("_k")
    rows = rows.withColumn("_g", F.col(f"`{group}`"))
    wanted = max_points + 6 * math.sqrt(max_points) + 20
    sizes = rows.groupBy(F.col("_g").alias("_h")).agg(F.count("*").alias("_n"))
    limit = F.floor(F.lit(wanted) / F.col("_n") * F.lit(float(16 ** _DIGITS))).cast("long")
    sizes = sizes.select("_h", "_n", F.when(F.col("_n") > wanted, F.lpad(F.lower(F.hex(limit)), _DIGITS, "0")).alias("_t"))
    sizes = staged(sizes, "group-sizes")  # the count of those let through and the rows both read it
    few_groups = sizes.count() <= BROADCAST_GROUPS
    sizes = F.broadcast(sizes) if few_groups else sizes
    let = F.col("_t").isNull() | (F.substring("_k", 1, _DIGITS) < F.col("_t"))
    sized = rows.join(sizes, rows["_g"].eqNullSafe(sizes["_h"]))
    passed = sized.groupBy("_h", "_n").agg(F.count_if(let).alias("_p"))
    short = passed.where(F.col("_p") < F.least("_n", F.lit(max_points))).select("_h")
    kept = sized.where(let)
    if not short.isEmpty():
        few = short.select(F.col("_h").alias("_s"))
        few = F.broadcast(few) if few_groups else few
        kept = (kept.join(few, kept["_h"].eqNullSafe(few["_s"]), "left_anti")
                .unionByName(sized.join(few, sized["_h"].eqNullSafe(few["_s"]), "left_semi")))
    place = F.row_number().over(Window.partitionBy("_h").orderBy(*order))
    return kept.withColumn("_i", place).where(F.col("_i") <= max_points).select(*[F.col(f"`{c}`") for c in columns])
