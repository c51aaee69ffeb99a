"""Profiling (P1-P9): overview, column info, describe, missing and duplicate
summaries, scale summary, head, one-column moments.

Per-column statistics are computed in one aggregate and turned into long
form (one row per column) with ``stack``, so a wide table costs one scan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.quantile import column_quantiles
from tablesmith.functions.types import (categorical_columns, is_numeric_type, non_numeric_columns,
                                        numeric_columns, round_half_up, validate_columns)


def _q(name: str) -> str:
    return f"`{name}`"


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells, duplicate rows beyond the first and
    the numeric / other column lists (comma-separated). Duplicates and missing
    cells come from one grouping by all columns: every copy of a row carries
    the same null count."""
    cols = df.columns
    nulls = sum((F.col(_q(c)).isNull().cast("long") for c in cols), F.lit(0).cast("long"))
    g = df.groupBy(*[F.col(_q(c)) for c in cols]).agg(F.count("*").alias("_c")).select(
        "_c", nulls.alias("_nulls"))
    out = g.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n_rows"),
                F.count("*").alias("_distinct"),
                F.coalesce(F.sum(F.col("_c") * F.col("_nulls")), F.lit(0)).alias("n_missing"))
    return out.select(
        F.col("n_rows").cast("long").alias("n_rows"),
        F.lit(len(cols)).cast("long").alias("n_cols"),
        F.col("n_missing").cast("long").alias("n_missing"),
        (F.col("n_rows") - F.col("_distinct")).cast("long").alias("n_duplicates"),
        F.lit(",".join(numeric_columns(df))).alias("numeric_columns"),
        F.lit(",".join(non_numeric_columns(df))).alias("categorical_columns"))


def _value_tables(df: DataFrame) -> DataFrame:
    """(position, number, text, n): the distinct values of every column with how often they stand, and the
    number of rows under position -1. A task emits each value of a batch of rows once; numbers travel as 64 bits."""
    cols = df.columns
    plain = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp")
    as_number = [df.schema[c].dataType.simpleString() in plain for c in cols]
    ready = []
    for c, numeric in zip(cols, as_number, strict=True):
        v, kind = F.col(_q(c)), df.schema[c].dataType.simpleString()
        if kind in ("float", "double"):
            ready.append(v.cast("double"))
        elif kind == "date":
            ready.append(F.unix_date(v).cast("long"))
        elif kind == "timestamp":
            ready.append(F.unix_micros(v))
        elif kind == "binary":
            ready.append(F.hex(v))
        elif kind.startswith(("array", "struct")):
            ready.append(F.to_json(v, {"ignoreNullFields": "false"}))
        else:
            ready.append(v.cast("long") if numeric else v.cast("string"))
    ready = [v.alias(f"c{i}") for i, v in enumerate(ready)]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([None], pa.int64()), pa.array([None], pa.string()),
                                              pa.array([batch.num_rows], pa.int64())], ["position", "number", "text", "n"])
            for i, column in enumerate(batch.columns):
                found = pc.value_counts(column.drop_null())
                values, n = found.field(0), found.field(1)
                size = len(values)
                if pa.types.is_floating(values.type):  # -0.0 is 0.0, and all NaN are one
                    v = values.to_numpy(zero_copy_only=False) + 0.0
                    values = pa.array(np.where(np.isnan(v), np.nan, v).view(np.int64))
                number = values if as_number[i] else pa.nulls(size, pa.int64())
                text = pa.nulls(size, pa.string()) if as_number[i] else values.cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, i, dtype=np.int32)), number.cast(pa.int64()), text, n.cast(pa.int64())],
                                                 ["position", "number", "text", "n"])

    return df.select(*ready).mapInArrow(run, "position int, number bigint, text string, n bigint")


def column_info(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column dtype, numeric / categorical flags, non-null, missing,
    missing % (2 dp) and distinct non-null values.

    Exact counts come from the columns' value tables: tasks emit the distinct
    values of their batches, one shuffle by (column, value) meets them, and
    rows are never expanded. ``approx`` uses HLL sketches instead."""
    cols = df.columns
    if approx:
        wide = df.agg(F.count("*").alias("_n"), *[F.count(F.col(_q(c))).alias(f"nn{i}") for i, c in enumerate(cols)],
                      *[F.approx_count_distinct(F.col(_q(c))).alias(f"u{i}") for i, c in enumerate(cols)])
    else:
        values = _value_tables(df).groupBy("position", "number", "text").agg(F.sum("n").alias("n"))
        each = values.groupBy("position").agg(F.sum("n").alias("n"), F.count("*").alias("u"))  # one row a column

        def of(i: int, name: str):
            return F.coalesce(F.max(F.when(F.col("position") == i, F.col(name))), F.lit(0)).cast("long")

        wide = each.agg(of(-1, "n").alias("_n"), *[of(i, "n").alias(f"nn{i}") for i in range(len(cols))],
                        *[of(i, "u").alias(f"u{i}") for i in range(len(cols))])
    cat = set(categorical_columns(df))
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                 F.lit(is_numeric_type(df.schema[c].dataType)).alias("is_numeric"),
                 F.lit(c in cat).alias("is_categorical"),
                 F.col(f"nn{i}").alias("non_null"), F.col(f"u{i}").alias("unique"))
        for i, c in enumerate(cols)]))
    x = wide.select("_n", rows.alias("x"))
    missing = F.col("_n") - F.col("x.non_null")
    return x.select(
        "x.position", "x.column", "x.dtype", "x.is_numeric", "x.is_categorical",
        F.col("x.non_null").cast("long").alias("non_null"), missing.cast("long").alias("missing"),
        round_half_up(missing / F.greatest(F.col("_n"), F.lit(1)) * 100.0, 2).alias("missing_pct"),
        F.col("x.unique").cast("long").alias("unique"))


def missing_summary(df: DataFrame) -> DataFrame:
    """P5: only columns with gaps, most missing first; one counting scan."""
    wide = df.agg(F.count("*").alias("_n"), *[F.count(F.col(_q(c))).alias(f"nn{i}") for i, c in enumerate(df.columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), (F.col("_n") - F.col(f"nn{i}")).alias("missing"))
                               for i, c in enumerate(df.columns)]))
    return (wide.select("_n", rows.alias("x")).filter(F.col("x.missing") > 0)
            .select("x.column", F.col("x.missing").cast("long").alias("missing"),
                    round_half_up(F.col("x.missing") / F.col("_n") * 100.0, 2).alias("missing_pct"))
            .orderBy(F.col("missing").desc(), F.col("column")))


def describe_numeric(df: DataFrame, columns=None) -> DataFrame:
    """P3/P4 numeric half: count, mean, sd, min, quartiles (linear
    interpolation), max per column."""
    cols = list(columns) if columns else numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(_q(c)).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    parts = column_quantiles(df, cols, [0.25, 0.5, 0.75])

    def part(c: str, k: int):
        return F.lit(parts[c][k] if parts[c] else None).cast("double")

    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                 F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"),
                 part(c, 0).alias("p25"), part(c, 1).alias("p50"), part(c, 2).alias("p75"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)]))
    return wide.select(rows.alias("x")).select("x.*")


def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.col(_q(c)).cast("string").alias("value")) for i, c in enumerate(cols)
    ])).alias("x")).select("x.*")


def describe_categorical(df: DataFrame, columns=None) -> DataFrame:
    """P3/P4 categorical half: count, unique, top (most frequent, smallest on
    ties), freq per column. Values are counted per (column, value) with
    map-side combining, so a value holding a third of the rows is one row per
    task."""
    cols = list(columns) if columns else categorical_columns(df)
    counts = (_long_values(df, cols).filter(F.col("value").isNotNull())
              .groupBy("position", "column", "value").agg(F.count("*").alias("c")))
    return counts.groupBy("position", "column").agg(
        F.sum("c").cast("long").alias("count"), F.count("*").cast("long").alias("unique"),
        F.min_by("value", F.struct(-F.col("c"), F.col("value"))).alias("top"),
        F.max("c").cast("long").alias("freq"))


def duplicate_summary(df: DataFrame) -> DataFrame:
    """Rows that have a copy (all copies counted), their share of rows,
    and the number of duplicated row groups."""
    g = df.groupBy(*[F.col(_q(c)) for c in df.columns]).agg(F.count("*").alias("_c"))
    out = g.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n_rows"),
                F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias("dup_rows"),
                F.count_if(F.col("_c") > 1).alias("dup_groups"))
    return out.select(
        F.col("n_rows").cast("long").alias("n_rows"),
        F.col("dup_rows").cast("long").alias("n_duplicate_rows"),
        round_half_up(F.col("dup_rows") / F.greatest(F.col("n_rows"), F.lit(1)) * 100.0, 2).alias("duplicate_pct"),
        F.col("dup_groups").cast("long").alias("n_duplicate_groups"))


def duplicate_examples(df: DataFrame, n: int = 3) -> DataFrame:
    """P6 examples: up to ``n`` duplicated rows (one per group), by value order."""
    cols = df.columns
    g = df.groupBy(*[F.col(_q(c)) for c in cols]).agg(F.count("*").alias("copies"))
    return g.filter(F.col("copies") > 1).orderBy(*[F.col(_q(c)) for c in cols]).limit(n)


def scale_summary(df: DataFrame, columns=None) -> DataFrame:
    """Min, max, mean per numeric column."""
    cols = list(columns) if columns else numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(_q(c)).cast("double")
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.avg(v).alias(f"m{i}")]
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"lo{i}").alias("min"),
                 F.col(f"hi{i}").alias("max"), F.col(f"m{i}").alias("mean"))
        for i, c in enumerate(cols)]))
    return df.agg(*aggs).select(rows.alias("x")).select("x.*")


def head(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """First ``n`` rows by an explicit order (Spark rows have no index);
    the distributed top-k keeps ``n`` rows per task."""
    keys = list(order_by) if order_by else df.columns
    return df.orderBy(*[F.col(_q(c)) for c in keys]).limit(n)


def column_moments(df: DataFrame, column: str) -> DataFrame:
    """N, mean, median, sd and bias-corrected skewness / kurtosis of a
    numeric column (trap T9); for a categorical column n, unique, top, freq."""
    validate_columns(df, [column])
    if not is_numeric_type(df.schema[column].dataType):
        return describe_categorical(df, [column]).drop("position")
    v = F.col(_q(column)).cast("double")
    middle = column_quantiles(df, [column], [0.5])[column]
    m = df.agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.lit(middle[0] if middle else None).cast("double").alias("median"),
               F.stddev_samp(v).alias("std"), F.skewness(v).alias("g1"),
               F.kurtosis(v).alias("g2"))
    n = F.col("n")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    return m.select(F.lit(column).alias("column"), n.cast("long").alias("n"), "mean", "median",
                    "std", skew.alias("skew"), kurt.alias("kurtosis"))
