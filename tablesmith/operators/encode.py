"""Categorical encoding (C4 label, C5 one-hot, F7 feature one-hot).

Label codes are ranks of the distinct labels: the labels are cut into ranges at
sampled bounds, ranked inside each range and moved up by the ranges before, so
no task sees all labels. One-hot output has a column per category, so its
category list is read by the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.ranks import bucket_of
from tablesmith.functions.types import require_categorical, validate_columns
from tablesmith.session import shuffle_partitions

#: Labels that are sampled for each range.
_PER_RANGE = 20
#: Labels whose codes are broadcast, at most; more are joined by shuffle, with the same rows.
BROADCAST_LABELS = 200_000


def _label_text(c: str):
    # missing sorts among the others as the literal 'nan' (trap T12)
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan"))


def label_map(df: DataFrame, column: str) -> DataFrame:
    """(label, code): code = rank of the label among the sorted distinct labels; with the hint to broadcast few labels."""
    labels = df.select(_label_text(column).alias("label")).distinct()
    ranges = shuffle_partitions(df.sparkSession)
    n = labels.count()
    share = min(1.0, _PER_RANGE * ranges / max(1, n))
    picked = sorted(r["label"] for r in labels.where(
        F.pmod(F.xxhash64("label"), F.lit(1 << 20)) < share * (1 << 20)).collect())
    bounds = picked[::_PER_RANGE]
    ranged = labels.withColumn("_r", bucket_of(F.col("label"), bounds))
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_r").agg(F.count("*").alias("_n"))  # one row per range
    offsets = sizes.select("_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_r").orderBy("label"))
    codes = (ranged.withColumn("_i", inside).join(F.broadcast(offsets), "_r")
             .select("label", (F.col("_before") + F.col("_i") - 1).cast("long").alias("code")))
    return F.broadcast(codes) if n <= BROADCAST_LABELS else codes


def encode_label(df: DataFrame, columns) -> DataFrame:
    """C4: code = rank of the label among the sorted distinct labels."""
    columns = list(columns)
    validate_columns(df, columns)
    out = df
    for i, c in enumerate(columns):
        m = label_map(df, c).withColumnRenamed("label", f"_l{i}")
        out = (out.withColumn(f"_l{i}", _label_text(c))
               .join(m, f"_l{i}", "left")
               .withColumn(c, F.col("code")).drop(f"_l{i}", "code"))
    return out.select(*df.columns)


def distinct_labels(df: DataFrame, column: str, max_labels: int | None = None) -> list:
    """Sorted categories, for output with a column each; more than ``max_labels`` are refused."""
    found = df.select(F.col(f"`{column}`").alias("v")).filter(F.col("v").isNotNull()).distinct()
    rows = (found.limit(max_labels + 1) if max_labels is not None else found).collect()
    if max_labels is not None and len(rows) > max_labels:
        raise ValueError(f"{column} has more than {max_labels} distinct values")
    return sorted(r["v"] for r in rows)


def encode_onehot(df: DataFrame, columns, max_labels: int = 1000) -> DataFrame:
    """Replace each column by integer indicator columns ``col_value``;
    a missing value gives all zeros. A column with more than ``max_labels``
    categories is refused, as each becomes a column."""
    columns = list(columns)
    validate_columns(df, columns)
    out = []
    for f in df.schema.fields:
        if f.name not in columns:
            out.append(F.col(f"`{f.name}`"))
            continue
        for v in distinct_labels(df, f.name, max_labels):
            out.append(F.coalesce((F.col(f"`{f.name}`") == F.lit(v)).cast("int"), F.lit(0))
                       .alias(f"{f.name}_{v}"))
    return df.select(*out)


def onehot_feature(df: DataFrame, column: str, prefix: str | None = None,
                   drop_first: bool = False, max_labels: int = 50) -> DataFrame:
    """boolean indicator columns appended after the original, which is
    kept; at most ``max_labels`` categories."""
    require_categorical(df, [column])
    labels = distinct_labels(df, column, max_labels)
    if drop_first:
        labels = labels[1:]
    p = prefix or column
    new = [F.coalesce(F.col(f"`{column}`") == F.lit(v), F.lit(False))
           .alias(f"{p}_{v}") for v in labels]
    return df.select("*", *new)
