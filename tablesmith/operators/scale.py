"""Scaling (C1-C3), in place on the chosen columns.

standard: (x - mean) / population sd; minmax: (x - min) / (max - min);
robust: (x - median) / IQR with linearly interpolated quartiles. A zero
scale becomes 1, so a constant column maps to 0 (trap T8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.quantile import column_quantiles
from tablesmith.functions.types import require_numeric


def fit_scaler(df: DataFrame, columns, method: str = "standard") -> dict:
    columns = list(columns)
    require_numeric(df, columns)
    aggs = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)]
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        if method == "standard":
            aggs += [F.avg(v).alias(f"a{i}"), F.stddev_pop(v).alias(f"b{i}")]
        elif method == "minmax":
            aggs += [F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}")]
        elif method != "robust":
            raise ValueError(f"{method!r} is no scaler: standard, minmax or robust")
    row = df.agg(*aggs).first()
    empty = [c for i, c in enumerate(columns) if row[f"n{i}"] == 0]
    if empty:
        raise ValueError(f"No values to fit a scale on: {empty}")
    parts = column_quantiles(df, columns, [0.25, 0.5, 0.75]) if method == "robust" else {}
    params = {}
    for i, c in enumerate(columns):
        if method == "standard":
            center, scale = row[f"a{i}"], row[f"b{i}"]
        elif method == "minmax":
            center, scale = row[f"a{i}"], row[f"b{i}"] - row[f"a{i}"]
        else:
            q1, med, q3 = parts[c]
            center, scale = med, q3 - q1
        params[c] = (float(center), float(scale) if scale else 1.0)
    return params


def scale_columns(df: DataFrame, columns, method: str = "standard") -> DataFrame:
    params = fit_scaler(df, columns, method)
    out = []
    for f in df.schema.fields:
        if f.name in params:
            center, scale = params[f.name]
            out.append(((F.col(f"`{f.name}`").cast("double") - F.lit(center)) / F.lit(scale))
                       .alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
