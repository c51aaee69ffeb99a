"""Two-column dispatch by type.

Numeric x numeric: ``hist`` (2-D counts), ``scatter``, ``line`` (trend or
sorted sample), ``joint`` (marginals), ``contour`` (density grid).
Numeric x categorical (swapped so the numeric column is x): ``box``,
``violin``, ``swarm``, ``swarmonbox`` (box statistics; the points behind them
come from ``two_column_points``) or ``bar``. Categorical x categorical: contingency.
Anything else (timestamps, arrays) is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablesmith.functions.types import is_categorical_type, is_numeric_type, validate_columns
from tablesmith.operators.eda import counts, density, groups


def two_columns(df: DataFrame, x: str, y: str, hue: str | None = None, kind: str | None = None,
                **kw) -> DataFrame:
    validate_columns(df, [x, y] + ([hue] if hue else []))
    tx, ty = df.schema[x].dataType, df.schema[y].dataType
    if is_numeric_type(tx) and is_numeric_type(ty):
        kind = (kind or "hist").lower()
        if kind == "hist":
            return counts.histogram_2d(df, x, y, kw.get("bins", 40))
        if kind == "scatter":
            return counts.scatter_sample(df, x, y, hue, kw.get("max_points", 5000))
        if kind == "line":
            nbins = kw.get("nbins", 30)
            if hue:
                by_hue = counts.groups_by_category(df, hue)
                if not nbins:
                    return counts.lines_raw_by_group(by_hue, x, y, kw.get("max_points", 5000))
                return counts.lines_mean_by_group(by_hue, x, y, nbins)
            if nbins and nbins > 1:
                return counts.trend_line(df, x, y, nbins)
            return counts.raw_line(df, x, y, kw.get("max_points", 5000))
        if kind == "joint":
            return counts.joint_marginals(df, x, y, kw.get("bins", 30))
        if kind in ("contour", "kde"):
            return density.density_grid(df, x, y, kw.get("gridsize", 60))
        raise ValueError(f"Invalid kind for numeric-numeric: {kind}")
    if is_categorical_type(tx) and is_numeric_type(ty):
        x, y, tx, ty = y, x, ty, tx
    if is_numeric_type(tx) and is_categorical_type(ty):
        kind = (kind or "box").lower()
        if kind in ("box", "violin", "swarm", "swarmonbox"):
            return groups.group_box_stats(df, x, y, hue)
        if kind == "bar":
            return groups.group_bar(df, x, y, hue)
        raise ValueError(f"Invalid kind for numeric-categorical: {kind}")
    if is_categorical_type(tx) and is_categorical_type(ty):
        return groups.contingency(df, x, y)
    raise ValueError(f"Unsupported column types: {tx.simpleString()} and {ty.simpleString()}")


def two_column_points(df: DataFrame, x: str, y: str, hue: str | None = None, kind: str = "box", max_points: int | None = 5000) -> DataFrame:
    """The rows behind a numeric x categorical plot (A12): the numeric value, its group and its hue, up to
    ``max_points`` rows in all. The columns may be named in either order; a bar plot has no points."""
    validate_columns(df, [x, y] + ([hue] if hue else []))
    if is_categorical_type(df.schema[x].dataType) and is_numeric_type(df.schema[y].dataType):
        x, y = y, x
    if not (is_numeric_type(df.schema[x].dataType) and is_categorical_type(df.schema[y].dataType)):
        raise ValueError(f"{x} and {y} are not a numeric and a categorical column")
    if kind.lower() not in ("box", "violin", "swarm", "swarmonbox"):
        raise ValueError(f"Invalid kind for numeric-categorical points: {kind}")
    return counts.scatter_sample(df, x, y, hue, max_points)
