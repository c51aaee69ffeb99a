"""Missing values (M1-M7). Fitted fill values come from one aggregate over
the chosen columns and are applied as literals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.quantile import column_modes, column_quantiles
from tablesmith.functions.types import is_numeric_type, resolve_columns, validate_columns


def _q(c: str) -> str:
    return f"`{c}`"


def dropna_rows(df: DataFrame, columns=None) -> DataFrame:
    """M1: drop rows with a gap in any of ``columns`` (all when None)."""
    cols = resolve_columns(df, columns)
    validate_columns(df, cols)
    return df.na.drop(how="any", subset=cols)


def dropna_cols(df: DataFrame, columns=None) -> DataFrame:
    """M2: drop those of ``columns`` that have any gap (one null-count job)."""
    if columns is not None and len(columns) == 0:
        raise ValueError("No columns chosen to drop")
    cols = resolve_columns(df, columns)
    validate_columns(df, cols)
    counts = df.agg(*[F.count_if(F.col(_q(c)).isNull()).alias(f"c{i}")
                      for i, c in enumerate(cols)]).first()
    to_drop = [c for i, c in enumerate(cols) if counts[f"c{i}"] > 0]
    return df.drop(*to_drop)


def _fit(df: DataFrame, cols: list[str], how: str) -> dict:
    if not cols:
        return {}
    if how == "median":
        return {c: q and q[0] for c, q in column_quantiles(df, cols, [0.5]).items()}
    if how == "mode":
        return column_modes(df, cols)
    row = df.agg(*[F.avg(F.col(_q(c))).alias(f"v{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"v{i}"] for i, c in enumerate(cols)}


def _apply(df: DataFrame, fills: dict) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if f.name in fills and fills[f.name] is not None:
            out.append(F.coalesce(F.col(_q(f.name)), F.lit(fills[f.name])).alias(f.name))
        else:
            out.append(F.col(_q(f.name)))
    return df.select(*out)


def fill_mean(df: DataFrame, columns=None) -> DataFrame:
    """M3: numeric columns only; an all-null column is left as is."""
    cols = [c for c in resolve_columns(df, columns)
            if c in df.columns and is_numeric_type(df.schema[c].dataType)]
    return _apply(df, _fit(df, cols, "mean"))


def fill_median(df: DataFrame, columns=None) -> DataFrame:
    """M4: exact median (linear interpolation)."""
    cols = [c for c in resolve_columns(df, columns)
            if c in df.columns and is_numeric_type(df.schema[c].dataType)]
    return _apply(df, _fit(df, cols, "median"))


def fill_mode(df: DataFrame, columns=None) -> DataFrame:
    """M5: most frequent value, smallest on ties (trap T10)."""
    cols = [c for c in resolve_columns(df, columns) if c in df.columns]
    return _apply(df, _fit(df, cols, "mode"))


def parse_constant(text):
    """Text typed by a user -> bool, int, float or the text itself."""
    if not isinstance(text, str):
        return text
    s = text.strip()
    if s.lower() in ("true", "false"):
        return s.lower() == "true"
    try:
        return int(s)
    except ValueError:
        pass
    try:
        return float(s)
    except ValueError:
        return text


def _constant_for(dt: T.DataType, value):
    """Cast the constant to the column type or refuse (trap T18)."""
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return str(value) if not isinstance(value, bool) else str(value)
    if isinstance(dt, T.BooleanType):
        if isinstance(value, bool):
            return value
        raise ValueError(f"{value!r} is not a boolean")
    if isinstance(dt, T.IntegralType):
        if isinstance(value, bool) or not float(value).is_integer():
            raise ValueError(f"{value!r} does not fit an integer column")
        return int(value)
    if isinstance(dt, T.NumericType):
        if isinstance(value, bool):
            raise ValueError(f"{value!r} is not a number")
        return float(value)
    raise ValueError(f"Cannot fill a {dt.simpleString()} column with a constant")


def fill_constant(df: DataFrame, columns=None, value="0") -> DataFrame:
    """M6: fill with a parsed constant, cast to each column's type."""
    v = parse_constant("0" if value is None else value)
    cols = [c for c in resolve_columns(df, columns) if c in df.columns]
    fills = {}
    for c in cols:
        dt = df.schema[c].dataType
        try:
            fills[c] = _constant_for(dt, v)
        except (ValueError, TypeError) as exc:
            raise ValueError(f"Column {c}: {exc}") from None
    out = [F.coalesce(F.col(_q(f.name)), F.lit(fills[f.name]).cast(f.dataType)).alias(f.name)
           if f.name in fills else F.col(_q(f.name)) for f in df.schema.fields]
    return df.select(*out)


def handle_missing(df: DataFrame, columns=None, strategy: str = "drop_rows",
                   constant_value=None) -> DataFrame:
    """One entry point over M1-M6, as a cleaning step."""
    table = {"drop_rows": dropna_rows, "drop_cols": dropna_cols, "mean": fill_mean,
             "median": fill_median, "mode": fill_mode}
    if strategy == "constant":
        return fill_constant(df, columns, constant_value)
    if strategy not in table:
        raise ValueError(f"Unknown strategy: {strategy}")
    return table[strategy](df, columns)


def fill_to_column(df: DataFrame, column: str, strategy: str = "mean", fill_value=None,
                   new_column: str | None = None) -> tuple[DataFrame, object]:
    """M7: fill one column into ``new_column`` (or in place) and report the
    value used. Raises when there is no mode or no constant."""
    validate_columns(df, [column])
    dt = df.schema[column].dataType
    if strategy in ("mean", "median"):
        if not is_numeric_type(dt):
            raise ValueError(f"Column '{column}' is not numeric.")
        value = _fit(df, [column], strategy)[column]
    elif strategy == "mode":
        value = _fit(df, [column], "mode")[column]
        if value is None:
            raise ValueError(f"Column '{column}' has no mode (all values missing).")
    elif strategy == "constant":
        if fill_value is None:
            raise ValueError("A constant fill needs fill_value.")
        value = _constant_for(dt, parse_constant(fill_value))
    else:
        raise ValueError(f"Unknown strategy: {strategy}")
    target = new_column or column
    filled = F.coalesce(F.col(_q(column)), F.lit(value)) if value is not None else F.col(_q(column))
    return df.withColumn(target, filled), value
