"""Column classes and argument checks (the data-model rules of the survey).

Numeric = Spark ``NumericType`` (Boolean is *not* numeric here); categorical =
string or boolean. Timestamps are neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def is_categorical_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.BooleanType, T.VarcharType, T.CharType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_categorical_type(f.dataType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not is_numeric_type(f.dataType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def dtype_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def validate_columns(df: DataFrame, columns) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Column(s) not found: {missing}")


def require_numeric(df: DataFrame, columns) -> None:
    validate_columns(df, columns)
    bad = [c for c in columns if not is_numeric_type(dtype_of(df, c))]
    if bad:
        raise ValueError(f"Column(s) {bad} are not numeric.")


def require_categorical(df: DataFrame, columns) -> None:
    validate_columns(df, columns)
    bad = [c for c in columns if not is_categorical_type(dtype_of(df, c))]
    if bad:
        raise ValueError(f"Column(s) {bad} are not categorical.")


def resolve_columns(df: DataFrame, columns) -> list[str]:
    """``None`` or empty means every column."""
    return list(columns) if columns else list(df.columns)


def round_half_up(c, digits: int):
    """floor(x * 10^d + 0.5) / 10^d, in doubles at any magnitude: beyond 2^52 a
    double has no fraction to cut, and the detour over BIGINT would saturate."""
    y = c * F.lit(float(10 ** digits)) + F.lit(0.5)
    return F.when(F.abs(y) < float(2 ** 52), F.floor(y).cast("double")).otherwise(y) / F.lit(float(10 ** digits))
