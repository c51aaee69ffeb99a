"""Helpers shared by the registered queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.types import round_half_up

DIGITS = 7


def arith_round(c, digits: int = DIGITS):
    """floor(x * 10^d + 0.5) / 10^d: the same IEEE steps in Spark and in the
    oracle, so equal inputs round equally (Spark's ``round`` is decimal-based
    and breaks ties differently from DuckDB's)."""
    return round_half_up(c.cast("double"), digits)


def round_doubles(df: DataFrame, digits: int = DIGITS, only: list[str] | None = None) -> DataFrame:
    """Round double columns so the compare is stable under summation order."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (only is None or f.name in only):
            cols.append(arith_round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def sql_round(sql: str, cols: list[str], digits: int = DIGITS) -> str:
    """Wrap an oracle query so the named double columns are rounded."""
    if not cols:
        return sql
    scale = float(10 ** digits)
    repl = ", ".join(f"CAST(floor(CAST(\"{c}\" AS DOUBLE) * {scale} + 0.5) AS DOUBLE) / {scale} AS \"{c}\""
                     for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS _q"
