"""Row filters.

Two forms, both plain Catalyst predicates that push down to the scan:

* structured conditions ``(column, op, value)`` with the workbench's null
  rules (trap T3): ``!=`` and ``not in`` keep missing rows, and ``not``
  keeps rows where the inner test is unknown;
* Spark SQL text through ``F.expr`` with plain SQL null rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.expressions import require_plain
from tablesmith.functions.types import validate_columns
from tablesmith.sources.files import nan_to_null


def _leaf(column: str, op: str, value, raw_floats=frozenset()) -> Column:
    c = F.col(f"`{column}`")
    op = op.strip().lower()
    if column in raw_floats:
        # NaN is a missing value, which compares as the largest number: guard the ops that it would pass
        plain = _leaf(column, op, value)
        if op in ("!=", "not in"):
            return plain | F.isnan(c)
        return plain & ~F.isnan(c) if op in ("==", "=", ">", ">=", "in") else plain
    if op in ("==", "="):
        return c == F.lit(value)
    if op == "!=":
        # spelled so the scan can take it: NOT (x = v) OR x IS NULL
        return (c != F.lit(value)) | c.isNull()
    if op == ">":
        return c > F.lit(value)
    if op == ">=":
        return c >= F.lit(value)
    if op == "<":
        return c < F.lit(value)
    if op == "<=":
        return c <= F.lit(value)
    if op == "in":
        return c.isin(list(value))
    if op == "not in":
        return (~c.isin(list(value))) | c.isNull()
    if op == "between":
        lo, hi = value
        return (c > F.lit(lo)) & (c < F.lit(hi))
    raise ValueError(f"Unknown operator: {op}")


def condition(spec, raw_floats=frozenset()) -> Column:
    """``spec`` is ``(col, op, value)``, ``("not", spec)``,
    ``("and", [spec, ...])`` or ``("or", [spec, ...])``. A chained comparison
    ``lo < x < hi`` is ``(x, "between", (lo, hi))``. ``raw_floats`` names the
    columns that still hold NaN for a missing value."""
    head = spec[0]
    if isinstance(head, str) and head.lower() == "not" and len(spec) == 2:
        inner = condition(spec[1], raw_floats)
        # true when the inner test is false or unknown
        return (~inner) | inner.isNull()
    if isinstance(head, str) and head.lower() in ("and", "or") and len(spec) == 2:
        parts = [condition(s, raw_floats) for s in spec[1]]
        if not parts:
            raise ValueError("Empty condition list")
        out = parts[0]
        for p in parts[1:]:
            out = (out & p) if head.lower() == "and" else (out | p)
        return out
    column, op, value = spec
    return _leaf(column, op, value, raw_floats)


def _columns_of(spec) -> list[str]:
    head = spec[0]
    if isinstance(head, str) and head.lower() == "not" and len(spec) == 2:
        return _columns_of(spec[1])
    if isinstance(head, str) and head.lower() in ("and", "or") and len(spec) == 2:
        return [c for s in spec[1] for c in _columns_of(s)]
    return [spec[0]]


def filter_rows(df: DataFrame, spec) -> DataFrame:
    validate_columns(df, _columns_of(spec))
    # a NULL predicate drops the row, as false does; no wrapper, so the
    # predicate stays translatable into the scan's pushed filters
    return df.filter(condition(spec))


def scan_where(spark: SparkSession, path: str, spec) -> DataFrame:
    """Parquet rows that meet ``spec``, NaN read as missing. The comparison is
    on the stored column, so the scan takes it; NaN is rewritten afterwards."""
    df = spark.read.parquet(path)
    validate_columns(df, _columns_of(spec))
    floats = frozenset(f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType)))
    return nan_to_null(df.filter(condition(spec, floats)))


def filter_expression(df: DataFrame, text: str) -> DataFrame:
    """Spark SQL predicate text; unknown names fail analysis before any job."""
    if not text or not text.strip():
        raise ValueError("Empty filter expression")
    out = df.filter(F.expr(text))
    require_plain(df, out)
    return out
