"""Text clean-up and type coercion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.types import resolve_columns, string_columns
from tablesmith.sources.events import guarded_double


def standardise_text(df: DataFrame, columns=None, strip: bool = True, case: str = "lower") -> DataFrame:
    """Trim, collapse Unicode whitespace runs to one space (trap T14),
    then lower / upper / title (``initcap``) / none. Missing stays missing."""
    if case not in ("lower", "upper", "title", "none"):
        raise ValueError(f"Unknown case: {case}")
    cols = set(columns) if columns else set(string_columns(df))
    out = []
    for f in df.schema.fields:
        if f.name not in cols:
            out.append(F.col(f"`{f.name}`"))
            continue
        s = F.col(f"`{f.name}`").cast("string")
        if strip:
            s = F.trim(F.regexp_replace(s, r"(?U)\s+", " "))
        if case == "lower":
            s = F.lower(s)
        elif case == "upper":
            s = F.upper(s)
        elif case == "title":
            s = F.initcap(s)
        out.append(s.alias(f.name))
    return df.select(*out)


def coerce_types(df: DataFrame, columns=None, target: str = "numeric") -> DataFrame:
    """N2 ``numeric``: text that is not plain numeric becomes missing (trap
    T15); numeric columns stay. N3 ``string``: cast to text, missing stays
    missing (trap T11)."""
    if target not in ("numeric", "string"):
        raise ValueError(f"{target!r} is no target type: numeric or string")
    cols = set(resolve_columns(df, columns))
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name not in cols:
            out.append(c)
        elif target == "string":
            out.append(c.cast("string").alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            out.append(c)
        elif isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType)):
            v = guarded_double(c)
            out.append(F.nanvl(v, F.lit(None).cast("double")).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
