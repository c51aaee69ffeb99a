"""The three equal-width bin rules (survey traps T4, T5, T6).

All three take ``lo``/``hi`` fitted by one aggregate and build plain Column
arithmetic, so the bucket stays inside whole-stage codegen and the same
expression can be written in SQL for the oracle.

* ``hist_bucket``   (T4) left-closed bins, last bin closed; a constant column
  is widened to [v-0.5, v+0.5].
* ``cut_code``      (T5) right-closed bins, first edge lowered by 0.1 % of the
  range; code = number of interior edges strictly below x.
* ``trend_bucket``  (T6) digitize-and-clip; a constant column lands in the
  last bin.

Interior edges are ``lo + i * ((hi - lo) / n)``, evaluated identically in
Python, Spark and SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hist_range(lo: float, hi: float) -> tuple[float, float]:
    if lo == hi:
        return lo - 0.5, hi + 0.5
    return lo, hi


def hist_edges(lo: float, hi: float, n: int) -> list[float]:
    lo, hi = hist_range(lo, hi)
    step = (hi - lo) / n
    return [lo + i * step for i in range(n)] + [hi]


def hist_bucket(x: Column, lo: float, hi: float, n: int) -> Column:
    lo, hi = hist_range(lo, hi)
    raw = F.floor((x - F.lit(lo)) * F.lit(float(n)) / F.lit(hi - lo))
    # least() skips NULL, so a missing x must be kept missing explicitly.
    return F.when(x.isNull(), F.lit(None).cast("long")).otherwise(
        F.least(F.lit(n - 1).cast("long"), raw).cast("long"))


def interior_edges(lo: float, hi: float, n: int) -> list[float]:
    step = (hi - lo) / n
    return [lo + i * step for i in range(1, n)]


def cut_range(lo: float, hi: float) -> tuple[float, float]:
    """Outer edges of right-closed bins (pandas ``cut`` with an int)."""
    if lo == hi:
        pad = 0.001 * abs(lo) if lo != 0 else 0.001
        return lo - pad, hi + pad
    return lo, hi


def cut_edges(lo: float, hi: float, n: int) -> list[float]:
    a, b = cut_range(lo, hi)
    inner = interior_edges(a, b, n)
    first = a - 0.001 * (b - a) if lo != hi else a
    return [first] + inner + [b]


def cut_code(x: Column, lo: float, hi: float, n: int) -> Column:
    a, b = cut_range(lo, hi)
    terms = [F.when(x > F.lit(e), 1).otherwise(0) for e in interior_edges(a, b, n)]
    code = sum(terms[1:], terms[0]) if terms else F.lit(0)
    return F.when(x.isNull(), None).otherwise(code.cast("long"))


def trend_bucket(x: Column, lo: float, hi: float, n: int) -> Column:
    terms = [F.when(x >= F.lit(e), 1).otherwise(0) for e in interior_edges(lo, hi, n)]
    code = sum(terms[1:], terms[0]) if terms else F.lit(0)
    return F.when(x.isNull(), None).otherwise(code.cast("long"))


def trend_midpoints(lo: float, hi: float, n: int) -> list[float]:
    step = (hi - lo) / n
    edges = [lo + i * step for i in range(n)] + [hi]
    return [0.5 * (edges[i] + edges[i + 1]) for i in range(n)]


# SQL spellings for the oracle (DuckDB) -------------------------------------

def sql_hist_bucket(x: str, lo: str, hi: str, n: int) -> str:
    """``lo``/``hi`` are SQL expressions already widened for constants."""
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE "
            f"CAST(LEAST({n - 1}, FLOOR(({x} - {lo}) * {float(n)} / ({hi} - {lo}))) AS BIGINT) END")


def sql_trend_bucket(x: str, lo: str, hi: str, n: int) -> str:
    terms = " + ".join(f"(CASE WHEN {x} >= {lo} + {i} * (({hi} - {lo}) / {n}) THEN 1 ELSE 0 END)"
                       for i in range(1, n))
    return f"CAST(({terms}) AS BIGINT)"


def sql_cut_code(x: str, lo: str, hi: str, n: int) -> str:
    terms = " + ".join(f"(CASE WHEN {x} > {lo} + {i} * (({hi} - {lo}) / {n}) THEN 1 ELSE 0 END)"
                       for i in range(1, n))
    return f"CAST(({terms}) AS BIGINT)"
