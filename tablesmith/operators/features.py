"""Feature transforms (F1-F11) behind one dispatcher.

Each transform returns ``(DataFrame, info)``; ``info`` records inputs,
outputs and fitted values, the provenance a saved version keeps.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.expressions import require_plain
from tablesmith.functions import bins as B
from tablesmith.functions.types import require_numeric, validate_columns
from tablesmith.operators import encode, missing


def _c(name: str):
    return F.col(f"`{name}`")


def log_feature(df, col1, new_column=None):
    """log(1 + x); refuses values below -1 (one min() check)."""
    require_numeric(df, [col1])
    lo = df.agg(F.min(_c(col1)).alias("m")).first()["m"]
    if lo is not None and lo < -1:
        raise ValueError(f"{col1} goes below -1, where log1p has no value")
    out = new_column or f"log_{col1}"
    return df.withColumn(out, F.log1p(_c(col1).cast("double"))), {
        "feature_type": "log", "input_columns": [col1], "output_columns": [out]}


def square_feature(df, col1, new_column=None):
    """F2."""
    require_numeric(df, [col1])
    out = new_column or f"{col1}_squared"
    x = _c(col1).cast("double")
    return df.withColumn(out, x * x), {"feature_type": "square", "input_columns": [col1],
                                        "output_columns": [out]}


def cube_feature(df, col1, new_column=None):
    """F3."""
    require_numeric(df, [col1])
    out = new_column or f"{col1}_cubed"
    x = _c(col1).cast("double")
    return df.withColumn(out, x * x * x), {"feature_type": "cube", "input_columns": [col1],
                                            "output_columns": [out]}


def interaction_feature(df, col1, col2, new_column=None):
    """product as double."""
    require_numeric(df, [col1, col2])
    out = new_column or f"{col1}_x_{col2}"
    return df.withColumn(out, _c(col1).cast("double") * _c(col2).cast("double")), {
        "feature_type": "interaction", "input_columns": [col1, col2], "output_columns": [out]}


def ratio_feature(df, col1, col2, new_column=None, count_zero: bool = True):
    """a / b; a zero denominator gives missing (trap T2), and the number
    of such rows is reported."""
    require_numeric(df, [col1, col2])
    out = new_column or f"{col1}_div_{col2}"
    info = {"feature_type": "ratio", "input_columns": [col1, col2], "output_columns": [out]}
    if count_zero:
        info["zero_denominators"] = df.agg(F.count_if(_c(col2) == 0).alias("z")).first()["z"]
    return df.withColumn(out, F.try_divide(_c(col1).cast("double"), _c(col2).cast("double"))), info


def bin_feature(df, col1, bins: int = 4, new_column=None, labels: bool = False):
    """equal-width right-closed bins (trap T5); integer codes or
    ``(lo, hi]`` labels."""
    require_numeric(df, [col1])
    if bins < 2:
        raise ValueError("bins must be at least 2.")
    r = df.agg(F.min(_c(col1)).alias("lo"), F.max(_c(col1)).alias("hi")).first()
    if r["lo"] is None:
        raise ValueError(f"Column '{col1}' has no values")
    lo, hi = float(r["lo"]), float(r["hi"])
    out = new_column or f"{col1}_binned"
    code = B.cut_code(_c(col1).cast("double"), lo, hi, bins)
    if labels:
        edges = B.cut_edges(lo, hi, bins)
        text = [f"({edges[i]:.3f}, {edges[i + 1]:.3f}]" for i in range(bins)]
        value = F.element_at(F.array(*[F.lit(t) for t in text]), (code + 1).cast("int"))
    else:
        value = code
    return df.withColumn(out, value), {"feature_type": "binning", "input_columns": [col1],
                                        "output_columns": [out], "bins": bins, "min": lo, "max": hi}


def onehot_feature(df, col1, prefix=None, drop_first=False):
    """see ``encode.onehot_feature``."""
    before = set(df.columns)
    res = encode.onehot_feature(df, col1, prefix, drop_first)
    return res, {"feature_type": "one_hot", "input_columns": [col1],
                 "output_columns": [c for c in res.columns if c not in before]}


def zscore_feature(df, col1, new_column=None):
    """F8: (x - mean) / sample sd; refuses sd 0 or undefined."""
    require_numeric(df, [col1])
    r = df.agg(F.avg(_c(col1)).alias("m"), F.stddev_samp(_c(col1)).alias("s")).first()
    if r["s"] is None or r["s"] == 0:
        raise ValueError(f"{col1} has no spread to standardise by")
    out = new_column or f"{col1}_zscore"
    return df.withColumn(out, (_c(col1).cast("double") - F.lit(r["m"])) / F.lit(r["s"])), {
        "feature_type": "standardize", "input_columns": [col1], "output_columns": [out],
        "mean": r["m"], "std": r["s"]}


def normalise_feature(df, col1, new_column=None):
    """(x - min) / (max - min); refuses a constant column."""
    require_numeric(df, [col1])
    r = df.agg(F.min(_c(col1)).alias("lo"), F.max(_c(col1)).alias("hi")).first()
    if r["lo"] is None or r["lo"] == r["hi"]:
        raise ValueError(f"{col1} has one value only, so no range")
    out = new_column or f"{col1}_normalized"
    lo, hi = float(r["lo"]), float(r["hi"])
    return df.withColumn(out, (_c(col1).cast("double") - F.lit(lo)) / F.lit(hi - lo)), {
        "feature_type": "normalize", "input_columns": [col1], "output_columns": [out],
        "min": lo, "max": hi}


def fillna_feature(df, col1, strategy="mean", fill_value=None, new_column=None):
    """F10 fill: see ``missing.fill_to_column``."""
    res, value = missing.fill_to_column(df, col1, strategy, fill_value, new_column)
    return res, {"feature_type": "fillna", "input_columns": [col1],
                 "output_columns": [new_column or col1], "fill_value": value}


def dropna_feature(df, col1=None):
    """F10 drop: rows with a gap in ``col1`` (all columns when None)."""
    res = missing.dropna_rows(df, [col1] if col1 else None)
    return res, {"feature_type": "dropna", "input_columns": [col1] if col1 else list(df.columns)}


def expression_feature(df, expr: str, new_column: str):
    """a named column from Spark SQL text, one value per row: aggregates
    fail analysis; generators, windows, subqueries and the JVM-reaching reflect
    functions are refused by what the analysed plan holds."""
    if not new_column or not new_column.strip():
        raise ValueError("The new column needs a name")
    if not expr or not expr.strip():
        raise ValueError("The expression is empty")
    out = df.withColumn(new_column.strip(), F.expr(expr))  # unknown columns and aggregates fail here
    require_plain(df, out)
    return out, {"feature_type": "custom_expr", "output_columns": [new_column.strip()],
                 "expression": expr}


_METHODS = {
    "log": lambda df, a, kw: log_feature(df, a, kw.get("new_column")),
    "square": lambda df, a, kw: square_feature(df, a, kw.get("new_column")),
    "cube": lambda df, a, kw: cube_feature(df, a, kw.get("new_column")),
    "interaction": lambda df, a, kw: interaction_feature(df, a, kw["col2"], kw.get("new_column")),
    "ratio": lambda df, a, kw: ratio_feature(df, a, kw["col2"], kw.get("new_column")),
    "binning": lambda df, a, kw: bin_feature(df, a, kw.get("bins", 4), kw.get("new_column"),
                                             kw.get("labels", False)),
    "one_hot": lambda df, a, kw: onehot_feature(df, a, kw.get("prefix"), kw.get("drop_first", False)),
    "standardize": lambda df, a, kw: zscore_feature(df, a, kw.get("new_column")),
    "normalize": lambda df, a, kw: normalise_feature(df, a, kw.get("new_column")),
    "fillna": lambda df, a, kw: fillna_feature(df, a, kw.get("strategy", "mean"), kw.get("fill_value"),
                                               kw.get("new_column")),
    "dropna": lambda df, a, kw: dropna_feature(df, a),
    "custom_expr": lambda df, a, kw: expression_feature(df, kw.get("expr"), kw.get("new_column")),
}


def apply_feature(df: DataFrame, method: str, col1: str | None = None, **kw):
    """Dispatcher over F1-F11."""
    if method not in _METHODS:
        raise ValueError(f"Unknown feature method: {method}")
    if col1 is not None:
        validate_columns(df, [col1])
    return _METHODS[method](df, col1, kw)
