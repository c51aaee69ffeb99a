"""Declarative cleaning steps (V1) and preview (V2).

A step list is validated completely before any Spark job runs, then folded
with ``DataFrame.transform``. Every cleaning operator is registered.
"""

from __future__ import annotations

import inspect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.operators import dedupe, encode, knn, missing, outliers, profile, scale, text


def _encode(df, columns, method="label"):
    if method == "label":
        return encode.encode_label(df, columns)
    if method == "onehot":
        return encode.encode_onehot(df, columns)
    raise ValueError(f"{method!r} is no encoder: label or onehot")


def _outliers(df, column, action_type="remove", iqr_multiplier=1.5):
    return outliers.handle_outliers(df, column, action_type, iqr_multiplier)


def _knn(df, columns, k=5, tie_key=None):
    return knn.knn_impute(df, columns, k, tie_key)[0]


ACTIONS = {
    "handle_missing": missing.handle_missing,
    "remove_duplicates": lambda df, subset=None: dedupe.remove_duplicates(df, subset),
    "scale_columns": scale.scale_columns,
    "encode_columns": _encode,
    "handle_outliers": _outliers,
    "standardize_text": text.standardise_text,
    "coerce_types": text.coerce_types,
    "knn_impute": _knn,
}


def columns_after(columns: list[str], step: dict) -> list[str]:
    """The columns a step leaves; one-hot columns, whose names the data decide, as ``name_*``."""
    if step["action"] != "encode_columns" or step.get("method", "label") != "onehot":
        return columns
    return [f"{c}_*" if c in step["columns"] else c for c in columns]


def _known(name: str, columns: list[str]) -> bool:
    return name in columns or any(c.endswith("_*") and name.startswith(c[:-1]) for c in columns)


def validate_steps(df: DataFrame, steps: list[dict]) -> None:
    """Refuse an unknown action, unknown or missing parameters, or a column
    that a step won't find, before anything runs. The columns are carried
    through the steps."""
    columns = list(df.columns)
    for i, step in enumerate(steps):
        if "action" not in step:
            raise ValueError(f"Step {i}: no action")
        action = step["action"]
        if action not in ACTIONS:
            raise ValueError(f"Step {i}: unknown action {action!r}")
        fn = ACTIONS[action]
        params = {k: v for k, v in step.items() if k != "action"}
        sig = inspect.signature(fn)
        try:
            sig.bind(df, **params)
        except TypeError as exc:
            raise ValueError(f"Step {i} ({action}): {exc}") from None
        named = []
        for key in ("columns", "column", "subset"):
            v = params.get(key)
            if isinstance(v, str):
                named.append(v)
            elif v:
                named.extend(v)
        missing_cols = [c for c in named if not _known(c, columns)]
        if missing_cols:
            raise ValueError(f"Step {i} ({action}): unknown column(s) {missing_cols}")
        columns = columns_after(columns, step)


def run_steps(df: DataFrame, steps: list[dict]) -> DataFrame:
    validate_steps(df, steps)
    for step in steps:
        params = {k: v for k, v in step.items() if k != "action"}
        df = df.transform(lambda d, fn=ACTIONS[step["action"]], p=params: fn(d, **p))
    return df


def preview(df: DataFrame, steps: list[dict], n: int = 20, order_by=None):
    """V2: the first ``n`` rows of the result (explicit order) and its row and
    column counts, without saving anything."""
    out = run_steps(df, steps)
    head = profile.head(out, n, order_by)
    summary = out.agg(F.count("*").alias("rows")).withColumn("cols", F.lit(len(out.columns)))
    return head, summary
