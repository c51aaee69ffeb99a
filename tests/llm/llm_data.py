"""Rows for the tests."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    *[T.StructField(c, T.StringType()) for c in ("node", "id", "d", "row", "component_id", "score", "live", "kept_id", "t", "at")]])


def words(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary):x}" for _ in range(n)]


def frame(spark, rows):
    """(doc_id, text[, lang, source]) rows with the extra columns filled."""
    full = [(r + (None,) * 4)[:4] + ((len(r[1]) if r[1] is not None else None),) + ("x",) * 10 for r in map(tuple, rows)]
    return spark.createDataFrame(full, SCHEMA)
