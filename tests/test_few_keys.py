"""Few groups or labels are broadcast: no task gets all rows of one of them."""

import pytest
from pyspark.sql import functions as F

from tablesmith.functions import sampling
from tablesmith.operators import encode


@pytest.fixture()
def large(spark):
    """Tables count as too large to broadcast unasked."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark):
    return spark.range(4000).select(F.when(F.col("id") % 50 != 0, (F.col("id") % 4 == 0).cast("string")).alias("g"), F.col("id").alias("x"), F.lit(1.5).alias("y"))


def test_sample_by_group_leaves_the_rows_where_they_are(spark, large, monkeypatch):
    df = rows(spark)
    got = sampling.sample_rows(df, ["g", "x"], 30, "g")
    assert "SortMergeJoin" not in plan(got)
    monkeypatch.setattr(sampling, "BROADCAST_GROUPS", 0)
    other = sampling.sample_rows(df, ["g", "x"], 30, "g")
    assert "SortMergeJoin" in plan(other)
    assert sorted(map(str, got.collect())) == sorted(map(str, other.collect())) and got.count() == 90


def test_label_codes_go_to_the_rows(spark, large, monkeypatch):
    df = rows(spark)
    got = encode.encode_label(df, ["g"])
    assert "SortMergeJoin" not in plan(got)
    monkeypatch.setattr(encode, "BROADCAST_LABELS", 0)
    other = encode.encode_label(df, ["g"])
    assert "SortMergeJoin" in plan(other)
    assert sorted(map(str, got.collect())) == sorted(map(str, other.collect())) and got.count() == 4000
