"""Samples by hash, column tables, appended logs, versions as of a save, steps checked ahead."""

import datetime
import hashlib
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tablesmith.functions import ranks
from tablesmith.functions.sampling import sample_rows
from tablesmith.operators import encode, profile
from tablesmith.operators.eda import counts, groups
from tablesmith.operators.eda.dispatch import two_column_points, two_columns
from tablesmith.plans import steps
from tablesmith.plans.tables import event_log, gappy_lineitem
from tablesmith.plans.versions import VersionStore
from tablesmith.sources.events import append_events, read_appended
from tests.conftest import SF_SMALL


def hashed(row):
    parts = ["~" if v is None else str(math.floor(v * 1e6 + 0.5)) if isinstance(v, float) else str(v) for v in row]
    return hashlib.md5("|".join([*parts, "0"]).encode()).hexdigest()


def test_samples_per_group(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.random(), rng.randrange(5)) for _ in range(3000)] + [("hot", 1.0, 1)] * 2000 + [("hot", rng.random(), 2) for _ in range(50)] + [("few", 0.5, None)] * 3
    df = spark.createDataFrame(rows, "g string, x double, n int").repartition(5)
    for k in (1, 40, 100):
        got = sample_rows(df, ["g", "x", "n"], k, "g").collect()
        for g in ("a", "b", None, "hot", "few"):
            want = sorted((r for r in rows if r[0] == g), key=lambda r: (hashed(r), str(r)))[:k]
            assert sorted((tuple(r) for r in got if r.g == g), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, sample_rows(df, ["x", "n"], 30).collect()), key=str) == sorted(
        sorted((r[1:] for r in rows), key=lambda r: (hashed(r), str(r)))[:30], key=str)
    assert sample_rows(df, ["x"], None).count() == len(rows)


def test_points_and_unbinned_lines(spark):
    rows = [("p" if i % 3 else None, float(i % 7), float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "c string, x double, y double")
    points = two_column_points(df, "c", "x", "c", "swarm", 1000)
    assert points.columns == ["x", "c"] and points.count() == 66
    with pytest.raises(ValueError):
        two_column_points(df, "c", "x", kind="bar")
    with pytest.raises(ValueError):
        two_column_points(df, "x", "y")
    lines = two_columns(df, "x", "y", "c", "line", nbins=None).collect()
    missing = sorted([r for r in lines if r.group == counts.MISSING], key=lambda r: r.point)
    assert [(r.x, r.y) for r in missing] == sorted((r[1], r[2]) for r in rows if r[0] is None) and missing[0].n_points == 34


def test_column_tables(spark):
    t = datetime.datetime(2024, 1, 1)
    rows = [(1, 0.0, "a", True, t, datetime.date(2024, 1, 1), b"\x00", [1, None], None), (1, -0.0, "b", None, t, None, b"\x00", [1, None], None),
            (2, float("nan"), None, False, None, None, b"\x01", [None, 1], None), (None, float("nan"), "a", False, t, None, None, None, None)]
    df = spark.createDataFrame(rows, "i int, d double, s string, b boolean, t timestamp_ntz, e date, r binary, a array<int>, n string")
    exact = {r.column: (r.non_null, r.missing, r.unique) for r in profile.column_info(df).collect()}
    assert exact == {"i": (3, 1, 2), "d": (4, 0, 2), "s": (3, 1, 2), "b": (3, 1, 2), "t": (3, 1, 1), "e": (1, 3, 1), "r": (3, 1, 2), "a": (3, 1, 2), "n": (0, 4, 0)}
    assert [(r.non_null, r.unique) for r in profile.column_info(df.limit(0)).collect()] == [(0, 0)] * 9


def test_appends_add_once(spark, scratch_dir):
    log, path = event_log(spark, SF_SMALL).limit(20), os.path.join(scratch_dir, "log")
    with pytest.raises(ValueError):
        read_appended(spark, path)
    assert append_events(log, path, "b1") and not append_events(log, path, "b1")
    os.makedirs(os.path.join(path, "batch=torn"))
    with open(os.path.join(path, "batch=torn", "part-0.parquet"), "w") as f:
        f.write("half a file")
    assert read_appended(spark, path).count() == 20
    assert append_events(log.limit(5), path, "torn")
    assert {r.batch: r["count"] for r in read_appended(spark, path).groupBy("batch").count().collect()} == {"b1": 20, "torn": 5}
    with pytest.raises(ValueError):
        append_events(log, path, "../x")


def test_versions_as_of(spark, scratch_dir):
    store = VersionStore(spark, os.path.join(scratch_dir, "v"))
    key = store.register(spark.range(5), "t", "five")
    store.overwrite(key, spark.range(3))
    assert [store.load(key, s).count() for s in (0, 1)] == [5, 3] and store.load(key).count() == 3
    with pytest.raises(KeyError):
        store.load(key, -1)


def test_steps_are_checked_to_the_end(spark):
    df = gappy_lineitem(spark, SF_SMALL)
    onehot = {"action": "encode_columns", "columns": ["l_returnflag"], "method": "onehot"}
    fill = {"action": "handle_missing", "strategy": "mean", "columns": ["l_quantity"]}
    with pytest.raises(ValueError, match="Step 2"):
        steps.validate_steps(df, [fill, fill, {"action": "scale_columns", "columns": ["nope"], "method": "minmax"}])
    with pytest.raises(ValueError, match="Step 1"):
        steps.validate_steps(df, [onehot, {"action": "standardize_text", "columns": ["l_returnflag"]}])
    steps.validate_steps(df, [onehot, {"action": "scale_columns", "columns": ["l_returnflag_R"], "method": "minmax"}])


def test_label_lists_have_a_limit(spark):
    df = spark.createDataFrame([(str(i), "y") for i in range(30)], "x string, y string")
    for refused in (lambda: encode.encode_onehot(df, ["x"], max_labels=29), lambda: groups.contingency_wide(df, "x", "y", max_labels=29)):
        with pytest.raises(ValueError):
            refused()
    assert len(encode.encode_onehot(df, ["x"], max_labels=30).columns) == 31


def test_buckets_and_least_from(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b"]), float(rng.randrange(40)), rng.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, v double, m double")
    bounds = sorted(rng.sample(range(40), 7))
    got = df.select("v", ranks.bucket_of(F.col("v"), bounds).alias("b")).collect()
    assert all(r.b == sum(x <= r.v for x in bounds) for r in got)
    for n in (1, 6):
        for r in ranks.least_from(df, "v", "m", ["k"], n).collect():
            assert r.m_least == min(x[2] for x in rows if x[0] == r.k and x[1] >= r.v)
