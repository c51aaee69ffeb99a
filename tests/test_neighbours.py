"""The exact nearest-neighbour join and imputation against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.operators import knn


def brute(refs, queries, nf, k):
    """refs: (key, features..., value); {query: [(key, d2, value)]}."""
    out = {}
    if not refs:
        return out
    points = np.array([r[1:1 + nf] for r in refs], dtype=float)
    var = points.var(axis=0)
    weight = np.where(var > 0, 1 / np.where(var > 0, var, 1), 1.0)
    for q in set(queries):
        d = sum((points[:, f] - q[f]) ** 2 * weight[f] for f in range(nf))
        order = sorted(range(len(refs)), key=lambda i: (round(d[i], 9), refs[i][0]))[:k]
        out[q] = [(refs[i][0], refs[i][-1]) for i in order]
    return out


def found(spark, refs, queries, nf, k, **sizes):
    names = [f"a{i}" for i in range(nf)]
    r = spark.createDataFrame(refs, "id long, " + ", ".join(f"{n} double" for n in names) + ", value double")
    q = spark.createDataFrame(queries, ", ".join(f"{n} double" for n in names))
    out = {}
    rows = knn.nearest(r, q, names, ["value"], F.col("id"), k, **sizes).collect()
    for row in sorted(rows, key=lambda x: (round(x.d2, 9), x.key)):
        out.setdefault(tuple(row[f"f{i}"] for i in range(nf)), []).append((row.key, row.v0))
    return out


@pytest.mark.parametrize("kind", ["spread", "grid", "hot", "line"])
def test_cells_and_blocks_lose_nothing(spark, kind):
    rng = random.Random(kind)
    nf = 1 if kind == "line" else 2

    def point():
        if kind == "grid":
            return tuple(float(rng.randrange(12)) for _ in range(nf))
        if kind == "hot" and rng.random() < 0.6:
            return (1.0,) * nf
        return tuple(rng.expovariate(0.2) for _ in range(nf))

    refs = [(i, *point(), rng.random()) for i in range(900)]
    queries = [point() for _ in range(150)] + [(500.0,) * nf, (-500.0,) * nf]
    for k, sizes in ((5, {"cell_rows": 25, "block_refs": 10, "block_queries": 7}), (40, {"cell_rows": 25})):
        assert found(spark, refs, queries, nf, k, **sizes) == brute(refs, queries, nf, k)


def test_few_references_and_constant_features(spark):
    refs = [(i, float(i), 3.0, float(i)) for i in range(4)]
    assert found(spark, refs, [(1.2, 3.0), (1.2, 4.0)], 2, 10) == brute(refs, [(1.2, 3.0), (1.2, 4.0)], 2, 10)
    assert found(spark, [], [(1.0, 2.0)], 2, 3) == {}
    assert found(spark, refs, [], 2, 3) == {}


def test_split_tree():
    points = np.array([[1.0, 5.0]] * 40 + [[2.0, 5.0]] * 3)
    cells = knn.Cells.plan(points, np.ones(2), 8)
    assert cells.count == 2 and len(set(cells.of(points).tolist())) == 2
    rng = np.random.default_rng(1)
    points = rng.normal(size=(4000, 3))
    cells = knn.Cells.plan(points, np.ones(3), 64)
    sizes = np.bincount(cells.of(points), minlength=64)
    assert cells.count == 64 and sizes.min() > 0 and sizes.max() < 200
    assert knn.Cells.plan(points[:0], np.ones(3), 64).of(points).tolist() == [0] * 4000


def test_imputation_rules(spark):
    schema = "id long, key double, d2 double, name string, other double"
    rows = [(i, float(i % 7), float(i), "x", None if i % 2 else 1.0) for i in range(60)]
    rows = [(*r[:1], None if r[0] % 5 == 0 else r[1], *r[2:]) for r in rows] + [(100, None, None, "gone", None), (101, None, 3.0, None, None), (101, None, 3.0, None, None)]
    df = spark.createDataFrame(rows, schema)
    out, warning = knn.knn_impute(df, ["key"], k=3, tie_key="id")
    got = out.collect()
    assert warning is None and len(got) == len(rows) - 1 and out.columns == df.columns  # the row without d2 goes; "other" is too empty to count
    refs = [(r[0], float(r[0]), r[2], r[1]) for r in rows if r[1] is not None and r[2] is not None]
    wanted = [(float(r[0]), r[2]) for r in rows if r[1] is None and r[2] is not None]
    near = brute(refs, wanted, 2, 3)
    for r in got:
        if r.id % 5 == 0 and r.id < 60 or r.id == 101:
            assert r.key == pytest.approx(sum(v for _, v in near[(float(r.id), r.d2)]) / 3)
    with pytest.raises(ValueError):
        knn.knn_impute(df.select("key", "name"), ["key"])
    none, warning = knn.knn_impute(spark.createDataFrame([(1.0, 2.0), (2.0, None)], "a double, b double").where("a = 1"), ["b"])
    assert none.collect() == [(1.0, 2.0)] and warning is None
    with pytest.raises(ValueError):
        knn.knn_impute(spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double"), ["b"])
