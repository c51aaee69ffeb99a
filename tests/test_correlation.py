"""Rank correlations over strips of values against all pairs of rows."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesmith.functions.strips import Strips
from tablesmith.operators.eda import corr

COLS = list("abcdefg")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    return [(float(i), rng.choice([0.0, 1.0, 1.0, 1.0, 2.0, 5.0]), rng.gauss(0, 1) if rng.random() > .2 else None,
             None if rng.random() < .3 else float(rng.randrange(30)), float(rng.randrange(4)) * .1, 3.0, float("nan") if i % 3 else i * .5)
            for i in range(400)]


def complete(rows):
    data = np.array([[np.nan if v is None else v for v in r] for r in rows], dtype=float)
    for i, j in itertools.combinations(range(len(COLS)), 2):
        ok = ~np.isnan(data[:, i]) & ~np.isnan(data[:, j])
        yield (COLS[i], COLS[j]), data[ok, i], data[ok, j]


def same(got, want):
    for pair, v in want.items():
        for p in (pair, pair[::-1]):
            assert got[p] is None if v is None else got[p] == pytest.approx(v, abs=1e-9)
    assert len(got) == len(COLS) ** 2 and got["a", "a"] == 1.0 and got["f", "f"] is None


@pytest.mark.parametrize(("strip_rows", "block"), [(10 ** 6, 512), (40, 512), (9, 3)])
def test_kendall(spark, rows, strip_rows, block):
    want = {}
    for pair, x, y in complete(rows):
        sx, sy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
        scale = np.sqrt(float((sx != 0).sum()) * (sy != 0).sum())
        want[pair] = (sx * sy).sum() / scale if scale else None
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLS))
    same({(r.col_x, r.col_y): r.tau for r in corr.kendall_matrix(df, COLS, strip_rows, block).collect()}, want)


@pytest.mark.parametrize("strip_rows", [10 ** 6, 15])
def test_spearman(spark, rows, strip_rows):
    want = {}
    for pair, x, y in complete(rows):
        rx, ry = (np.array([(v < t).sum() + ((v == t).sum() + 1) / 2 for t in v]) for v in (x, y))
        want[pair] = np.corrcoef(rx, ry)[0, 1] if rx.std() * ry.std() > 0 else None
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLS))
    same({(r.col_x, r.col_y): r.rho for r in corr.spearman_matrix(df, COLS, strip_rows).collect()}, want)


def test_no_rows_and_one_column(spark):
    none = spark.createDataFrame([], "x double, y double")
    for matrix in (corr.kendall_matrix, corr.spearman_matrix):
        assert {(r[0], r[1], r[2]) for r in matrix(none).collect()} == {("x", "x", None), ("y", "y", None), ("x", "y", None), ("y", "x", None)}
        assert [r[2] for r in matrix(spark.createDataFrame([(1.0,), (2.0,)], "x double")).collect()] == [1.0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 40)), max_size=150))
def test_order_score(points):
    x, y = (np.array([p[k] for p in points], dtype=float) for k in (0, 1))
    want = sum(np.sign(a[0] - b[0]) * np.sign(a[1] - b[1]) for a, b in itertools.combinations(points, 2))
    assert corr.order_score(x, y) == want
    assert corr.inversions(np.array([p[1] for p in points])) == sum(a[1] > b[1] for a, b in itertools.combinations(points, 2))


def test_strips():
    strips = Strips([np.array([1.0, 4.0])])
    assert strips.of(0, np.array([0.0, 1.0, 2.0, 4.0, 9.0, np.nan])).tolist() == [0, 1, 2, 3, 4, -1]
    assert strips.width == 5 and Strips([np.zeros(0)]).of(0, np.array([3.0])).tolist() == [0]


def test_spearman_over_many_blocks_of_rows(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLS))
    whole = {(r.col_x, r.col_y): r.rho for r in corr.spearman_matrix(df, COLS, 15).collect()}
    monkeypatch.setattr(corr, "BLOCK_RANKS", 700)
    cut = {(r.col_x, r.col_y): r.rho for r in corr.spearman_matrix(df, COLS, 15).collect()}
    assert cut.keys() == whole.keys()
    for pair, v in whole.items():
        assert cut[pair] is None if v is None else cut[pair] == pytest.approx(v, abs=1e-9)


def test_strips_grow_in_rows_before_they_grow_in_number(spark):
    """Cells of two columns grow with the square of the strips: 2,000 strips a column for 100 million rows before."""
    table = spark.range(4000).selectExpr("cast(id as double) AS x")
    assert len(Strips.plan(table, ["x"], 100_000_000).bounds[0]) < 512
    assert len(Strips.plan(table, ["x"], 1_000_000_000).bounds[0]) < 1000
