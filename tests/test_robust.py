"""Rank search, robust lines and LOWESS against plain numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.operators.eda import regress


@pytest.fixture(scope="module")
def points():
    rng = random.Random(5)
    return [(x := round(rng.uniform(1, 20), 2), 3 + 2 * x + rng.gauss(0, 1) + (40 if rng.random() < .1 else 0)) for _ in range(500)]


def frame(spark, points):
    return spark.createDataFrame([*points, (None, 1.0), (2.0, None)], "x double, y double")


def test_values_at_ranks(spark, monkeypatch):
    rng = random.Random(1)
    values = [rng.choice([0.0, 1.0, 1.0, rng.gauss(0, 1), 1e9, rng.random() * 1e-9]) for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for buckets in (4096, 3):
        monkeypatch.setattr(regress, "BUCKETS", buckets)
        ranks = [0, 1, 349, 350, 351, 600, 699]
        for near in (None, (0.5, 0.6), (1.0, 1.0), (-5.0, 2e9)):
            assert regress.values_at_ranks(df, F.col("v"), ranks, near) == [sorted(values)[r] for r in ranks]
    assert regress.median_of(df, F.col("v"), 700) == float(np.median(values))


def test_robust_line(spark, points):
    for logx in (False, True):
        x, y = np.array([math.log(p[0]) if logx else p[0] for p in points]), np.array([p[1] for p in points])
        w = np.ones(len(x))
        for _ in range(60):
            mx, my = (w * x).sum() / w.sum(), (w * y).sum() / w.sum()
            b = (w * (x - mx) * (y - my)).sum() / (w * (x - mx) ** 2).sum()
            r = np.abs(y - (my + b * (x - mx)))
            w = np.minimum(1, 1.345 / np.maximum(r / (np.median(r) / 0.67449), 1e-300))
        got = regress.robust_line(frame(spark, points), "x", "y", tol=1e-10, logx=logx).first()
        assert got.converged and got.slope == pytest.approx(b, rel=1e-6) and got.intercept == pytest.approx(my - b * mx, rel=1e-6)
    fit = regress.robust_fit(frame(spark, points), "x", "y", logx=True)
    curve = regress.fit_curve(spark, fit, 5).orderBy("point").collect()
    assert [c.y_fit for c in curve] == pytest.approx([fit["coefficients"][0] * math.log(c.x) + fit["coefficients"][1] for c in curve])
    with pytest.raises(ValueError):
        regress.robust_line(spark.createDataFrame([(0.0, 1.0), (1.0, 2.0)], "x double, y double"), "x", "y", logx=True)


def brute_lowess(x, y, frac, rounds, points):
    lo, hi = x.min(), x.max()
    step = (hi - lo) / (points - 1)
    grid = lo + np.arange(points) * step
    h = np.array([max(np.sort(np.abs(x - g))[math.ceil(frac * len(x)) - 1], 1e-300) for g in grid])
    k, fit = np.ones(len(x)), None
    for it in range(rounds + 1):
        fit = []
        for g, width in zip(grid, h, strict=True):
            u = np.abs(x - g) / width
            w = np.where(u < 1, (1 - u ** 3) ** 3, 0) * k
            m = (w * x).sum() / w.sum()
            s = (w * (x - m) ** 2).sum()
            mean = (w * y).sum() / w.sum()
            fit.append(mean + ((w * (x - m) * (y - mean)).sum() / s * (g - m) if s > 1e-12 else 0))
        r = np.abs(y - np.interp(x, grid, fit)) / (6 * np.median(np.abs(y - np.interp(x, grid, fit))) or 1)
        k = np.where(r < 1, (1 - r * r) ** 2, 0)
    return grid, fit


def test_lowess(spark, points):
    x, y = (np.array([p[k] for p in points]) for k in (0, 1))
    for logx, frac in ((False, 0.66), (True, 0.2)):
        grid, fit = brute_lowess(np.log(x) if logx else x, y, frac, 3, 20)
        got = regress.lowess_grid(frame(spark, points).repartition(5), "x", "y", frac, 3, 20, logx).orderBy("point").collect()
        assert [r.x for r in got] == pytest.approx((np.exp(grid) if logx else grid).tolist())
        assert [r.y_fit for r in got] == pytest.approx(fit, rel=1e-8)


def test_lowess_of_one_value_and_none(spark):
    got = regress.lowess_grid(spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "x double, y double"), "x", "y", grid_points=3).collect()
    assert [r.y_fit for r in got] == [2.0] * 3
    with pytest.raises(ValueError):
        regress.lowess_grid(spark.createDataFrame([], "x double, y double"), "x", "y")
