"""Regression lines (A20-A23) and the Pearson test.

Fits are sums over all rows in one aggregate per pass; only the small
normal-equation systems (at most 6 x 6) are solved on the driver. Curves are
evaluated on ``spark.range(fit_points)`` from the fitted literals.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions import dist
from tablesmith.functions.types import require_numeric
from tablesmith.operators.eda.corr import guarded_corr
from tablesmith.session import staged


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _complete(df: DataFrame, x: str, y: str, logx: bool) -> DataFrame:
    require_numeric(df, [x, y])
    d = df.select(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y")).filter(
        F.col("x").isNotNull() & F.col("y").isNotNull())
    if logx:
        bad = d.filter(F.col("x") <= 0).limit(1).count()
        if bad:
            raise ValueError(f"{x} reaches 0 or below, so it has no logarithm")
        d = d.withColumn("x", F.log(F.col("x")))
    return d


def poly_fit(df: DataFrame, x: str, y: str, order: int = 1, logx: bool = False) -> dict:
    """Least-squares polynomial (order 1-5). x is centred and scaled first,
    power sums of the scaled x come from one aggregate, and the solution is
    mapped back to coefficients of x (highest power first)."""
    if not 1 <= order <= 5:
        raise ValueError("order must be between 1 and 5")
    d = _complete(df, x, y, logx)
    m = d.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.count("*").alias("n"),
              F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if m["n"] == 0:
        raise ValueError(f"No row has both {x} and {y}")
    mean, sd = float(m["m"]), float(m["s"]) or 1.0
    z = (F.col("x") - F.lit(mean)) / F.lit(sd)
    aggs = [F.sum(F.pow(z, k)).alias(f"z{k}") for k in range(0, 2 * order + 1)]
    aggs += [F.sum(F.pow(z, k) * F.col("y")).alias(f"zy{k}") for k in range(0, order + 1)]
    s = d.agg(*aggs).first()
    a = np.array([[s[f"z{i + j}"] for j in range(order + 1)] for i in range(order + 1)], dtype=float)
    b = np.array([s[f"zy{i}"] for i in range(order + 1)], dtype=float)
    beta = np.linalg.lstsq(a, b, rcond=None)[0]           # coefficients of z^0..z^order
    # substitute z = (x - mean) / sd
    poly = np.polynomial.Polynomial(beta)
    lin = np.polynomial.Polynomial([-mean / sd, 1.0 / sd])
    coef_x = np.zeros(order + 1)
    acc = np.polynomial.Polynomial([0.0])
    for k, c in enumerate(poly.coef):
        acc = acc + c * lin ** k
    coef_x[:len(acc.coef)] = acc.coef
    return {"coefficients": list(coef_x[::-1]), "n": int(m["n"]), "x_min": float(m["lo"]),
            "x_max": float(m["hi"]), "order": order, "logx": logx}


def fit_curve(spark, fit: dict, fit_points: int = 200) -> DataFrame:
    """200 points of the fitted curve over the observed x range."""
    lo, hi = fit["x_min"], fit["x_max"]
    if fit.get("logx"):
        lo, hi = math.exp(lo), math.exp(hi)
    step = (hi - lo) / max(fit_points - 1, 1)
    xg = F.lit(lo) + F.col("id") * F.lit(step)
    xf = F.log(xg) if fit.get("logx") else xg
    yv = F.lit(0.0)
    for c in fit["coefficients"]:
        yv = yv * xf + F.lit(float(c))
    return spark.range(fit_points).select(F.col("id").alias("point"), xg.alias("x"), yv.alias("y_fit"))


def regression_coefficients(df: DataFrame, x: str, y: str, order: int = 1, logx: bool = False) -> DataFrame:
    """One row per coefficient, power descending (``np.polyfit`` order)."""
    fit = poly_fit(df, x, y, order, logx)
    rows = [(order - i, float(c)) for i, c in enumerate(fit["coefficients"])]
    return df.sparkSession.createDataFrame(rows, "power int, coefficient double")


def linear_fit(df: DataFrame, x: str, y: str, logx: bool = False) -> DataFrame:
    """A20 order 1 as a plan: slope and intercept from one aggregate."""
    d = _complete(df, x, y, logx)
    return d.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
                 F.count("*").alias("n"))


def pearson_test(df: DataFrame, x: str, y: str, with_p: bool = True) -> DataFrame:
    """R, r squared, n and the two-sided t-test p-value of r."""
    d = _complete(df, x, y, False)
    out = d.agg(guarded_corr(F.col("x"), F.col("y")).alias("r"), F.count("*").alias("n")).select(
        "r", (F.col("r") * F.col("r")).alias("r_squared"), F.col("n").cast("long").alias("n"))
    if with_p:
        left = 1 - F.col("r") * F.col("r")
        t = F.when(left > 0, F.col("r") * F.sqrt((F.col("n") - 2) / F.when(left > 0, left)))
        p = dist.t_two_sided_p_udf(t, (F.col("n") - 2).cast("double"))
        # a perfect line leaves no spread to test against
        out = out.withColumn("p_value", F.when((left <= 0) & (F.col("n") > 2), F.lit(0.0)).otherwise(p))
    return out


#: Buckets that one pass of a rank search counts.
BUCKETS = 4096


def values_at_ranks(df: DataFrame, value: Column, ranks: list[int], near: tuple[float, float] | None = None) -> list[float]:
    """The exact values at some ranks (from 0) of ``value``, which must not be null.

    Each pass counts the rows of ``BUCKETS`` equal buckets of a bracket in one
    aggregate, with each bucket's least and greatest value, and the bracket
    narrows to the bucket that holds the rank. ``near`` is a first guess of the
    bracket; values outside it have a bucket of their own on either side.
    """
    found: dict[int, float] = {}
    brackets = {r: near for r in ranks}
    while todo := [r for r in ranks if r not in found]:
        at = brackets[todo[0]]
        if at is None:
            edges = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
            at = (float(edges["lo"]), float(edges["hi"]))
        lo, hi = at
        width = (hi - lo) / BUCKETS
        place = F.floor((value - F.lit(lo)) / F.lit(width)) if width > 0 else F.when(value < lo, -1).when(value > lo, BUCKETS).otherwise(0)
        bucket = F.greatest(F.least(place, F.lit(BUCKETS)), F.lit(-1))
        rows = (df.groupBy(bucket.cast("int").alias("bucket")).agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect())
        below = 0
        for row in sorted(rows, key=lambda r: r["bucket"]):
            for r in todo:
                if below <= r < below + row["n"]:
                    if row["lo"] == row["hi"] or r == below:
                        found[r] = float(row["lo"])
                    elif r == below + row["n"] - 1:
                        found[r] = float(row["hi"])
                    else:
                        brackets[r] = (float(row["lo"]), float(row["hi"]))
            below += row["n"]
    return [found[r] for r in ranks]


def median_of(df: DataFrame, value: Column, n: int, near: tuple[float, float] | None = None) -> float:
    """The middle value of ``n`` rows, or the mean of the two middle ones."""
    low, high = values_at_ranks(df, value, [(n - 1) // 2, n // 2], near)
    return (low + high) / 2


_ROBUST = "intercept double, slope double, iterations int, converged boolean"


def robust_fit(df: DataFrame, x: str, y: str, c: float = 1.345, max_iter: int = 50, tol: float = 1e-8, logx: bool = False) -> dict:
    """Huber M-estimate of a line by iteratively reweighted least squares,
    scale = median of |residual| / 0.67449, on the logarithm of x if ``logx``.

    The two columns are written once. A round is one aggregate for the line
    and one or two for the exact median, searched near the last round's.
    ``converged`` says whether the rounds ended before ``max_iter``. A constant
    x has no slope: the coefficients are None.
    """
    d = staged(_complete(df, x, y, logx), "robust-line")
    m = d.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    out = {"x_min": m["lo"], "x_max": m["hi"], "n": m["n"], "order": 1, "logx": logx, "coefficients": None, "iterations": 0, "converged": True}
    line = weighted_line(d, F.lit(1.0))
    if line is None:
        return out
    a, b = line
    done, it, mad, moved = False, 0, None, None
    while not done and it < max_iter:
        it += 1
        r = F.abs(F.col("y") - (F.lit(a) + F.lit(b) * F.col("x")))
        last = mad
        mad = median_of(d, r, m["n"], None if moved is None else (max(last - 2 * moved, 0.0), last + 2 * moved))
        # the median can't move further than the line did anywhere
        scale = mad / 0.67449 if mad else 1.0
        u = r / F.lit(scale)
        after = weighted_line(d, F.when(u <= c, F.lit(1.0)).otherwise(F.lit(c) / u))
        if after is None:
            break
        done = abs(after[0] - a) <= tol * max(1.0, abs(a)) and abs(after[1] - b) <= tol * max(1.0, abs(b))
        moved = max(abs(after[0] - a + (after[1] - b) * end) for end in (m["lo"], m["hi"]))
        a, b = after
    return {**out, "coefficients": [b, a], "iterations": it, "converged": done}


def robust_line(df: DataFrame, x: str, y: str, c: float = 1.345, max_iter: int = 50, tol: float = 1e-8, logx: bool = False) -> DataFrame:
    """``robust_fit`` as a row (intercept, slope, iterations, converged)."""
    fit = robust_fit(df, x, y, c, max_iter, tol, logx)
    b, a = fit["coefficients"] or (None, None)
    return df.sparkSession.createDataFrame([(a, b, fit["iterations"], fit["converged"])], _ROBUST)


def weighted_line(d: DataFrame, w) -> tuple[float, float] | None:
    """(intercept, slope) of the weighted least-squares line; None for a constant x."""
    t = d.agg(F.sum(w).alias("sw"), F.sum(w * F.col("x")).alias("sx"), F.sum(w * F.col("y")).alias("sy"),
              F.sum(w * F.col("x") * F.col("x")).alias("sxx"), F.sum(w * F.col("x") * F.col("y")).alias("sxy"),
              F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if t["sw"] is None or t["lo"] == t["hi"]:
        return None
    det = t["sw"] * t["sxx"] - t["sx"] * t["sx"]
    if det <= 0:
        return None
    slope = (t["sw"] * t["sxy"] - t["sx"] * t["sy"]) / det
    return (t["sy"] - slope * t["sx"]) / t["sw"], slope


def _bandwidths(d: DataFrame, grid: np.ndarray, rank: int, span: float) -> np.ndarray:
    """Distance from each grid point to its rank-th nearest row (from 1), all in the same passes.

    A task counts, per batch and grid point, its distinct x by buckets of their
    distance; the bracket of every grid point narrows to one bucket a pass.
    """
    buckets, m = 1024, len(grid)
    lo, hi, found = np.zeros(m), np.full(m, span), np.full(m, np.nan)
    sc = d.sparkSession.sparkContext
    while (todo := np.flatnonzero(np.isnan(found))).size:
        given = sc.broadcast((todo, grid[todo], lo[todo], (hi - lo)[todo] / buckets))

        def count(batches, given=given):
            which, at, low, width = given.value
            for batch in batches:
                xs, n = np.unique(batch.column(0).to_numpy(), return_counts=True)
                for i, g, a, w in zip(which, at, low, width, strict=True):
                    far = np.abs(xs - g)
                    place = np.clip(np.floor((far - a) / w) if w > 0 else np.sign(far - a) * buckets, -1, buckets).astype(np.int64)
                    order = np.lexsort((far, place))
                    first = np.flatnonzero(np.append(True, np.diff(place[order]) != 0))
                    last = np.append(first[1:], len(xs)) - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(first), i)), pa.array(place[order][first]), pa.array(np.add.reduceat(n[order], first)),
                         pa.array(far[order][first]), pa.array(far[order][last])], ["g", "bucket", "n", "lo", "hi"])

        rows = (d.select("x").mapInArrow(count, "g long, bucket long, n long, lo double, hi double").groupBy("g", "bucket")
                .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("g", "bucket").collect())
        below: dict[int, int] = {}
        for r in rows:
            g, before = r["g"], below.get(r["g"], 0)
            if before < rank <= before + r["n"]:
                if r["lo"] == r["hi"] or rank == before + 1:
                    found[g] = r["lo"]
                elif rank == before + r["n"]:
                    found[g] = r["hi"]
                else:
                    lo[g], hi[g] = r["lo"], r["hi"]
            below[g] = before + r["n"]
    return found


def lowess_grid(df: DataFrame, x: str, y: str, frac: float = 0.66, iterations: int = 3, grid_points: int = 50, logx: bool = False) -> DataFrame:
    """A23 (re-aimed): LOWESS evaluated on an even grid of x values (of log x if ``logx``; x is then given back in its own scale).

    A grid point's bandwidth is its exact distance to the ceil(frac * n)-th
    nearest x; tricube weights give a local line. Robustness rounds weight rows
    by the bisquare of their residual from the grid fit (straight between grid
    points) over six times the exact median residual. Each task adds up its
    rows' weights per distinct x, then per grid point, so nothing but
    ``grid_points`` rows a task leaves it.
    """
    d = staged(_complete(df, x, y, logx), "lowess")
    m = d.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n")).first()
    if not m["n"]:
        raise ValueError(f"No row has both {x} and {y}")
    lo, hi, n = float(m["lo"]), float(m["hi"]), int(m["n"])
    step = (hi - lo) / max(grid_points - 1, 1)
    grid = lo + np.arange(grid_points) * step
    width = np.maximum(_bandwidths(d, grid, math.ceil(frac * n), hi - lo), 1e-300)
    sc = d.sparkSession.sparkContext
    fitted = scale = None
    for it in range(iterations + 1):
        given = sc.broadcast((fitted, scale))

        def sums(batches, given=given):
            fit, six = given.value
            for batch in batches:
                xs, ys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                kept = np.ones(len(xs))
                if fit is not None:
                    off = np.abs(ys - _between(xs, fit, lo, step)) / six
                    kept = np.where(off < 1, (1 - off * off) ** 2, 0.0)
                at, where = np.unique(xs, return_inverse=True)
                w0, wy = np.bincount(where, kept), np.bincount(where, kept * ys)
                for g in range(grid_points):
                    u = np.abs(at - grid[g]) / width[g]
                    t = np.where(u < 1, (1 - u ** 3) ** 3, 0.0)
                    c = at - grid[g]
                    yield pa.RecordBatch.from_arrays([pa.array([g]), *[pa.array([float(v.sum())]) for v in (t * w0, t * w0 * c, t * w0 * c * c, t * wy, t * wy * c)]],
                                                     ["g", "w", "wc", "wcc", "wy", "wcy"])

        rows = {r["g"]: r for r in d.mapInArrow(sums, "g long, w double, wc double, wcc double, wy double, wcy double").groupBy("g")
                .agg(*[F.sum(c).alias(c) for c in ("w", "wc", "wcc", "wy", "wcy")]).collect()}
        fitted = np.array([_local(rows[g]) for g in range(grid_points)])
        if it == iterations:
            break
        k = F.least(F.greatest(F.floor((F.col("x") - F.lit(lo)) / F.lit(step or 1.0)), F.lit(0)), F.lit(max(grid_points - 2, 0))).cast("int")
        curve = F.array(*[F.lit(float(v)) for v in np.append(fitted, fitted[-1])])
        a, b = F.element_at(curve, k + 1), F.element_at(curve, k + 2)
        t = (F.col("x") - (F.lit(lo) + k * F.lit(step))) / F.lit(step or 1.0)
        middle = median_of(d, F.abs(F.col("y") - (a + (b - a) * t)), n)
        if middle == 0:
            break
        scale = 6.0 * middle
    shown = np.exp(grid) if logx else grid
    return d.sparkSession.createDataFrame([(i, float(shown[i]), float(fitted[i])) for i in range(grid_points)], "point int, x double, y_fit double")


def _between(x: np.ndarray, fitted: np.ndarray, lo: float, step: float) -> np.ndarray:
    """The grid fit at ``x``, straight between grid points."""
    k = np.clip(np.floor((x - lo) / (step or 1.0)), 0, max(len(fitted) - 2, 0)).astype(np.int64)
    curve = np.append(fitted, fitted[-1])
    return curve[k] + (curve[k + 1] - curve[k]) * ((x - (lo + k * step)) / (step or 1.0))


def _local(s) -> float:
    """The local line at its own grid point, from sums over x less the point; the local mean where x doesn't vary."""
    if not s["w"]:
        return float("nan")
    det = s["w"] * s["wcc"] - s["wc"] * s["wc"]
    if det > 1e-12 * max(1.0, s["w"] * s["wcc"]):
        return (s["wcc"] * s["wy"] - s["wc"] * s["wcy"]) / det
    return s["wy"] / s["w"]
