"""Counts and histograms.

Bin edges need the column range, fitted by one aggregate; the bucket is then
plain arithmetic (``functions.bins``) and counting is a ``groupBy`` with
map-side combining. Dense outputs list every bin through a bounded
``sequence`` of bin numbers, never a join against raw rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from tablesmith.functions.sampling import sample_rows
from tablesmith.functions import bins as B
from tablesmith.functions.quantile import column_quantiles
from tablesmith.functions.types import require_numeric, validate_columns
from tablesmith.operators.eda.groups import MISSING, label_missing


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _one_row_total(counts: DataFrame, col: str = "count") -> DataFrame:
    return counts.agg(F.sum(col).alias("_total"))


def category_counts(df: DataFrame, column: str, normalize: bool = False,
                    sort_order: str | None = "desc") -> DataFrame:
    """A1: counts per value, missing as ``<<MISSING>>``; ``share`` is the
    count over the total (a one-row aggregate joined back)."""
    validate_columns(df, [column])
    counts = df.groupBy(label_missing(_c(column)).alias("category")).agg(F.count("*").alias("count"))
    total = _one_row_total(counts)
    out = counts.join(F.broadcast(total), how="inner", on=F.lit(True))
    value = (F.col("count") / F.col("_total")) if normalize else F.col("count").cast("double")
    out = out.select("category", F.col("count").cast("long").alias("count"), value.alias("value"))
    if sort_order == "asc":
        out = out.orderBy(F.col("count").asc(), F.col("category"))
    elif sort_order == "desc":
        out = out.orderBy(F.col("count").desc(), F.col("category"))
    return out


def numeric_range(df: DataFrame, column: str) -> tuple[float, float, int]:
    r = df.agg(F.min(_c(column)).alias("lo"), F.max(_c(column)).alias("hi"),
               F.count(_c(column)).alias("n")).first()
    if r["n"] == 0:
        raise ValueError(f"{column}: no number to bin")
    return float(r["lo"]), float(r["hi"]), int(r["n"])


def auto_bins(df: DataFrame, column: str) -> int:
    """numpy's ``"auto"``: the smaller of the Sturges and Freedman-Diaconis
    widths (more bins), Sturges when the IQR is zero."""
    v = _c(column).cast("double")
    r = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n")).first()
    n, lo, hi = int(r["n"]), float(r["lo"]), float(r["hi"])
    if hi == lo or n == 0:
        return 1
    width = (hi - lo) / (math.log2(n) + 1.0)
    q1, q3 = column_quantiles(df, [column], [0.25, 0.75])[column]
    iqr = q3 - q1
    if iqr > 0:
        width = min(width, 2.0 * iqr * n ** (-1.0 / 3.0))
    return max(1, int(math.ceil((hi - lo) / width)))


def histogram(df: DataFrame, column: str, bins=30, normalize: bool = False) -> DataFrame:
    """A2: left-closed equal-width bins, last bin closed, constant column
    widened by 0.5 (trap T4). One row per bin with edges, midpoint, count and
    value (share when ``normalize``), plus the log-scale flags."""
    require_numeric(df, [column])
    n_bins = auto_bins(df, column) if bins == "auto" else int(bins)
    lo, hi, _ = numeric_range(df, column)
    a, b = B.hist_range(lo, hi)
    bucket = B.hist_bucket(_c(column).cast("double"), lo, hi, n_bins)
    counts = (df.filter(_c(column).isNotNull()).groupBy(bucket.alias("bin"))
              .agg(F.count("*").alias("count")))
    return _dense_bins(df.sparkSession, counts, n_bins, a, b, normalize, lo > 0)


def _dense_bins(spark, counts: DataFrame, n_bins: int, a: float, b: float, normalize: bool,
                logx: bool, keys: list[str] | None = None) -> DataFrame:
    step = (b - a) / n_bins
    keys = keys or []
    if keys:
        grid = counts.select(*keys).distinct().select(
            *keys, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_bins - 1).cast("long"))).alias("bin"))
    else:
        grid = spark.range(n_bins).withColumnRenamed("id", "bin")
    full = grid.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
    lo_e = F.lit(a) + F.col("bin") * F.lit(step)
    hi_e = F.when(F.col("bin") == n_bins - 1, F.lit(b)).otherwise(F.lit(a) + (F.col("bin") + 1) * F.lit(step))
    if normalize:
        tot = full.groupBy(*keys).agg(F.sum("count").alias("_t"))
        full = full.join(tot, keys, "inner") if keys else full.join(F.broadcast(tot), how="inner", on=F.lit(True))
        value = F.when(F.col("_t") > 0, F.col("count") / F.col("_t")).otherwise(F.col("count").cast("double"))
    else:
        value = F.col("count").cast("double")
    return full.select(*keys, "bin", lo_e.alias("bin_lo"), hi_e.alias("bin_hi"),
                       ((lo_e + hi_e) / 2.0).alias("mid"), "count", value.alias("value"),
                       F.lit(bool(logx)).alias("logx_available"))


def histogram_2d(df: DataFrame, x: str, y: str, bins=40) -> DataFrame:
    """A3: counts on an nx x ny grid of left-closed bins over rows where both
    values are present, empty cells included, with edges."""
    require_numeric(df, [x, y])
    nx, ny = (bins, bins) if isinstance(bins, int) else bins
    both = df.filter(_c(x).isNotNull() & _c(y).isNotNull())
    r = both.agg(F.min(_c(x)).alias("x0"), F.max(_c(x)).alias("x1"),
                 F.min(_c(y)).alias("y0"), F.max(_c(y)).alias("y1")).first()
    if r["x0"] is None:
        raise ValueError(f"No row has both {x} and {y}")
    ax, bx = B.hist_range(float(r["x0"]), float(r["x1"]))
    ay, by = B.hist_range(float(r["y0"]), float(r["y1"]))
    sx, sy = (bx - ax) / nx, (by - ay) / ny
    g = both.groupBy(B.hist_bucket(_c(x).cast("double"), float(r["x0"]), float(r["x1"]), nx).alias("bx"),
                     B.hist_bucket(_c(y).cast("double"), float(r["y0"]), float(r["y1"]), ny).alias("by")
                     ).agg(F.count("*").alias("count"))
    grid = df.sparkSession.range(nx * ny).select((F.col("id") / ny).cast("long").alias("bx"), (F.col("id") % ny).alias("by"))
    full = grid.join(g, ["bx", "by"], "left").na.fill(0, ["count"])
    return full.select("bx", "by", (F.lit(ax) + F.col("bx") * sx).alias("x_lo"),
                    (F.lit(ay) + F.col("by") * sy).alias("y_lo"), F.col("count").cast("long"))


def trend_line(df: DataFrame, x: str, y: str, nbins: int = 30) -> DataFrame:
    """A5: mean y per equal-width x bin (digitize-and-clip, trap T6); empty
    bins are absent."""
    require_numeric(df, [x, y])
    both = df.filter(_c(x).isNotNull() & _c(y).isNotNull())
    lo, hi, _ = numeric_range(both, x)
    mids = B.trend_midpoints(lo, hi, nbins)
    g = both.groupBy(B.trend_bucket(_c(x).cast("double"), lo, hi, nbins).alias("bin")).agg(
        F.avg(_c(y).cast("double")).alias("mean_y"), F.count("*").alias("n"))
    return g.select("bin", F.element_at(F.array(*[F.lit(m) for m in mids]), (F.col("bin") + 1).cast("int"))
                    .alias("x_mid"), "mean_y", F.col("n").cast("long").alias("n"))


def joint_marginals(df: DataFrame, x: str, y: str, bins: int = 30) -> DataFrame:
    """A7 (numbers): the two marginal histograms over complete pairs, long
    form with an ``axis`` column; the points come from ``scatter_sample``."""
    both = df.filter(_c(x).isNotNull() & _c(y).isNotNull())
    hx = histogram(both, x, bins).select(F.lit("x").alias("axis"), "*")
    hy = histogram(both, y, bins).select(F.lit("y").alias("axis"), "*")
    return hx.unionByName(hy)


def groups_by_category(df: DataFrame, group_by: str) -> DataFrame:
    """``group`` column = category label, missing as ``<<MISSING>>``."""
    return df.withColumn("group", label_missing(_c(group_by)))


def groups_by_filters(df: DataFrame, filters: list, labels: list[str] | None = None):
    """Label -> predicate (Spark SQL text or Column). Overlapping groups
    are allowed: each row is emitted once per matching label in one pass.
    Predicates that don't parse or name no column, and those that select no
    row, are reported; one aggregate counts the rows of all of them."""
    labels = labels or [str(f) for f in filters]
    conds, warnings = [], []
    for lab, f in zip(labels, filters):
        try:
            c = F.expr(f) if isinstance(f, str) else f
            df.select(c.alias("_t")).schema
        except (AnalysisException, ParseException) as exc:
            warnings.append(f"Skipped filter '{lab}': {exc.__class__.__name__}")
            continue
        conds.append((lab, F.coalesce(c, F.lit(False))))
    if not conds:
        raise ValueError("No valid filters")
    hits = df.agg(*[F.count_if(c).alias(f"h{i}") for i, (_, c) in enumerate(conds)]).first()
    warnings += [f"Filter '{lab}' selects no row" for i, (lab, _) in enumerate(conds) if not hits[f"h{i}"]]
    exploded = df.withColumn("group", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(lab)) for lab, c in conds]))))
    return exploded, warnings


def lines_hist_by_group(grouped: DataFrame, column: str, nbins: int = 30,
                        normalize: bool = False) -> DataFrame:
    """One histogram per ``group`` on edges shared by all groups."""
    require_numeric(grouped, [column])
    lo, hi, _ = numeric_range(grouped, column)
    a, b = B.hist_range(lo, hi)
    counts = (grouped.filter(_c(column).isNotNull())
              .groupBy("group", B.hist_bucket(_c(column).cast("double"), lo, hi, nbins).alias("bin"))
              .agg(F.count("*").alias("count")))
    return _dense_bins(grouped.sparkSession, counts, nbins, a, b, normalize, lo > 0, keys=["group"])


def lines_mean_by_group(grouped: DataFrame, x: str, y: str, nbins: int = 30) -> DataFrame:
    """Mean y per shared x bin per group (trap T6 bins)."""
    require_numeric(grouped, [x, y])
    both = grouped.filter(_c(x).isNotNull() & _c(y).isNotNull())
    lo, hi, _ = numeric_range(both, x)
    mids = B.trend_midpoints(lo, hi, nbins)
    g = both.groupBy("group", B.trend_bucket(_c(x).cast("double"), lo, hi, nbins).alias("bin")).agg(
        F.avg(_c(y).cast("double")).alias("mean_y"), F.count("*").alias("n"))
    return g.select("group", "bin",
                    F.element_at(F.array(*[F.lit(m) for m in mids]), (F.col("bin") + 1).cast("int")).alias("x_mid"),
                    "mean_y", F.col("n").cast("long").alias("n"))


def scatter_sample(df: DataFrame, x: str, y: str, hue: str | None = None,
                   max_points: int | None = 5000, seed: int = 0) -> DataFrame:
    """A4: up to ``max_points`` complete (x, y) rows, those with the smallest
    hashes (``functions.sampling``). Display only: statistics always use every row."""
    cols = [x, y] + ([hue] if hue and hue not in (x, y) else [])
    validate_columns(df, cols)
    return sample_rows(df.filter(_c(x).isNotNull() & _c(y).isNotNull()), cols, max_points, None, seed)


def raw_line(df: DataFrame, x: str, y: str, max_points: int | None = 5000, seed: int = 0) -> DataFrame:
    """Sampled points sorted by x."""
    return scatter_sample(df, x, y, None, max_points, seed).orderBy(_c(x), _c(y))


def lines_raw_by_group(grouped: DataFrame, x: str, y: str, max_points_per_line: int | None = 5000, seed: int = 0) -> DataFrame:
    """A14 unbinned: up to ``max_points_per_line`` complete points of each
    group, numbered by x, and how many the line has."""
    require_numeric(grouped, [x, y])
    both = grouped.filter(_c(x).isNotNull() & _c(y).isNotNull())
    points = sample_rows(both, ["group", x, y], max_points_per_line, "group", seed)
    line = Window.partitionBy("group")
    return points.select("group", (F.row_number().over(line.orderBy(_c(x), _c(y))) - 1).cast("long").alias("point"),
                         _c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"), F.count("*").over(line).alias("n_points"))


__all__ = ["MISSING", "category_counts", "histogram", "histogram_2d", "trend_line",
           "joint_marginals", "groups_by_category", "groups_by_filters", "lines_hist_by_group",
           "lines_mean_by_group", "lines_raw_by_group", "scatter_sample", "raw_line", "auto_bins"]
