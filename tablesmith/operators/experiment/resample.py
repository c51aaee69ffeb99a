"""Resampling: bootstrap intervals (X7, X8), A/A re-randomisation (X19) and
subgroup effects (X17).

The bootstrap works on the value counts per metric and arm: resampling gives a
value that stands c times a Poisson(c) weight in each replicate. Partitions of
the count table draw the weights of their values for all replicates, and the
partial sums are added up by replicate, so nothing large meets in one place.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions import dist
from tablesmith.operators.experiment.sessions import METRIC_FAMILY
from tablesmith.session import shuffle_partitions


def _stat_from_moments(stat: str, n_a, s_a, q_a, n_b, s_b, q_b):
    """Replicate statistic from weighted count, sum and sum of squares."""
    with np.errstate(divide="ignore", invalid="ignore"):
        mean_a = s_a / n_a
        mean_b = s_b / n_b
        if stat == "mean_diff":
            return mean_b - mean_a
        var_a = (q_a - n_a * mean_a * mean_a) / (n_a - 1)
        var_b = (q_b - n_b * mean_b * mean_b) / (n_b - 1)
        pooled = np.sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / np.maximum(n_a + n_b - 2, 1))
        d = np.where(pooled == 0, 0.0, (mean_b - mean_a) / pooled)
        return np.where((n_a < 2) | (n_b < 2), np.nan, d)


def value_counts(sessions: DataFrame, metrics=METRIC_FAMILY) -> DataFrame:
    """(metric, ab_group, v, c): how often each value stands, from one scan; missing values don't count."""
    long = sessions.select("ab_group", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics
    ])).alias("x")).select("ab_group", "x.metric", "x.v").filter(F.col("v").isNotNull())
    return long.groupBy("metric", "ab_group", "v").agg(F.count("*").alias("c"))


#: Fixed values of the draws, which SQL repeats: a 32-bit mask, multiplier and step, and how finely values are told apart.
MASK, MULTIPLIER, STEP, VALUE_SCALE = 0xFFFFFFFF, 0x45D9F3B, 0x9E3779B9, 1e9


def mix32(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 32-bit numbers, in arithmetic that fits 63 bits."""
    for _ in range(2):
        x = ((x ^ (x >> 16)) * MULTIPLIER) & MASK
    return x ^ (x >> 16)


def arm_key(seed: int, metric: str, arm: str) -> int:
    return int(mix32((zlib.crc32(f"{metric}|{arm}".encode()) ^ seed) & MASK))


def uniforms(seed: int, metric: str, arm: str, value: float, n: int) -> np.ndarray:
    """Draw r of a value is a function of (seed, metric, arm, value, r) alone; in (0, 1), 32 bits."""
    q = math.floor(value * VALUE_SCALE + 0.5)
    h = mix32(arm_key(seed, metric, arm) ^ (q & MASK))
    h = mix32(h ^ ((q >> 32) & MASK))
    return (mix32((h + np.arange(n, dtype=np.int64) * STEP) & MASK) + 0.5) / 2.0 ** 32


@lru_cache(maxsize=256)
def poisson_table(c: int) -> tuple[int, np.ndarray]:
    """(first k, P(K <= k) from there on) of a Poisson number with mean ``c``, nine standard deviations wide."""
    first = max(0, math.floor(c - 9 * math.sqrt(c) - 9))
    k = np.arange(first, math.ceil(c + 9 * math.sqrt(c) + 20))
    return first, np.cumsum(np.exp(k * math.log(c) - c - np.array([math.lgamma(x + 1) for x in k.tolist()])))


def bootstrap_replicates(sessions: DataFrame | None, metrics=METRIC_FAMILY, n_boot: int = 10_000,
                         seed: int = 20260418, stat: str = "mean_diff", counts: DataFrame | None = None) -> DataFrame:
    """(metric, rep, stat): a value that stands c times weighs Poisson(c) in
    each replicate. The draws come from a counter-based generator and the
    inverse of the Poisson table, so they depend on nothing but (seed, metric,
    arm, value, replicate). A task keeps n_boot sums per metric and arm.
    ``counts`` gives ready ``value_counts``."""
    counts = value_counts(sessions, list(metrics)) if counts is None else counts
    spread = counts.repartition(shuffle_partitions(counts.sparkSession), "metric", "ab_group", "v")

    def run(batches):
        sums: dict[tuple[str, str], np.ndarray] = {}
        for pdf in batches:
            for m, arm, v, c in zip(pdf["metric"], pdf["ab_group"], pdf["v"], pdf["c"], strict=True):
                first, cdf = poisson_table(int(c))
                w = first + np.minimum(np.searchsorted(cdf, uniforms(seed, m, arm, v, n_boot), side="right"), len(cdf) - 1)
                s = sums.setdefault((m, arm), np.zeros((3, n_boot)))
                s[0] += w
                s[1] += w * v
                s[2] += w * (v * v)
        for (m, arm), s in sorted(sums.items()):
            yield pd.DataFrame({"metric": m, "ab_group": arm, "rep": np.arange(n_boot), "s0": s[0], "s1": s[1], "s2": s[2]})

    partial = spread.mapInPandas(
        run, "metric string, ab_group string, rep long, s0 double, s1 double, s2 double")
    sums = partial.groupBy("metric", "rep").agg(*[
        F.sum(F.when(F.col("ab_group") == arm, F.col(c))).alias(f"{c}_{arm}")
        for arm in ("A", "B") for c in ("s0", "s1", "s2")])

    @F.pandas_udf(T.DoubleType())
    def rep_stat(n_a: pd.Series, s_a: pd.Series, q_a: pd.Series,
                 n_b: pd.Series, s_b: pd.Series, q_b: pd.Series) -> pd.Series:
        return pd.Series(_stat_from_moments(stat, n_a.to_numpy(), s_a.to_numpy(), q_a.to_numpy(),
                                            n_b.to_numpy(), s_b.to_numpy(), q_b.to_numpy()))

    return sums.select("metric", "rep", rep_stat("s0_A", "s1_A", "s2_A", "s0_B", "s1_B", "s2_B")
                       .alias("stat"))


def bootstrap_diff_ci(sessions: DataFrame | None, metrics=METRIC_FAMILY, n_boot: int = 10_000,
                      seed: int = 20260418, level: float = 0.95, stat: str = "mean_diff", counts: DataFrame | None = None) -> DataFrame:
    """X7 (``stat='mean_diff'``) / X8 (``stat='cohens_d'``): percentile
    interval of the replicate statistic, linear interpolation."""
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    reps = bootstrap_replicates(sessions, metrics, n_boot, seed, stat, counts)
    q = F.percentile(F.col("stat"), F.array(F.lit(lo), F.lit(hi)))
    return (reps.filter(~F.isnan("stat") & F.col("stat").isNotNull())
            .groupBy("metric").agg(q.alias("_q"), F.count("*").alias("n_boot"))
            .select("metric", F.col("_q")[0].alias("ci_low"), F.col("_q")[1].alias("ci_high"),
                    "n_boot"))


def bootstrap_d_ci(sessions: DataFrame, metric: str = "apply_rate", **kw) -> DataFrame:
    return bootstrap_diff_ci(sessions, [metric], stat="cohens_d", **kw)


def aa_check(sessions: DataFrame, metric: str = "apply_rate", replicates: int = 10,
             seed: int = 20260418, alpha: float = 0.05) -> DataFrame:
    """A/A false-positive rate on real sessions. Each replicate
    re-randomises every session by a hash of (session, replicate); Welch t
    per replicate from one grouped aggregate; Wilson interval on the
    rejection rate."""
    rep = F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("rep")
    x = sessions.select(F.col("session_id"), F.col(metric).cast("double").alias("v"), rep)
    arm = F.when(F.pmod(F.xxhash64(F.col("session_id"), F.col("rep") + F.lit(seed)), F.lit(2)) == 0,
                 F.lit("A")).otherwise(F.lit("B"))
    g = x.groupBy("rep", arm.alias("arm")).agg(
        F.count("*").alias("n"), F.avg("v").alias("mean"), F.var_samp("v").alias("var"))

    def pick(a, c):
        return F.max(F.when(F.col("arm") == a, F.col(c)))

    per = g.groupBy("rep").agg(*[pick(a, c).alias(f"{c}_{a.lower()}")
                                 for a in ("A", "B") for c in ("n", "mean", "var")])
    va = F.col("var_a") / F.col("n_a")
    vb = F.col("var_b") / F.col("n_b")
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(va + vb))
    df = F.try_divide((va + vb) * (va + vb), va * va / (F.col("n_a") - 1) + vb * vb / (F.col("n_b") - 1))
    per = per.select("rep", t.alias("t"), df.alias("df")).withColumn(
        "p_value", dist.t_two_sided_p_udf(F.col("t"), F.col("df")))
    summary = per.agg(F.count("*").alias("n_replicates"),
                      F.count_if(F.col("p_value") < alpha).alias("n_rejected"))

    @F.pandas_udf("struct<lo:double,hi:double>")
    def wilson(k: pd.Series, n: pd.Series) -> pd.DataFrame:
        pairs = [dist.wilson_interval(int(a), int(b)) for a, b in zip(k, n)]
        return pd.DataFrame({"lo": [p[0] for p in pairs], "hi": [p[1] for p in pairs]})

    w = wilson(F.col("n_rejected"), F.col("n_replicates"))
    return summary.select("n_replicates", "n_rejected",
                          (F.col("n_rejected") / F.col("n_replicates")).alias("rejection_rate"),
                          w["lo"].alias("ci_low"), w["hi"].alias("ci_high"))


def subgroup_effects(events: DataFrame, sessions: DataFrame, subgroup_col: str = "clean_action",
                     metric: str = "apply_rate", min_sessions_per_cell: int = 30,
                     with_p: bool = True) -> DataFrame:
    """Each session's modal level (smallest on ties), Welch t and d per
    level; cells under ``min_sessions_per_cell`` per arm are 'insufficient N'."""
    modal = (events.filter(F.col(subgroup_col).isNotNull())
             .groupBy("session_id").agg(F.mode(F.col(subgroup_col), True).alias("subgroup")))
    j = sessions.select("session_id", "ab_group", F.col(metric).cast("double").alias("v")).join(
        modal, "session_id")
    g = j.groupBy("subgroup", "ab_group").agg(F.count("*").alias("n"), F.avg("v").alias("mean"),
                                              F.var_samp("v").alias("var"))

    def pick(a, c):
        return F.max(F.when(F.col("ab_group") == a, F.col(c)))

    per = g.groupBy("subgroup").agg(
        F.coalesce(pick("A", "n"), F.lit(0)).alias("n_a"), F.coalesce(pick("B", "n"), F.lit(0)).alias("n_b"),
        pick("A", "mean").alias("mean_a"), pick("B", "mean").alias("mean_b"),
        pick("A", "var").alias("var_a"), pick("B", "var").alias("var_b"))
    enough = (F.col("n_a") >= min_sessions_per_cell) & (F.col("n_b") >= min_sessions_per_cell)
    na, nb = F.col("n_a"), F.col("n_b")
    pooled = F.sqrt(((na - 1) * F.col("var_a") + (nb - 1) * F.col("var_b")) / F.greatest(na + nb - 2, F.lit(1)))
    d = F.when(pooled == 0, F.lit(0.0)).otherwise((F.col("mean_b") - F.col("mean_a")) / pooled)
    va, vb = F.col("var_a") / na, F.col("var_b") / nb
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(va + vb))
    df = F.try_divide((va + vb) * (va + vb), va * va / (na - 1) + vb * vb / (nb - 1))
    out = per.select("subgroup", F.col("n_a").cast("long").alias("n_a"),
                     F.col("n_b").cast("long").alias("n_b"), "mean_a", "mean_b",
                     F.when(enough, d).alias("cohens_d"), F.when(enough, t).alias("t"),
                     F.when(enough, df).alias("df"),
                     F.when(enough, F.lit("")).otherwise(F.lit("insufficient N")).alias("note"))
    if with_p:
        out = out.withColumn("p_value", dist.t_two_sided_p_udf(F.col("t"), F.col("df")))
    return out
