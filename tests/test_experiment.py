"""Experiment analysis: the six-event table, published numbers, properties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.functions import dist
from tablesmith.operators.experiment.sessions import METRIC_FAMILY
from tablesmith.operators.experiment import resample, stats
from tablesmith.operators.experiment.sessions import session_metrics
from tablesmith.sources.events import normalise_events

SIX = [
    ("s1", "A", "preview_clean", "", "5"),
    ("s1", "A", "apply_clean", "True", "10"),
    ("s2", "B", "preview_clean", "", "3"),
    ("s2", "B", "preview_clean", "", "8"),
    ("s2", "B", "apply_clean", "True", "12"),
    ("s3", "B", "apply_clean", "False", "2"),
]


def six_events(spark):
    rows = [("2026-01-01 10:00:00", s, g, t, "handle_missing", "builtin_sleep", "1", ok, sec, "")
            for s, g, t, ok, sec in SIX]
    cols = ["timestamp", "session_id", "ab_group", "event_type", "clean_action", "dataset_key",
            "columns_count", "success", "seconds_since_session_start", "details"]
    return normalise_events(spark.createDataFrame(rows, cols))


def test_six_event_session_metrics(spark):
    s = {r["session_id"]: r for r in session_metrics(six_events(spark)).collect()}
    assert s["s1"]["apply_rate"] == pytest.approx(0.5)
    assert s["s1"]["preview_to_apply_conversion"] == 1.0
    assert s["s1"]["apply_success_rate"] == 1.0
    assert s["s2"]["apply_rate"] == pytest.approx(1 / 3)
    assert s["s2"]["preview_to_apply_conversion"] == 1.0
    assert s["s2"]["apply_success_rate"] == 1.0
    assert s["s2"]["successful_actions_per_session"] == 1.0
    assert s["s3"]["apply_rate"] == 1.0
    assert s["s3"]["preview_to_apply_conversion"] == 0.0
    assert s["s3"]["apply_success_rate"] == 0.0
    assert s["s3"]["successful_actions_per_session"] == 0.0
    assert s["s2"]["session_duration_s"] == 12.0
    assert s["s1"]["distinct_clean_actions"] == 1


def test_event_normalisation_rules(spark):
    rows = [("2026-01-01 10:00:00", "x", " a ", "apply_clean", "", "k", "bad", "yes", "1.5", ""),
            ("not a time", "y", "b", "apply_clean", "", "k", "3", "0", "abc", ""),
            ("2026-01-01 10:00:00", "z", "C", "apply_clean", "", "k", "3", "maybe", "2", "")]
    cols = ["timestamp", "session_id", "ab_group", "event_type", "clean_action", "dataset_key",
            "columns_count", "success", "seconds_since_session_start", "details"]
    out = {r["session_id"]: r for r in normalise_events(spark.createDataFrame(rows, cols)).collect()}
    assert set(out) == {"x", "y"}                      # arm C dropped
    assert out["x"]["ab_group"] == "A" and out["x"]["success_bool"] is True
    assert out["x"]["columns_count"] == 0              # bad -> 0
    assert out["y"]["success_bool"] is False and out["y"]["timestamp"] is None
    assert out["y"]["seconds_since_session_start"] is None


def test_published_numbers(spark):
    assert dist.chi2_sf_df1(1.376) == pytest.approx(0.2408, abs=1e-4)
    assert dist.binom_test_two_sided(453, 942) == pytest.approx(0.2541, abs=1e-4)
    assert 2 * dist.norm_sf(3.2555) == pytest.approx(0.0011, abs=1e-4)
    lo, hi = dist.wilson_interval(1, 10)
    assert (round(lo, 3), round(hi, 3)) == (0.018, 0.404)
    spread = spark.createDataFrame([(f"{a}{i}", a, float(i % 11) + (0.4 if a == "B" else 0.0)) for a in "AB" for i in range(453)],
                                   "session_id string, ab_group string, v double")
    row = stats.power_table(spread, ["v"]).first()
    assert row["mde"] == pytest.approx(0.186, abs=1e-3)
    assert row["required_n_per_arm"] == math.ceil(2 * (1.959964 + 0.841621) ** 2 / row["d"] ** 2)
    assert dist.f_sf(12.657, 1, 940) == pytest.approx(0.0004, abs=5e-5)


def test_welch_and_d_from_published_moments(spark):
    # Two arms with the published means and sds (453 / 489 sessions).
    rng = np.random.default_rng(1)

    def arm(mean, sd, n):
        x = rng.normal(size=n)
        return (x - x.mean()) / x.std(ddof=1) * sd + mean

    a, b = arm(0.5642, 0.3127, 453), arm(0.4049, 0.2654, 489)
    rows = [(f"a{i}", "A", float(v)) for i, v in enumerate(a)] + [(f"b{i}", "B", float(v)) for i, v in enumerate(b)]
    df = spark.createDataFrame(rows, "session_id string, ab_group string, apply_rate double")
    r = stats.welch_t(df, ["apply_rate"]).first()
    assert r["t"] == pytest.approx(8.397, abs=2e-3)
    d = stats.cohens_d(df, ["apply_rate"]).first()["cohens_d"]
    assert d == pytest.approx(-0.5510, abs=2e-4)


def test_bh_bounded_and_ordered(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([0.001, 0.04, 0.5, 0.8])], "i int, p_value double")
    out = sorted(stats.bh_adjust(df).collect(), key=lambda r: r["i"])
    adj = [r["p_fdr"] for r in out]
    assert all(0 <= a <= 1 for a in adj)
    assert all(a >= r["p_value"] for a, r in zip(adj, out))
    assert adj == sorted(adj)
    df2 = spark.createDataFrame([(0, 1e-12), (1, 0.0011), (2, 0.0360), (3, 0.4850)], "i int, p_value double")
    adj2 = [r["p_fdr"] for r in sorted(stats.bh_adjust(df2).collect(), key=lambda r: r["i"])]
    assert adj2[2] == pytest.approx(0.0480, abs=1e-4) and adj2[3] == pytest.approx(0.4850)


def test_srm_flags_100_900(spark):
    rows = [(f"s{i}", "A" if i < 100 else "B") for i in range(1000)]
    df = spark.createDataFrame(rows, "session_id string, ab_group string")
    r = stats.srm_chi2(df).first()
    assert r["srm_flag"] and r["p_value"] < 0.001


def test_planted_effect_detected(spark):
    rng = np.random.default_rng(7)
    a = rng.normal(0.0, 1.0, 300)
    b = rng.normal(0.4, 1.0, 300)
    rows = [(f"a{i}", "A", float(v)) for i, v in enumerate(a)] + [(f"b{i}", "B", float(v)) for i, v in enumerate(b)]
    df = spark.createDataFrame(rows, "session_id string, ab_group string, apply_rate double")
    ci = resample.bootstrap_d_ci(df, "apply_rate", n_boot=1000).first()
    assert ci["ci_high"] > 0 and ci["ci_high"] - ci["ci_low"] < 0.6
    p = stats.welch_t(df, ["apply_rate"]).first()["p_value"]
    assert p < 0.05
    mw = stats.mann_whitney_u(df, ["apply_rate"]).first()
    u_b = 300 * 300 - mw["u_a"]
    assert mw["u_a"] + u_b == 300 * 300


def test_bootstrap_ci_contains_estimate_and_poisson_path(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{i}", "A" if i % 2 else "B", float(rng.integers(0, 5))) for i in range(400)]
    df = spark.createDataFrame(rows, "session_id string, ab_group string, apply_rate double")
    m = df.groupBy("ab_group").agg(F.avg("apply_rate").alias("m")).collect()
    diff = {r["ab_group"]: r["m"] for r in m}
    est = diff["B"] - diff["A"]
    ci = resample.bootstrap_diff_ci(df, ["apply_rate"], n_boot=500).first()
    assert ci["ci_low"] <= est <= ci["ci_high"]


def test_bootstrap_does_not_depend_on_partitions(spark):
    rows = [(f"s{i}", "AB"[i % 2], float(i * i % 37)) for i in range(300)]
    df = spark.createDataFrame(rows, "session_id string, ab_group string, apply_rate double")
    had = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("8", "3"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        r = resample.bootstrap_diff_ci(df, ["apply_rate"], n_boot=400).first()
        found.append((r["ci_low"], r["ci_high"]))
    spark.conf.set("spark.sql.shuffle.partitions", had)
    assert found[0] == pytest.approx(found[1], abs=1e-12)


def test_mann_whitney_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    a = rng.integers(0, 6, 80).astype(float)
    b = rng.integers(0, 6, 90).astype(float)
    rows = [(f"a{i}", "A", float(v)) for i, v in enumerate(a)] + [(f"b{i}", "B", float(v)) for i, v in enumerate(b)]
    df = spark.createDataFrame(rows, "session_id string, ab_group string, apply_rate double")
    r = stats.mann_whitney_u(df, ["apply_rate"]).first()
    brute = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x in a for y in b)
    assert r["u_a"] == pytest.approx(brute)


def test_levene_matches_formula(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0, 1, 50), rng.normal(0, 2, 60)
    rows = [(f"a{i}", "A", float(v)) for i, v in enumerate(a)] + [(f"b{i}", "B", float(v)) for i, v in enumerate(b)]
    df = spark.createDataFrame(rows, "session_id string, ab_group string, apply_rate double")
    za, zb = np.abs(a - np.median(a)), np.abs(b - np.median(b))
    z = np.r_[za, zb]
    n = len(z)
    between = len(za) * (za.mean() - z.mean()) ** 2 + len(zb) * (zb.mean() - z.mean()) ** 2
    within = ((za - za.mean()) ** 2).sum() + ((zb - zb.mean()) ** 2).sum()
    w = (n - 2) * between / within
    assert stats.levene_median(df).first()["w_stat"] == pytest.approx(w, rel=1e-9)


def test_aa_check_rates(spark):
    rows = [(f"s{i}", "A", float(i % 7) / 7) for i in range(600)]
    df = spark.createDataFrame(rows, "session_id string, ab_group string, apply_rate double")
    r = resample.aa_check(df, replicates=10).first()
    assert r["n_replicates"] == 10 and 0 <= r["n_rejected"] <= 10
    assert r["ci_low"] <= r["rejection_rate"] <= r["ci_high"]
    assert not math.isnan(r["ci_high"])


def test_draws_are_poisson_and_independent():
    for c in (1, 3, 50, 5000):
        first, cdf = resample.poisson_table(c)
        k = first + np.minimum(np.searchsorted(cdf, resample.uniforms(1, "m", "A", 0.25, 40_000), side="right"), len(cdf) - 1)
        assert abs(k.mean() - c) < 5 * (c / 40_000) ** 0.5 and k.var() == pytest.approx(c, rel=0.06)
    one, two = (resample.uniforms(1, "m", "A", v, 40_000) for v in (0.25, 0.5))
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.03 and abs(np.corrcoef(one[1:], one[:-1])[0, 1]) < 0.03
    assert len({float(resample.uniforms(s, m, a, v, 1)[0]) for s in (1, 2) for m in "mn" for a in "AB" for v in (0.0, 1.0, 5e9)}) == 24


def test_report_reads_one_table_of_counts(spark):
    rows = [(f"s{i}", "AB"[i % 2], float(i * i % 7), float(i % 2), None if i % 5 == 0 else float(i % 3), 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "session_id string, ab_group string, " + ", ".join(f"{m} double" for m in METRIC_FAMILY))
    counts = resample.value_counts(df, METRIC_FAMILY)
    one = {r.metric: r for r in stats.counted_moments(counts).collect()}
    for r in stats.arm_moments(df).collect():
        got = one[r.metric].asDict()
        for name, v in r.asDict().items():
            assert got[name] == (pytest.approx(v, abs=1e-12) if isinstance(v, float) else v)
    empty = stats.counted_moments(counts.where("false")).collect()
    assert len(empty) == len(METRIC_FAMILY) and all(r.n_a == 0 and r.mean_a is None for r in empty)
