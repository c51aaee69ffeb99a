"""The semantic trap rules, one small table each."""

import pytest
from pyspark.sql import functions as F

from tablesmith.operators import encode, features, filters, missing, profile, text
from tablesmith.operators.eda import corr, counts
from tablesmith.sources.files import nan_to_null


def col_df(spark, values, name="x", typ="double"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} {typ}")


def test_t1_nan_is_missing(spark):
    df = nan_to_null(col_df(spark, [1.0, float("nan"), 3.0]))
    assert df.filter(F.col("x").isNull()).count() == 1


def test_t3_not_equal_keeps_missing(spark):
    df = col_df(spark, [1.0, None, 5.0])
    kept = sorted((r["x"] is None, r["x"]) for r in filters.filter_rows(df, ("x", "!=", 5.0)).collect())
    assert kept == [(False, 1.0), (True, None)]
    kept_not = filters.filter_rows(df, ("not", ("x", ">", 2.0))).count()
    assert kept_not == 2


def test_t4_histogram_left_closed(spark):
    df = col_df(spark, [0, 1, 2, 3, 4, 5, 6, 7, 8, 10])
    h = sorted(counts.histogram(df, "x", 4).collect(), key=lambda r: r["bin"])
    assert [r["count"] for r in h] == [3, 2, 3, 2]
    assert [r["bin_lo"] for r in h] == [0.0, 2.5, 5.0, 7.5] and h[-1]["bin_hi"] == 10.0


def test_t4_histogram_constant(spark):
    h = sorted(counts.histogram(col_df(spark, [3.0, 3.0]), "x", 4).collect(), key=lambda r: r["bin"])
    assert [r["count"] for r in h] == [0, 0, 2, 0]
    assert h[0]["bin_lo"] == 2.5 and h[-1]["bin_hi"] == 3.5


def test_t5_cut_codes_right_closed(spark):
    df = col_df(spark, [0, 1, 2, 3, 4, 5, 6, 7, 8, 10])
    out, info = features.bin_feature(df, "x", 4)
    codes = [r["x_binned"] for r in out.orderBy("x").collect()]
    assert codes == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3]


def test_t6_trend_constant_last_bin(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "x double, y double")
    rows = counts.trend_line(df, "x", "y", 4).collect()
    assert [r["bin"] for r in rows] == [3]


def test_t9_corrected_moments(spark):
    r = profile.column_moments(col_df(spark, [1, 2, 4, 5, 9]), "x").first()
    assert r["skew"] == pytest.approx(0.93345, abs=1e-5)
    assert r["kurtosis"] == pytest.approx(0.76204, abs=1e-5)


def test_t10_mode_tie_smallest(spark):
    df = col_df(spark, [2, 1, 1, 2, None])
    assert missing.fill_mode(df).filter(F.col("x").isNull()).count() == 0
    assert sorted(r["x"] for r in missing.fill_mode(df).collect()) == [1, 1, 1, 2, 2]


def test_t15_numeric_coercion(spark):
    vals = ["1e3", " 12 ", "inf", "1.0d", "0x10", "1_000", "", "12abc", "True"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    out = [r["s"] for r in text.coerce_types(df, ["s"], "numeric").orderBy("i").collect()]
    assert out[:3] == [1000.0, 12.0, float("inf")]
    assert out[3:] == [None] * 6


def test_t14_unicode_whitespace(spark):
    df = spark.createDataFrame([("  a   b\t\nC  ",)], "s string")
    assert text.standardise_text(df, ["s"], case="lower").first()["s"] == "a b c"


def test_t17_spearman_per_pair(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, None), (4.0, 4.0), (None, 5.0), (6.0, 3.0)],
                               "x double, y double")
    m = {(r["col_x"], r["col_y"]): r["rho"] for r in corr.spearman_matrix(df, ["x", "y"]).collect()}
    assert m[("x", "y")] == pytest.approx(0.6)


def test_t12_label_codes_missing_sorted_as_nan(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("z",)], "c string")
    out = sorted((r["c"]) for r in encode.encode_label(df, ["c"]).collect())
    assert out == [0, 1, 2, 3]
    m = {r["label"]: r["code"] for r in encode.label_map(df, "c").collect()}
    assert m == {"a": 0, "b": 1, "nan": 2, "z": 3}


def test_t18_constant_fill_typed(spark):
    df = spark.createDataFrame([(None, None), (1.5, "x")], "a double, b string")
    out = missing.fill_constant(df, None, "0").orderBy("b").collect()
    assert out[0]["a"] == 0.0 and out[0]["b"] == "0"
    with pytest.raises(ValueError):
        missing.fill_constant(spark.createDataFrame([(None,)], "a int"), None, "abc")


def test_t19_drop_cols_needs_columns(spark):
    with pytest.raises(ValueError):
        missing.dropna_cols(col_df(spark, [1.0]), [])


def test_t21_outlier_remove_drops_missing_cap_keeps(spark):
    from tablesmith.operators import outliers
    df = col_df(spark, [1, 2, 3, 4, 100, None])
    assert outliers.handle_outliers(df, "x", "remove").count() == 4
    capped = outliers.handle_outliers(df, "x", "cap")
    assert capped.count() == 6 and capped.filter(F.col("x").isNull()).count() == 1


def test_log_guard_refuses_below_minus_one(spark):
    with pytest.raises(ValueError):
        features.log_feature(col_df(spark, [-2.0, 1.0]), "x")


def test_expression_refuses_aggregates_and_reflect(spark):
    df = col_df(spark, [1.0, 2.0])
    with pytest.raises(Exception):
        features.expression_feature(df, "avg(x)", "m")
    with pytest.raises(ValueError):
        features.expression_feature(df, "reflect('java.lang.System', 'exit', 0)", "m")
    out, _ = features.expression_feature(df, "floor(try_divide(x, 2))", "h")
    assert [r["h"] for r in out.orderBy("x").collect()] == [0, 1]


def test_quantiles_and_modes_against_numpy(spark):
    import numpy as np

    from tablesmith.functions.quantile import column_modes, column_quantiles, quantiles_by
    rng = np.random.default_rng(5)
    rows = [(("a", "b", None)[i % 3], float(rng.integers(0, 40)) if i % 7 else None, float(rng.normal())) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = column_quantiles(df, ["x", "y"], probs)
    x = [r[1] for r in rows if r[1] is not None]
    assert got["x"] == pytest.approx(list(np.quantile(x, probs)))
    assert got["y"] == pytest.approx(list(np.quantile([r[2] for r in rows], probs)))
    by = {r["g"]: list(r["q"]) for r in quantiles_by(df, F.col("x"), probs, {"g": F.col("g")}).collect()}
    for g in ("a", "b", None):
        assert by[g] == pytest.approx(list(np.quantile([r[1] for r in rows if r[0] == g and r[1] is not None], probs)))
    values, counts = np.unique(x, return_counts=True)
    assert column_modes(df, ["x"])["x"] == values[counts.argmax()]
    assert column_quantiles(df.where("false"), ["x"], [0.5])["x"] is None
    assert missing.fill_median(spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")).where("x = 2").count() == 1


def test_expressions_are_judged_by_their_plan(spark):
    from tablesmith.operators import features, filters
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    for bad in ("explode(array(1, 2))", "row_number() over (order by x)", "(select 1)", "reflect('java.lang.Math', 'abs', 1)"):
        with pytest.raises(ValueError):
            features.expression_feature(df, bad, "n")
    out, _ = features.expression_feature(df, "concat('select ', x) -- select", "n")
    assert out.count() == 2
    with pytest.raises(ValueError):
        filters.filter_expression(df, "x in (select 1.0)")
    assert filters.filter_expression(df, "x > 1 and 'reflect' = 'reflect'").count() == 1


def test_edge_cases_of_correlation_and_lines(spark):
    from tablesmith.operators.eda import corr, regress
    df = spark.createDataFrame([(float(i), 3.0, 2.0 * i + 1) for i in range(6)], "x double, k double, y double")
    for method in ("pearson", "spearman", "kendall"):
        m = {(r[0], r[1]): r[2] for r in corr.correlation_matrix(df, ["x", "k", "y"], method).collect()}
        assert m["x", "y"] == pytest.approx(1.0) and m["x", "k"] is None or m["x", "k"] != m["x", "k"]
        assert m["k", "k"] is None and m["x", "x"] == 1.0
    t = regress.pearson_test(df, "x", "y").first()
    assert t["r"] == pytest.approx(1.0) and t["p_value"] == pytest.approx(0.0, abs=1e-6)
    line = regress.robust_line(df, "k", "y").first()
    assert line["slope"] is None and regress.robust_line(df, "x", "y").first()["slope"] == pytest.approx(2.0)


def test_missing_p_values_and_counts(spark):
    from tablesmith.operators.experiment import stats
    p = spark.createDataFrame([("a", 0.01), ("b", None), ("c", 0.04)], "m string, p_value double")
    got = {r["m"]: r["p_fdr"] for r in stats.bh_adjust(p).collect()}
    assert got["b"] is None and got["a"] == pytest.approx(0.02) and got["c"] == pytest.approx(0.04)
    s = spark.createDataFrame([("1", "A", 1.0), ("2", "A", None), ("3", "B", 2.0)], "session_id string, ab_group string, v double")
    m = stats.arm_moments(s, ["v"]).first()
    assert (m["n_a"], m["n_b"]) == (1, 1)


def test_boolean_onehot_dotted_names_and_quotes(spark, scratch_dir):
    from tablesmith.operators import encode
    from tablesmith.operators.eda import groups
    from tablesmith.sources import files
    df = spark.createDataFrame([(True, 1.0, "u"), (False, float("nan"), "v"), (None, 3.0, "u")], "f boolean, `a.b` double, g string")
    got = encode.onehot_feature(df, "f").collect()
    assert [r["f_True"] for r in got] == [True, False, False] and [r["f_False"] for r in got] == [False, True, False]
    clean = files.nan_to_null(df)
    assert [r[1] for r in clean.collect()] == [1.0, None, 3.0]
    assert groups.group_box_stats(clean, "a.b", "g").count() == 1
    text = spark.createDataFrame([('say "hi", ok', 1)], "t string, n int")
    files.write_csv(text, f"{scratch_dir}/q")
    assert files.read_csv(spark, f"{scratch_dir}/q").first()["t"] == 'say "hi", ok'


def test_duplicates_unfold_in_chunks(spark):
    from tablesmith.operators import dedupe
    df = spark.range(25_000).select(F.lit(1).alias("x")).union(spark.range(1).select(F.lit(2)))
    assert dedupe.duplicate_rows(df).groupBy("x").count().collect()[0]["count"] == 25_000


def test_labels_are_ranked_over_ranges(spark):
    from tablesmith.operators import encode
    df = spark.range(3000).select(F.concat(F.lit("k"), (F.col("id") * 7919 % 3000).cast("string")).alias("c"))
    codes = {r["label"]: r["code"] for r in encode.label_map(df, "c").collect()}
    assert codes == {v: i for i, v in enumerate(sorted(codes))} and len(codes) == 3000


def test_filters_push_below_the_nan_rewrite(spark, scratch_dir):
    from tablesmith.operators import filters
    spark.createDataFrame([(float("nan"),), (1.0,), (5.0,), (None,)], "v double").write.parquet(f"{scratch_dir}/p")
    got = filters.scan_where(spark, f"{scratch_dir}/p", ("v", ">", 2.0))
    assert "GreaterThan(v,2.0)" in got._jdf.queryExecution().executedPlan().toString()
    assert [r["v"] for r in got.collect()] == [5.0]
    assert filters.scan_where(spark, f"{scratch_dir}/p", ("v", "!=", 1.0)).count() == 3
