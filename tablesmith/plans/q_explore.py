"""Registered feature, filter and exploratory-statistics queries (F, E, A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions import bins as B
from tablesmith.operators import features, filters, missing
from tablesmith.operators.eda import compare, corr, counts, density, dispatch, groups, regress
from tablesmith.plans.common import round_doubles, sql_round
from tablesmith.plans.q_clean import GL, GL_COLS
from tablesmith.plans.tables import gappy_lineitem, table

Q = {}
SQL = {}


def query(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def w(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def li(spark, sf):
    return table(spark, sf, "lineitem")


# --- features ---------------------------------------------------------------------

@query("feat_log")
def q_log(spark, sf):
    return round_doubles(features.log_feature(li(spark, sf), "l_quantity")[0], only=["log_l_quantity"])


SQL["feat_log"] = sql_round("SELECT *, ln(1 + l_quantity) AS log_l_quantity FROM lineitem", ["log_l_quantity"])


@query("feat_square")
def q_square(spark, sf):
    return round_doubles(features.square_feature(li(spark, sf), "l_discount")[0], only=["l_discount_squared"])


SQL["feat_square"] = sql_round("SELECT *, l_discount * l_discount AS l_discount_squared FROM lineitem",
                               ["l_discount_squared"])


@query("feat_cube")
def q_cube(spark, sf):
    return round_doubles(features.cube_feature(li(spark, sf), "l_discount")[0], only=["l_discount_cubed"])


SQL["feat_cube"] = sql_round("SELECT *, l_discount * l_discount * l_discount AS l_discount_cubed FROM lineitem",
                             ["l_discount_cubed"])


@query("feat_interaction")
def q_inter(spark, sf):
    return round_doubles(features.interaction_feature(li(spark, sf), "l_quantity", "l_extendedprice")[0],
                         only=["l_quantity_x_l_extendedprice"])


SQL["feat_interaction"] = sql_round(
    "SELECT *, l_quantity * l_extendedprice AS l_quantity_x_l_extendedprice FROM lineitem",
    ["l_quantity_x_l_extendedprice"])


@query("feat_ratio")
def q_ratio(spark, sf):
    return round_doubles(features.ratio_feature(li(spark, sf), "l_extendedprice", "l_discount")[0],
                         only=["l_extendedprice_div_l_discount"])


SQL["feat_ratio"] = sql_round(
    "SELECT *, l_extendedprice / nullif(l_discount, 0) AS l_extendedprice_div_l_discount FROM lineitem",
    ["l_extendedprice_div_l_discount"])

_MM = "(SELECT min(l_extendedprice) FROM lineitem)", "(SELECT max(l_extendedprice) FROM lineitem)"


@query("feat_bin_codes")
def q_bin_codes(spark, sf):
    return features.bin_feature(li(spark, sf), "l_extendedprice", 4)[0]


SQL["feat_bin_codes"] = (f"SELECT *, {B.sql_cut_code('l_extendedprice', _MM[0], _MM[1], 4)} "
                         "AS l_extendedprice_binned FROM lineitem")


@query("feat_bin_labels")
def q_bin_labels(spark, sf):
    return features.bin_feature(li(spark, sf), "l_extendedprice", 4, labels=True)[0]


def _edge(i):
    lo, hi = _MM
    if i == 0:
        return f"({lo} - 0.001 * ({hi} - {lo}))"
    if i == 4:
        return hi
    return f"({lo} + {i} * (({hi} - {lo}) / 4))"


SQL["feat_bin_labels"] = ("SELECT *, CASE " + B.sql_cut_code("l_extendedprice", _MM[0], _MM[1], 4) + " " +
                          " ".join(f"WHEN {i} THEN printf('(%.3f, %.3f]', {_edge(i)}, {_edge(i + 1)})"
                                   for i in range(4)) + " END AS l_extendedprice_binned FROM lineitem")

# The part-type domain of the test tables.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("feat_onehot")
def q_feat_onehot(spark, sf):
    return features.onehot_feature(table(spark, sf, "part"), "p_type")[0]


SQL["feat_onehot"] = "SELECT *, " + ", ".join(
    f"coalesce(p_type = '{v}', FALSE) AS p_type_{v}" for v in PART_TYPES) + " FROM part"


@query("feat_zscore")
def q_z(spark, sf):
    return round_doubles(features.zscore_feature(li(spark, sf), "l_extendedprice")[0],
                         only=["l_extendedprice_zscore"])


SQL["feat_zscore"] = sql_round("""
SELECT *, (l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem))
          / (SELECT stddev_samp(l_extendedprice) FROM lineitem) AS l_extendedprice_zscore FROM lineitem""",
                               ["l_extendedprice_zscore"])


@query("feat_normalise")
def q_norm(spark, sf):
    return round_doubles(features.normalise_feature(li(spark, sf), "l_extendedprice")[0],
                         only=["l_extendedprice_normalized"])


SQL["feat_normalise"] = sql_round(f"""
SELECT *, (l_extendedprice - {_MM[0]}) / ({_MM[1]} - {_MM[0]}) AS l_extendedprice_normalized FROM lineitem""",
                                  ["l_extendedprice_normalized"])

EXPR = "l_extendedprice * (1 - l_discount) / nullif(l_quantity, 0)"


@query("feat_expression")
def q_expr(spark, sf):
    return round_doubles(features.expression_feature(li(spark, sf), EXPR, "net_unit_price")[0],
                         only=["net_unit_price"])


SQL["feat_expression"] = sql_round(f"SELECT *, {EXPR} AS net_unit_price FROM lineitem", ["net_unit_price"])


# --- filters ------------------------------------------------------------------------

@query("filter_expression")
def q_filter_expr(spark, sf):
    return filters.filter_expression(gappy_lineitem(spark, sf), "l_quantity > 25 AND l_returnflag = 'R'")


SQL["filter_expression"] = w(GL) + "SELECT * FROM g WHERE l_quantity > 25 AND l_returnflag = 'R'"


@query("filter_not_equal_nulls")
def q_filter_ne(spark, sf):
    return filters.filter_rows(gappy_lineitem(spark, sf), ("l_returnflag", "!=", "R"))


SQL["filter_not_equal_nulls"] = w(GL) + "SELECT * FROM g WHERE l_returnflag IS DISTINCT FROM 'R'"


@query("filter_not")
def q_filter_not(spark, sf):
    return filters.filter_rows(gappy_lineitem(spark, sf), ("not", ("l_quantity", ">", 25)))


SQL["filter_not"] = w(GL) + "SELECT * FROM g WHERE NOT coalesce(l_quantity > 25, FALSE)"


@query("filter_in_chain")
def q_filter_chain(spark, sf):
    spec = ("and", [("l_quantity", "between", (10, 20)), ("l_linestatus", "in", ["O"]),
                    ("or", [("l_returnflag", "==", "A"), ("l_returnflag", "==", "N")])])
    return filters.filter_rows(gappy_lineitem(spark, sf), spec)


SQL["filter_in_chain"] = w(GL) + """
SELECT * FROM g WHERE 10 < l_quantity AND l_quantity < 20 AND l_linestatus IN ('O')
                  AND (l_returnflag = 'A' OR l_returnflag = 'N')"""


# --- counts and histograms --------------------------------------------------------------

@query("category_counts")
def q_cat_counts(spark, sf):
    return round_doubles(counts.category_counts(gappy_lineitem(spark, sf), "l_returnflag", normalize=True))


SQL["category_counts"] = sql_round(w(GL) + """
SELECT coalesce(l_returnflag, '<<MISSING>>') AS category, CAST(count(*) AS BIGINT) AS count,
       count(*) / sum(count(*)) OVER () AS value
FROM g GROUP BY 1""", ["value"])


def _hist_sql(src: str, col: str, n: int, where: str = "") -> str:
    lo = f"(SELECT CAST(min({col}) AS DOUBLE) FROM {src} {where})"
    hi = f"(SELECT CAST(max({col}) AS DOUBLE) FROM {src} {where})"
    a = f"(CASE WHEN {lo} = {hi} THEN {lo} - 0.5 ELSE {lo} END)"
    b = f"(CASE WHEN {lo} = {hi} THEN {hi} + 0.5 ELSE {hi} END)"
    bucket = B.sql_hist_bucket(col, a, b, n)
    cond = f"{where} {'AND' if where else 'WHERE'} {col} IS NOT NULL"
    return f"""
SELECT r.bin, {a} + r.bin * (({b} - {a}) / {n}) AS bin_lo,
       CASE WHEN r.bin = {n - 1} THEN {b} ELSE {a} + (r.bin + 1) * (({b} - {a}) / {n}) END AS bin_hi,
       ({a} + r.bin * (({b} - {a}) / {n})
        + CASE WHEN r.bin = {n - 1} THEN {b} ELSE {a} + (r.bin + 1) * (({b} - {a}) / {n}) END) / 2.0 AS mid,
       CAST(coalesce(c.count, 0) AS BIGINT) AS count, CAST(coalesce(c.count, 0) AS DOUBLE) AS value,
       {lo} > 0 AS logx_available
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range({n})) r
LEFT JOIN (SELECT {bucket} AS bin, count(*) AS count FROM {src} {cond} GROUP BY 1) c USING (bin)"""


@query("histogram")
def q_hist(spark, sf):
    return round_doubles(counts.histogram(li(spark, sf), "l_extendedprice", 30))


SQL["histogram"] = sql_round(_hist_sql("lineitem", "l_extendedprice", 30), ["bin_lo", "bin_hi", "mid", "value"])


@query("histogram_auto")
def q_hist_auto(spark, sf):
    return counts.histogram(li(spark, sf), "l_quantity", "auto")


@query("histogram_2d")
def q_hist2d(spark, sf):
    return round_doubles(counts.histogram_2d(li(spark, sf), "l_quantity", "l_discount", 40))


def _ab(col, src="lineitem"):
    lo = f"(SELECT CAST(min({col}) AS DOUBLE) FROM {src})"
    hi = f"(SELECT CAST(max({col}) AS DOUBLE) FROM {src})"
    return (f"(CASE WHEN {lo} = {hi} THEN {lo} - 0.5 ELSE {lo} END)",
            f"(CASE WHEN {lo} = {hi} THEN {hi} + 0.5 ELSE {hi} END)")


_AX, _BX = _ab("l_quantity")
_AY, _BY = _ab("l_discount")
SQL["histogram_2d"] = sql_round(f"""
SELECT bx, by_ AS "by", {_AX} + bx * (({_BX} - {_AX}) / 40) AS x_lo, {_AY} + by_ * (({_BY} - {_AY}) / 40) AS y_lo,
       CAST(coalesce(count, 0) AS BIGINT) AS count
FROM (SELECT unnest(range(40)) AS bx) CROSS JOIN (SELECT unnest(range(40)) AS by_) LEFT JOIN (SELECT {B.sql_hist_bucket('l_quantity', _AX, _BX, 40)} AS bx,
             {B.sql_hist_bucket('l_discount', _AY, _BY, 40)} AS by_, count(*) AS count
      FROM lineitem WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL GROUP BY 1, 2) USING (bx, by_)""",
                                ["x_lo", "y_lo"])


def _trend_sql(src, x, y, n, group=None):
    lo = f"(SELECT CAST(min({x}) AS DOUBLE) FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    hi = f"(SELECT CAST(max({x}) AS DOUBLE) FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    bucket = B.sql_trend_bucket(x, lo, hi, n)
    mid = (f"0.5 * (({lo} + bin * (({hi} - {lo}) / {n})) + "
           f"CASE WHEN bin = {n - 1} THEN {hi} ELSE {lo} + (bin + 1) * (({hi} - {lo}) / {n}) END)")
    gsel = f"{group} AS \"group\", " if group else ""
    gby = "1, 2" if group else "1"
    return f"""
SELECT {'"group", ' if group else ''}bin, {mid} AS x_mid, mean_y, n FROM (
  SELECT {gsel}{bucket} AS bin, avg(CAST({y} AS DOUBLE)) AS mean_y, CAST(count(*) AS BIGINT) AS n
  FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY {gby})"""


@query("trend_line")
def q_trend(spark, sf):
    return round_doubles(counts.trend_line(li(spark, sf), "l_quantity", "l_extendedprice", 30))


SQL["trend_line"] = sql_round(_trend_sql("lineitem", "l_quantity", "l_extendedprice", 30), ["x_mid", "mean_y"])


@query("joint_marginals")
def q_joint(spark, sf):
    return round_doubles(counts.joint_marginals(li(spark, sf), "l_quantity", "l_discount", 30))


SQL["joint_marginals"] = sql_round(
    "SELECT 'x' AS axis, * FROM (" + _hist_sql("lineitem", "l_quantity", 30) + ")\nUNION ALL\n"
    "SELECT 'y' AS axis, * FROM (" + _hist_sql("lineitem", "l_discount", 30) + ")",
    ["bin_lo", "bin_hi", "mid", "value"])


@query("scatter_sample")
def q_scatter(spark, sf):
    return counts.scatter_sample(li(spark, sf), "l_quantity", "l_extendedprice", "l_returnflag", 5000)


def _hash_sql(cols: list[str], texts: tuple[str, ...] = ()) -> str:
    """The sampling hash of ``functions.sampling`` with seed 0; ``texts`` are columns that aren't numbers."""
    parts = [f"coalesce({c}, '~')" if c in texts else f"coalesce(CAST(CAST(floor({c} * 1e6 + 0.5) AS BIGINT) AS VARCHAR), '~')" for c in cols]
    return f"md5(concat_ws('|', {', '.join(parts)}, '0'))"


def _sample_sql(src: str, cols: list[str], texts: tuple[str, ...], k: int, group: str | None = None) -> str:
    by = f"PARTITION BY {group} " if group else ""
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER ({by}ORDER BY {_hash_sql(cols, texts)}, {', '.join(cols)}) AS _i FROM ({src})) WHERE _i <= {k}")


SQL["scatter_sample"] = _sample_sql("SELECT * FROM lineitem", ["l_quantity", "l_extendedprice", "l_returnflag"], ("l_returnflag",), 5000)


@query("raw_line")
def q_raw_line(spark, sf):
    return counts.raw_line(li(spark, sf), "l_quantity", "l_extendedprice", 2000)


SQL["raw_line"] = _sample_sql("SELECT * FROM lineitem", ["l_quantity", "l_extendedprice"], (), 2000)


@query("group_points")
def q_group_points(spark, sf):
    """Points behind a violin plot with a hue."""
    return dispatch.two_column_points(gappy_lineitem(spark, sf), "l_returnflag", "l_extendedprice", "l_linestatus", "violin", 3000)


SQL["group_points"] = w(GL) + _sample_sql("SELECT * FROM g WHERE l_returnflag IS NOT NULL AND l_extendedprice IS NOT NULL",
                                          ["l_extendedprice", "l_returnflag", "l_linestatus"], ("l_returnflag", "l_linestatus"), 3000)


@query("lines_raw_by_group")
def q_lines_raw(spark, sf):
    by_flag = counts.groups_by_category(gappy_lineitem(spark, sf), "l_returnflag")
    return counts.lines_raw_by_group(by_flag, "l_quantity", "l_extendedprice", 500)


SQL["lines_raw_by_group"] = w(GL) + f"""
SELECT "group", CAST(row_number() OVER (PARTITION BY "group" ORDER BY l_quantity, l_extendedprice) - 1 AS BIGINT) AS point,
       l_quantity AS x, l_extendedprice AS y, CAST(count(*) OVER (PARTITION BY "group") AS BIGINT) AS n_points
FROM ({_sample_sql("SELECT *, coalesce(l_returnflag, '<<MISSING>>') AS grp FROM g WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL",
                   ["grp", "l_quantity", "l_extendedprice"], ("grp",), 500, "grp")}) AS _s("group", l_quantity, l_extendedprice)"""


# --- grouped ------------------------------------------------------------------------------

@query("group_box_stats")
def q_box(spark, sf):
    return round_doubles(groups.group_box_stats(gappy_lineitem(spark, sf), "l_extendedprice",
                                                "l_returnflag", "l_linestatus"))


SQL["group_box_stats"] = sql_round(w(GL) + """
SELECT l_returnflag AS "group", l_linestatus AS hue_value, CAST(count(l_extendedprice) AS BIGINT) AS count,
       avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS std, min(l_extendedprice) AS min,
       quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
       quantile_cont(l_extendedprice, 0.75) AS q3, max(l_extendedprice) AS max
FROM g WHERE l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1, 2""",
                                   ["mean", "std", "min", "q1", "median", "q3", "max"])


@query("group_bar")
def q_bar(spark, sf):
    return round_doubles(groups.group_bar(gappy_lineitem(spark, sf), "l_extendedprice", "l_returnflag"))


SQL["group_bar"] = sql_round(w(GL) + """
SELECT l_returnflag AS "group", avg(l_extendedprice) AS value, CAST(count(l_extendedprice) AS BIGINT) AS count,
       stddev_samp(l_extendedprice) AS std
FROM g WHERE l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1""", ["value", "std"])


@query("contingency")
def q_contingency(spark, sf):
    return groups.contingency(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


SQL["contingency"] = """
WITH o AS (SELECT coalesce(o_orderstatus, '<<MISSING>>') AS x_value, coalesce(o_orderpriority, '<<MISSING>>') AS y_value FROM orders)
SELECT x_value, y_value, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT x_value FROM o) CROSS JOIN (SELECT DISTINCT y_value FROM o)
LEFT JOIN (SELECT x_value, y_value, count(*) AS n FROM o GROUP BY 1, 2) USING (x_value, y_value)"""


@query("lines_hist_by_group")
def q_lines_hist(spark, sf):
    g = counts.groups_by_category(gappy_lineitem(spark, sf), "l_returnflag")
    return round_doubles(counts.lines_hist_by_group(g, "l_quantity", 20, normalize=True))


def _group_hist_sql(src: str, col: str, n: int, normalize: bool) -> str:
    lo = f"(SELECT CAST(min({col}) AS DOUBLE) FROM {src})"
    hi = f"(SELECT CAST(max({col}) AS DOUBLE) FROM {src})"
    a = f"(CASE WHEN {lo} = {hi} THEN {lo} - 0.5 ELSE {lo} END)"
    b = f"(CASE WHEN {lo} = {hi} THEN {hi} + 0.5 ELSE {hi} END)"
    bucket = B.sql_hist_bucket(col, a, b, n)
    value = ("CASE WHEN sum(coalesce(c.count, 0)) OVER (PARTITION BY gr.\"group\") > 0 THEN "
             "coalesce(c.count, 0) / sum(coalesce(c.count, 0)) OVER (PARTITION BY gr.\"group\") "
             "ELSE CAST(coalesce(c.count, 0) AS DOUBLE) END") if normalize else "CAST(coalesce(c.count, 0) AS DOUBLE)"
    return f"""
SELECT gr."group", gr.bin, {a} + gr.bin * (({b} - {a}) / {n}) AS bin_lo,
       CASE WHEN gr.bin = {n - 1} THEN {b} ELSE {a} + (gr.bin + 1) * (({b} - {a}) / {n}) END AS bin_hi,
       ({a} + gr.bin * (({b} - {a}) / {n})
        + CASE WHEN gr.bin = {n - 1} THEN {b} ELSE {a} + (gr.bin + 1) * (({b} - {a}) / {n}) END) / 2.0 AS mid,
       CAST(coalesce(c.count, 0) AS BIGINT) AS count, {value} AS value, {lo} > 0 AS logx_available
FROM (SELECT k."group", CAST(r.range AS BIGINT) AS bin
      FROM (SELECT DISTINCT "group" FROM {src} WHERE {col} IS NOT NULL) k CROSS JOIN range({n}) r) gr
LEFT JOIN (SELECT "group", {bucket} AS bin, count(*) AS count FROM {src} WHERE {col} IS NOT NULL
           GROUP BY 1, 2) c USING ("group", bin)"""


SQL["lines_hist_by_group"] = sql_round(
    w(GL, "gg AS (SELECT *, coalesce(l_returnflag, '<<MISSING>>') AS \"group\" FROM g)")
    + _group_hist_sql("gg", "l_quantity", 20, True), ["bin_lo", "bin_hi", "mid", "value"])


@query("lines_mean_by_group")
def q_lines_mean(spark, sf):
    g = counts.groups_by_category(li(spark, sf), "l_linestatus")
    return round_doubles(counts.lines_mean_by_group(g, "l_quantity", "l_extendedprice", 10))


SQL["lines_mean_by_group"] = sql_round(
    "WITH gg AS (SELECT *, coalesce(l_linestatus, '<<MISSING>>') AS grp FROM lineitem)\n"
    + _trend_sql("gg", "l_quantity", "l_extendedprice", 10, group="grp"), ["x_mid", "mean_y"])

LINE_FILTERS = {"big": "l_quantity > 40", "cheap": "l_extendedprice < 10000", "broken": "no_such_column > 1"}


@query("lines_by_filters")
def q_lines_filters(spark, sf):
    g, _warn = counts.groups_by_filters(li(spark, sf), list(LINE_FILTERS.values()), list(LINE_FILTERS))
    return round_doubles(counts.lines_hist_by_group(g, "l_discount", 10))


SQL["lines_by_filters"] = sql_round(
    "WITH gg AS (SELECT *, 'big' AS \"group\" FROM lineitem WHERE l_quantity > 40 UNION ALL "
    "SELECT *, 'cheap' AS \"group\" FROM lineitem WHERE l_extendedprice < 10000)\n"
    + _group_hist_sql("gg", "l_discount", 10, False), ["bin_lo", "bin_hi", "mid", "value"])


# --- correlation -----------------------------------------------------------------------------

CORR_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pairs_sql(body_fn, value: str) -> str:
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i + 1:]:
            parts.append(body_fn(a, b))
    pairs = " UNION ALL ".join(parts)
    diag = " UNION ALL ".join(f"SELECT '{c}' AS col_x, '{c}' AS col_y, 1.0::DOUBLE AS {value}" for c in CORR_COLS)
    return (f"WITH g AS ({GL[len('g AS ('):-1]}), p AS ({pairs})\n"
            f"SELECT col_x, col_y, {value} FROM p UNION ALL SELECT col_y, col_x, {value} FROM p UNION ALL {diag}")


@query("corr_pearson")
def q_pearson(spark, sf):
    return round_doubles(corr.pearson_matrix(gappy_lineitem(spark, sf), CORR_COLS))


SQL["corr_pearson"] = sql_round(_pairs_sql(
    lambda a, b: f"SELECT '{a}' AS col_x, '{b}' AS col_y, corr({a}, {b}) AS r FROM g", "r"), ["r"])


@query("corr_spearman")
def q_spearman(spark, sf):
    return round_doubles(corr.spearman_matrix(gappy_lineitem(spark, sf), CORR_COLS))


def _spear(a, b):
    return f"""SELECT '{a}' AS col_x, '{b}' AS col_y, corr(rx, ry) AS rho FROM (
  SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS ry
  FROM g WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


SQL["corr_spearman"] = sql_round(_pairs_sql(_spear, "rho"), ["rho"])


@query("corr_kendall")
def q_kendall(spark, sf):
    return round_doubles(corr.kendall_matrix(gappy_lineitem(spark, sf), CORR_COLS))


def _kendall(a, b):
    """Inversions of y in the order of x, counted bit by bit of y's rank: behind a common prefix, ones that stand before zeros."""
    return f"""SELECT '{a}' AS col_x, '{b}' AS col_y,
  (n0 - ty - (tx - txy) - 2 * inv) / sqrt((n0 - tx) * (n0 - ty)) AS tau FROM (
  WITH d AS (SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM g WHERE {a} IS NOT NULL AND {b} IS NOT NULL),
  r AS (SELECT row_number() OVER (ORDER BY x, y) AS p, dense_rank() OVER (ORDER BY y) - 1 AS r FROM d),
  bits AS (SELECT (r >> k) & 1 AS bit, sum((r >> k) & 1) OVER (PARTITION BY k, r >> (k + 1) ORDER BY p) AS ones FROM r, range(21) AS t(k))
  SELECT (SELECT count(*) * (count(*) - 1.0) / 2 FROM d) AS n0, (SELECT sum(ones) FROM bits WHERE bit = 0)::DOUBLE AS inv,
         (SELECT sum(t * (t - 1.0) / 2) FROM (SELECT count(*) AS t FROM d GROUP BY x)) AS tx,
         (SELECT sum(t * (t - 1.0) / 2) FROM (SELECT count(*) AS t FROM d GROUP BY y)) AS ty,
         (SELECT sum(t * (t - 1.0) / 2) FROM (SELECT count(*) AS t FROM d GROUP BY x, y)) AS txy)"""


SQL["corr_kendall"] = sql_round(_pairs_sql(_kendall, "tau"), ["tau"])


# --- regression ------------------------------------------------------------------------------

@query("regress_linear")
def q_reg_lin(spark, sf):
    return round_doubles(regress.regression_coefficients(li(spark, sf), "l_quantity", "l_extendedprice", 1))


SQL["regress_linear"] = sql_round("""
SELECT 1 AS power, regr_slope(l_extendedprice, l_quantity) AS coefficient FROM lineitem
UNION ALL SELECT 0, regr_intercept(l_extendedprice, l_quantity) FROM lineitem""", ["coefficient"])


@query("regress_log_x")
def q_reg_log(spark, sf):
    return round_doubles(regress.regression_coefficients(li(spark, sf), "l_extendedprice", "l_quantity", 1,
                                                         logx=True))


SQL["regress_log_x"] = sql_round("""
SELECT 1 AS power, regr_slope(l_quantity, ln(l_extendedprice)) AS coefficient FROM lineitem
UNION ALL SELECT 0, regr_intercept(l_quantity, ln(l_extendedprice)) FROM lineitem""", ["coefficient"])


@query("regress_curve")
def q_reg_curve(spark, sf):
    fit = regress.poly_fit(li(spark, sf), "l_quantity", "l_extendedprice", 1)
    return round_doubles(regress.fit_curve(spark, fit, 200))


SQL["regress_curve"] = sql_round("""
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
                  CAST(min(l_quantity) AS DOUBLE) AS lo, CAST(max(l_quantity) AS DOUBLE) AS hi FROM lineitem)
SELECT CAST(range AS BIGINT) AS point, lo + range * ((hi - lo) / 199) AS x,
       b * (lo + range * ((hi - lo) / 199)) + a AS y_fit
FROM f, range(200)""", ["x", "y_fit"])


@query("regress_poly2")
def q_reg_poly2(spark, sf):
    return round_doubles(regress.regression_coefficients(li(spark, sf), "l_quantity", "l_extendedprice", 2), 4)


# the quadratic through its residual on the line: z = x^2 less its own line in x
SQL["regress_poly2"] = sql_round("""
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y, l_quantity * l_quantity AS q FROM lineitem),
s AS (SELECT regr_slope(q, x) AS qb, regr_intercept(q, x) AS qa FROM d),
c AS (SELECT sum((q - qa - qb * x) * y) / sum((q - qa - qb * x) * (q - qa - qb * x)) AS c2 FROM d, s),
l AS (SELECT c2, regr_slope(y - c2 * q, x) AS c1, regr_intercept(y - c2 * q, x) AS c0 FROM d, c GROUP BY c2)
SELECT CAST(unnest([2, 1, 0]) AS INTEGER) AS power, unnest([c2, c1, c0]) AS coefficient FROM l""", ["coefficient"], 4)


@query("pearson_test")
def q_pearson_test(spark, sf):
    return round_doubles(regress.pearson_test(li(spark, sf), "l_quantity", "l_extendedprice", with_p=False))


SQL["pearson_test"] = sql_round("""
SELECT corr(l_quantity, l_extendedprice) AS r, corr(l_quantity, l_extendedprice) * corr(l_quantity, l_extendedprice)
       AS r_squared, CAST(count(*) AS BIGINT) AS n
FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL""", ["r", "r_squared"])


def _robust_sql(x: str, y: str, rounds: int, tail: str) -> str:
    """Huber's line by ``rounds`` reweighted fits, written out; ``tail`` reads them as f, of (a, b)."""
    line = """SELECT (sy - b * sx) / sw AS a, b FROM (SELECT *, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS b FROM (
      SELECT sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM {rows}))"""
    parts = [f"d AS MATERIALIZED (SELECT {x} AS x, l_{y} AS y FROM lineitem)", f"f0 AS MATERIALIZED ({line.format(rows='(SELECT *, 1.0 AS w FROM d)')})"]
    for k in range(rounds):
        parts.append(f"m{k} AS MATERIALIZED (SELECT quantile_cont(abs(y - (a + b * x)), 0.5) / 0.67449 AS s FROM d, f{k})")
        weighted = f"(SELECT x, y, CASE WHEN abs(y - (a + b * x)) / s <= 1.345 THEN 1.0 ELSE 1.345 / (abs(y - (a + b * x)) / s) END AS w FROM d, f{k}, m{k})"
        parts.append(f"f{k + 1} AS MATERIALIZED ({line.format(rows=weighted)})")
    parts.append(f"f AS (SELECT * FROM f{rounds})")
    return "WITH " + ",\n".join(parts) + "\n" + tail


@query("regress_robust")
def q_robust(spark, sf):
    fit = regress.robust_line(li(spark, sf), "l_quantity", "l_extendedprice")
    return round_doubles(fit.select("intercept", "slope", "converged"), 3)


SQL["regress_robust"] = sql_round(_robust_sql("l_quantity", "extendedprice", 20, "SELECT a AS intercept, b AS slope, TRUE AS converged FROM f"),
                                  ["intercept", "slope"], 3)


@query("regress_robust_curve")
def q_robust_curve(spark, sf):
    fit = regress.robust_fit(li(spark, sf), "l_extendedprice", "l_quantity", logx=True)
    return round_doubles(regress.fit_curve(spark, fit, 200), 3)


SQL["regress_robust_curve"] = sql_round(_robust_sql("ln(l_extendedprice)", "quantity", 20, """
SELECT range AS point, lo + range * ((hi - lo) / 199) AS x, a + b * ln(lo + range * ((hi - lo) / 199)) AS y_fit
FROM range(200), f, (SELECT exp(min(x)) AS lo, exp(max(x)) AS hi FROM d)"""), ["x", "y_fit"], 3)


def _lowess_sql(x: str, y: str, shown: str, rounds: int = 3, points: int = 50) -> str:
    last = points - 1
    parts = [f"d AS MATERIALIZED (SELECT {x} AS x, {y} AS y FROM lineitem)",
             "m AS MATERIALIZED (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n FROM d)",
             f"grid AS MATERIALIZED (SELECT range AS g, lo + range * ((hi - lo) / {last}) AS gx FROM range({points}), m)",
             """bw AS MATERIALIZED (SELECT g, greatest(min(far), 1e-300) AS h FROM (SELECT g, far, sum(c) OVER (PARTITION BY g ORDER BY far) AS cum
                  FROM grid, (SELECT x, count(*) AS c FROM d GROUP BY x), LATERAL (SELECT abs(x - gx) AS far)), m WHERE cum >= ceil(0.66 * n) GROUP BY g)"""]
    for it in range(rounds + 1):
        kept = "SELECT x, y, 1.0 AS k FROM d" if not it else f"""SELECT x, y, CASE WHEN off / (6 * mid) < 1
                  THEN (1 - (off / (6 * mid)) * (off / (6 * mid))) ** 2 ELSE 0.0 END AS k FROM r{it - 1}, md{it - 1}"""
        parts.append(f"""fit{it} AS MATERIALIZED (SELECT g, CASE WHEN w * wcc - wc * wc > 1e-12 * greatest(1.0, w * wcc)
                  THEN (wcc * wy - wc * wcy) / (w * wcc - wc * wc) ELSE wy / w END AS v FROM (
          SELECT g, sum(t * k) AS w, sum(t * k * c) AS wc, sum(t * k * c * c) AS wcc, sum(t * ky) AS wy, sum(t * ky * c) AS wcy FROM (
            SELECT g, k, ky, x - gx AS c, CASE WHEN abs(x - gx) / h < 1 THEN (1 - (abs(x - gx) / h) ** 3) ** 3 ELSE 0.0 END AS t
            FROM (SELECT x, sum(k) AS k, sum(k * y) AS ky FROM ({kept}) GROUP BY x), grid JOIN bw USING (g)) GROUP BY g))""")
        if it < rounds:
            parts.append(f"""r{it} AS MATERIALIZED (SELECT x, y, abs(y - (p.v + (q.v - p.v) * ((x - (lo + p.g * step)) / step))) AS off FROM (
              SELECT *, (hi - lo) / {last} AS step, least(greatest(floor((x - lo) / ((hi - lo) / {last})), 0), {last - 1}) AS i FROM d, m)
              JOIN fit{it} p ON p.g = i JOIN fit{it} q ON q.g = i + 1)""")
            parts.append(f"md{it} AS MATERIALIZED (SELECT quantile_cont(off, 0.5) AS mid FROM r{it})")
    return "WITH " + ",\n".join(parts) + f"\nSELECT CAST(g AS INTEGER) AS point, {shown} AS x, v AS y_fit FROM fit{rounds} JOIN grid USING (g)"


@query("regress_lowess")
def q_lowess(spark, sf):
    return round_doubles(regress.lowess_grid(li(spark, sf), "l_quantity", "l_extendedprice"), 4)


SQL["regress_lowess"] = sql_round(_lowess_sql("l_quantity", "l_extendedprice", "gx"), ["x", "y_fit"], 4)


@query("regress_lowess_log")
def q_lowess_log(spark, sf):
    return round_doubles(regress.lowess_grid(li(spark, sf), "l_extendedprice", "l_quantity", logx=True), 4)


SQL["regress_lowess_log"] = sql_round(_lowess_sql("ln(l_extendedprice)", "l_quantity", "exp(gx)"), ["x", "y_fit"], 4)


@query("density_grid")
def q_density(spark, sf):
    return round_doubles(density.density_grid(li(spark, sf), "l_quantity", "l_discount"))


SQL["density_grid"] = sql_round("""
WITH m AS (SELECT min(l_quantity) AS x0, (max(l_quantity) - min(l_quantity)) / 59 AS sx, min(l_discount) AS y0, (max(l_discount) - min(l_discount)) / 59 AS sy,
                  var_samp(l_quantity) * pow(count(*), -2.0 / 6) AS vx, var_samp(l_discount) * pow(count(*), -2.0 / 6) AS vy,
                  covar_samp(l_quantity, l_discount) * pow(count(*), -2.0 / 6) AS cxy, count(*) AS n FROM lineitem),
k AS (SELECT *, vx * vy - cxy * cxy AS det FROM m),
p AS (SELECT l_quantity AS px, l_discount AS py, count(*) AS w FROM lineitem GROUP BY 1, 2)
SELECT ix, iy, x0 + ix * sx AS x, y0 + iy * sy AS y,
       sum(w * exp(-0.5 * (vy * (x0 + ix * sx - px) * (x0 + ix * sx - px) - 2 * cxy * (x0 + ix * sx - px) * (y0 + iy * sy - py)
                           + vx * (y0 + iy * sy - py) * (y0 + iy * sy - py)) / det)) / (2 * pi() * sqrt(det) * n) AS density
FROM p, k, range(60) AS a(ix), range(60) AS b(iy) GROUP BY ix, iy, x0, sx, y0, sy, det, n""", ["x", "y", "density"])


# --- before / after ---------------------------------------------------------------------------

@query("compare_before_after")
def q_compare(spark, sf):
    before = gappy_lineitem(spark, sf)
    after = missing.fill_mean(before, ["l_quantity"])
    return round_doubles(compare.compare_before_after(before, after, "l_quantity", 30))


_FILLED = "(SELECT avg(l_quantity) FROM g)"
SQL["compare_before_after"] = sql_round(w(GL) + f"""
, t AS (SELECT 'before' AS phase, l_quantity AS v FROM g
        UNION ALL SELECT 'after', coalesce(l_quantity, {_FILLED}) FROM g),
lim AS (SELECT min(v) AS lo, max(v) AS hi FROM t),
ab AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS a, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS b
       FROM lim),
c AS (SELECT phase, CASE WHEN v IS NULL THEN NULL ELSE CAST(least(29, floor((v - a) * 30.0 / (b - a))) AS BIGINT) END AS bin,
             count(*) AS n FROM t, ab WHERE v IS NOT NULL GROUP BY 1, 2)
SELECT p.phase, CAST(r.range AS BIGINT) AS bin, a + r.range * ((b - a) / 30) AS bin_lo,
       CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (SELECT DISTINCT phase FROM t) p CROSS JOIN range(30) r CROSS JOIN ab
LEFT JOIN c ON c.phase = p.phase AND c.bin = r.range""", ["bin_lo"])


@query("change_summary")
def q_change(spark, sf):
    before = gappy_lineitem(spark, sf)
    after = missing.dropna_rows(before, ["l_quantity"])
    return round_doubles(compare.change_summary(before, after, "l_extendedprice"))


SQL["change_summary"] = sql_round(w(GL) + """
, b AS (SELECT CAST(count(*) AS BIGINT) AS rows_before, avg(l_extendedprice) AS mean_before,
               stddev_samp(l_extendedprice) AS std_before FROM g),
a AS (SELECT CAST(count(*) AS BIGINT) AS rows_after, avg(l_extendedprice) AS mean_after,
             stddev_samp(l_extendedprice) AS std_after FROM g WHERE l_quantity IS NOT NULL)
SELECT *, rows_after - rows_before AS rows_change, mean_after - mean_before AS mean_change,
       std_after - std_before AS std_change FROM b, a""",
                                  ["mean_before", "std_before", "mean_after", "std_after", "mean_change", "std_change"])

_ = GL_COLS
