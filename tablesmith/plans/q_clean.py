"""Registered profiling and cleaning queries (P, M, D, C, N) and their twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.operators import dedupe, encode, missing, outliers, profile, scale, text
from tablesmith.plans.common import round_doubles, sql_round
from tablesmith.plans.tables import GAPPY_LINEITEM_SQL, gappy_lineitem, table

Q = {}
SQL = {}


def query(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


GL_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
GL_TYPES = ["bigint", "int", "bigint", "bigint", "double", "double", "double", "double",
            "string", "string", "timestamp_ntz"]
GL_NUM = GL_COLS[:8]
GL_DBL = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GL = f"g AS ({GAPPY_LINEITEM_SQL})"

# Few columns with small domains: many duplicate rows.
DUP_COLS = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
DUP = "d AS (SELECT " + ", ".join(DUP_COLS) + " FROM g)"


def dup_view(spark, sf):
    return gappy_lineitem(spark, sf).select(*DUP_COLS)


def w(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


def union(parts):
    return "\nUNION ALL\n".join(parts)


# --- profiling --------------------------------------------------------------

@query("profile_overview")
def q_overview(spark, sf):
    return profile.overview(dup_view(spark, sf))


_nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in DUP_COLS)
SQL["profile_overview"] = w(GL, DUP) + f"""
, grp AS (SELECT count(*) AS c, {_nulls} AS nulls FROM d GROUP BY {", ".join(DUP_COLS)})
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST({len(DUP_COLS)} AS BIGINT) AS n_cols,
       CAST(sum(c * nulls) AS BIGINT) AS n_missing, CAST(sum(c) - count(*) AS BIGINT) AS n_duplicates,
       '{",".join(DUP_COLS[:3])}' AS numeric_columns, '{",".join(DUP_COLS[3:])}' AS categorical_columns
FROM grp"""


@query("profile_columns")
def q_columns(spark, sf):
    return profile.column_info(gappy_lineitem(spark, sf))


SQL["profile_columns"] = w(GL) + union([
    f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype,
        {str(t not in ('string', 'timestamp_ntz')).upper()} AS is_numeric, {str(t == 'string').upper()} AS is_categorical,
        CAST(count({c}) AS BIGINT) AS non_null, CAST(count(*) - count({c}) AS BIGINT) AS missing,
        floor((count(*) - count({c})) / greatest(count(*), 1) * 100.0 * 100.0 + 0.5) / 100.0 AS missing_pct,
        CAST(count(DISTINCT {c}) AS BIGINT) AS "unique" FROM g"""
    for i, (c, t) in enumerate(zip(GL_COLS, GL_TYPES))])


@query("describe_numeric")
def q_desc_num(spark, sf):
    return round_doubles(profile.describe_numeric(gappy_lineitem(spark, sf)))


SQL["describe_numeric"] = sql_round(w(GL) + union([
    f"""SELECT {i} AS position, '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count,
        avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std,
        CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,
        quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75,
        CAST(max({c}) AS DOUBLE) AS max FROM g""" for i, c in enumerate(GL_NUM)]),
    ["mean", "std", "min", "p25", "p50", "p75", "max"])


@query("describe_categorical")
def q_desc_cat(spark, sf):
    return profile.describe_categorical(gappy_lineitem(spark, sf))


SQL["describe_categorical"] = w(GL) + union([
    f"""SELECT {i} AS position, '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count,
        CAST(count(*) AS BIGINT) AS "unique", arg_min(v, (-n, v)) AS top, CAST(max(n) AS BIGINT) AS freq
        FROM (SELECT {c} AS v, count(*) AS n FROM g WHERE {c} IS NOT NULL GROUP BY 1)"""
    for i, c in [(0, "l_returnflag"), (1, "l_linestatus")]])


def _q_desc_cat_positions(df):
    return df


@query("missing_summary")
def q_missing_summary(spark, sf):
    return profile.missing_summary(gappy_lineitem(spark, sf))


SQL["missing_summary"] = w(GL) + "SELECT * FROM (" + union([
    f"""SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS missing,
        floor((count(*) - count({c})) / greatest(count(*), 1) * 100.0 * 100.0 + 0.5) / 100.0 AS missing_pct FROM g"""
    for c in GL_COLS]) + ") WHERE missing > 0"


@query("duplicate_summary")
def q_dup_summary(spark, sf):
    return profile.duplicate_summary(dup_view(spark, sf))


SQL["duplicate_summary"] = w(GL, DUP) + f"""
, grp AS (SELECT count(*) AS c FROM d GROUP BY {", ".join(DUP_COLS)})
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS n_duplicate_rows,
       floor(coalesce(sum(c) FILTER (WHERE c > 1), 0) / greatest(sum(c), 1) * 100.0 * 100.0 + 0.5) / 100.0 AS duplicate_pct,
       CAST(count(*) FILTER (WHERE c > 1) AS BIGINT) AS n_duplicate_groups
FROM grp"""


@query("duplicate_examples")
def q_dup_examples(spark, sf):
    return profile.duplicate_examples(dup_view(spark, sf), 3)


SQL["duplicate_examples"] = w(GL, DUP) + f"""
SELECT *, CAST(count(*) AS BIGINT) AS copies FROM d GROUP BY ALL HAVING count(*) > 1
ORDER BY {", ".join(f"{c} NULLS FIRST" for c in DUP_COLS)} LIMIT 3"""


@query("scale_summary")
def q_scale_summary(spark, sf):
    return round_doubles(profile.scale_summary(gappy_lineitem(spark, sf)))


SQL["scale_summary"] = sql_round(w(GL) + union([
    f"""SELECT {i} AS position, '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min,
        CAST(max({c}) AS DOUBLE) AS max, avg(CAST({c} AS DOUBLE)) AS mean FROM g"""
    for i, c in enumerate(GL_NUM)]), ["min", "max", "mean"])


@query("head_n")
def q_head(spark, sf):
    return profile.head(table(spark, sf, "lineitem"), 5, HEAD_ORDER)


HEAD_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
SQL["head_n"] = "SELECT * FROM lineitem ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in HEAD_ORDER) + " LIMIT 5"


@query("column_moments")
def q_moments(spark, sf):
    return round_doubles(profile.column_moments(gappy_lineitem(spark, sf), "l_extendedprice"))


SQL["column_moments"] = sql_round(w(GL) + """
SELECT 'l_extendedprice' AS "column", CAST(count(l_extendedprice) AS BIGINT) AS n,
       avg(l_extendedprice) AS mean, quantile_cont(l_extendedprice, 0.5) AS median,
       stddev_samp(l_extendedprice) AS std, skewness(l_extendedprice) AS skew,
       kurtosis(l_extendedprice) AS kurtosis
FROM g""", ["mean", "median", "std", "skew", "kurtosis"])


# --- missing values ---------------------------------------------------------

@query("dropna_rows")
def q_dropna_rows(spark, sf):
    return missing.dropna_rows(gappy_lineitem(spark, sf), ["l_quantity", "l_returnflag"])


SQL["dropna_rows"] = w(GL) + "SELECT * FROM g WHERE l_quantity IS NOT NULL AND l_returnflag IS NOT NULL"


@query("dropna_cols")
def q_dropna_cols(spark, sf):
    return missing.dropna_cols(gappy_lineitem(spark, sf))


SQL["dropna_cols"] = w(GL) + "SELECT * EXCLUDE (l_quantity, l_extendedprice, l_returnflag) FROM g"


def _fill_sql(fill_exprs: dict) -> str:
    cols = []
    for c in GL_COLS:
        cols.append(f"coalesce({c}, {fill_exprs[c]}) AS {c}" if c in fill_exprs else c)
    return w(GL) + "SELECT " + ", ".join(cols) + " FROM g"


@query("fill_mean")
def q_fill_mean(spark, sf):
    return round_doubles(missing.fill_mean(gappy_lineitem(spark, sf)), only=GL_DBL)


SQL["fill_mean"] = sql_round(_fill_sql({c: f"(SELECT avg({c}) FROM g)" for c in GL_DBL}), GL_DBL)


@query("fill_median")
def q_fill_median(spark, sf):
    return round_doubles(missing.fill_median(gappy_lineitem(spark, sf)), only=GL_DBL)


SQL["fill_median"] = sql_round(
    _fill_sql({c: f"(SELECT quantile_cont({c}, 0.5) FROM g)" for c in GL_DBL}), GL_DBL)


@query("fill_mode")
def q_fill_mode(spark, sf):
    return missing.fill_mode(gappy_lineitem(spark, sf), ["l_quantity", "l_extendedprice", "l_returnflag"])


SQL["fill_mode"] = _fill_sql({
    c: f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM g WHERE {c} IS NOT NULL GROUP BY 1) "
       f"ORDER BY n DESC, v LIMIT 1)" for c in ["l_quantity", "l_extendedprice", "l_returnflag"]})


@query("fill_constant")
def q_fill_constant(spark, sf):
    return missing.fill_constant(gappy_lineitem(spark, sf),
                                 ["l_quantity", "l_extendedprice", "l_returnflag"], "0")


SQL["fill_constant"] = _fill_sql({"l_quantity": "0.0", "l_extendedprice": "0.0", "l_returnflag": "'0'"})


@query("fill_to_new_column")
def q_fill_new(spark, sf):
    df, _ = missing.fill_to_column(gappy_lineitem(spark, sf), "l_quantity", "median",
                                   new_column="l_quantity_filled")
    return df


SQL["fill_to_new_column"] = w(GL) + """
SELECT *, coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM g)) AS l_quantity_filled FROM g"""


# --- duplicates ---------------------------------------------------------------

@query("dedupe")
def q_dedupe(spark, sf):
    return dedupe.remove_duplicates(dup_view(spark, sf))


SQL["dedupe"] = w(GL, DUP) + "SELECT DISTINCT * FROM d"


@query("duplicate_rows")
def q_dup_rows(spark, sf):
    return dedupe.duplicate_rows(dup_view(spark, sf))


SQL["duplicate_rows"] = w(GL, DUP) + """
SELECT * EXCLUDE (c) FROM (SELECT *, count(*) OVER (PARTITION BY """ + ", ".join(DUP_COLS) + """) AS c FROM d)
WHERE c > 1"""


# --- scaling, encoding, outliers ------------------------------------------------

SCALE_COLS = ["l_quantity", "l_extendedprice"]


def _scale_sql(center: str, scale: str) -> str:
    cols = []
    for c in GL_COLS:
        if c in SCALE_COLS:
            cen = center.format(c=c)
            sc = scale.format(c=c)
            cols.append(f"({c} - (SELECT {cen} FROM g)) / (SELECT CASE WHEN {sc} = 0 OR {sc} IS NULL "
                        f"THEN 1.0 ELSE {sc} END FROM g) AS {c}")
        else:
            cols.append(c)
    return sql_round(w(GL) + "SELECT " + ", ".join(cols) + " FROM g", SCALE_COLS)


@query("scale_standard")
def q_scale_std(spark, sf):
    return round_doubles(scale.scale_columns(gappy_lineitem(spark, sf), SCALE_COLS, "standard"),
                         only=SCALE_COLS)


SQL["scale_standard"] = _scale_sql("avg({c})", "stddev_pop({c})")


@query("scale_minmax")
def q_scale_mm(spark, sf):
    return round_doubles(scale.scale_columns(gappy_lineitem(spark, sf), SCALE_COLS, "minmax"),
                         only=SCALE_COLS)


SQL["scale_minmax"] = _scale_sql("min({c})", "(max({c}) - min({c}))")


@query("scale_robust")
def q_scale_rb(spark, sf):
    return round_doubles(scale.scale_columns(gappy_lineitem(spark, sf), SCALE_COLS, "robust"),
                         only=SCALE_COLS)


SQL["scale_robust"] = _scale_sql("quantile_cont({c}, 0.5)",
                                 "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))")


@query("encode_label")
def q_label(spark, sf):
    return encode.encode_label(table(spark, sf, "part"), ["p_brand", "p_type"])


SQL["encode_label"] = """
WITH b AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS BIGINT) AS code
           FROM (SELECT DISTINCT coalesce(p_brand, 'nan') AS v FROM part)),
t AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS BIGINT) AS code
      FROM (SELECT DISTINCT coalesce(p_type, 'nan') AS v FROM part))
SELECT p.p_partkey, p.p_name, b.code AS p_brand, t.code AS p_type, p.p_size, p.p_retailprice
FROM part p JOIN b ON b.v = coalesce(p.p_brand, 'nan') JOIN t ON t.v = coalesce(p.p_type, 'nan')"""

# The TPC-H order priority and status domains of the test tables.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


@query("encode_onehot")
def q_onehot(spark, sf):
    return encode.encode_onehot(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


SQL["encode_onehot"] = "SELECT o_orderkey, o_custkey, " + ", ".join(
    [f"CAST(coalesce(o_orderstatus = '{v}', FALSE) AS INTEGER) AS \"o_orderstatus_{v}\"" for v in STATUSES]
    + ["o_totalprice", "o_orderdate"]
    + [f"CAST(coalesce(o_orderpriority = '{v}', FALSE) AS INTEGER) AS \"o_orderpriority_{v}\""
       for v in PRIORITIES]) + " FROM orders"

_Q13 = ("(SELECT quantile_cont(l_extendedprice, 0.25) FROM g)",
        "(SELECT quantile_cont(l_extendedprice, 0.75) FROM g)")
_LO = f"({_Q13[0]} - 1.5 * ({_Q13[1]} - {_Q13[0]}))"
_HI = f"({_Q13[1]} + 1.5 * ({_Q13[1]} - {_Q13[0]}))"


@query("outlier_detect")
def q_out_detect(spark, sf):
    return round_doubles(outliers.detect_outliers_lazy(gappy_lineitem(spark, sf), "l_extendedprice"))


SQL["outlier_detect"] = sql_round(w(GL) + f"""
SELECT 'l_extendedprice' AS "column", {_Q13[0]} AS q1, {_Q13[1]} AS q3, {_Q13[1]} - {_Q13[0]} AS iqr,
       {_LO} AS lower_bound, {_HI} AS upper_bound,
       CAST(count(*) FILTER (WHERE l_extendedprice < {_LO} OR l_extendedprice > {_HI}) AS BIGINT) AS n_outliers
FROM g""", ["q1", "q3", "iqr", "lower_bound", "upper_bound"])


@query("outlier_remove")
def q_out_remove(spark, sf):
    return outliers.handle_outliers(gappy_lineitem(spark, sf), "l_extendedprice", "remove")


SQL["outlier_remove"] = w(GL) + f"SELECT * FROM g WHERE l_extendedprice >= {_LO} AND l_extendedprice <= {_HI}"


@query("outlier_cap")
def q_out_cap(spark, sf):
    return round_doubles(outliers.handle_outliers(gappy_lineitem(spark, sf), "l_extendedprice", "cap"),
                         only=["l_extendedprice"])


SQL["outlier_cap"] = sql_round(w(GL) + f"""
SELECT * REPLACE (CASE WHEN l_extendedprice IS NULL THEN NULL
                       ELSE least(greatest(l_extendedprice, {_LO}), {_HI}) END AS l_extendedprice) FROM g""",
                               ["l_extendedprice"])


# --- text and types -------------------------------------------------------------

# Java's Unicode White_Space set, spelled for RE2 (the oracle's regex engine).
UNICODE_WS = r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}]+"


@query("standardise_text")
def q_std_text(spark, sf):
    return text.standardise_text(table(spark, sf, "part"), ["p_name", "p_type", "p_brand"], case="lower")


SQL["standardise_text"] = "SELECT p_partkey, " + ", ".join(
    f"lower(trim(regexp_replace({c}, '{UNICODE_WS}', ' ', 'g'))) AS {c}" for c in ["p_name", "p_brand", "p_type"]
) + ", p_size, p_retailprice FROM part"


@query("standardise_text_docs")
def q_std_docs(spark, sf):
    """Whole documents: whitespace clean-up only, every string column."""
    return text.standardise_text(table(spark, sf, "documents"), None, case="none")


SQL["standardise_text_docs"] = "SELECT doc_id, " + ", ".join(
    f"trim(regexp_replace({c}, '{UNICODE_WS}', ' ', 'g')) AS {c}" for c in ["text", "lang", "source"]
) + ", n_chars FROM documents"


def numeric_text_view(spark, sf):
    li = table(spark, sf, "lineitem")
    q = F.col("l_quantity").cast("string")
    k = F.col("l_linenumber") % 4
    return li.select("l_orderkey", "l_linenumber",
                     F.when(k == 0, q).when(k == 1, F.concat(F.lit(" "), q, F.lit(" ")))
                     .when(k == 2, F.concat(q, F.lit("d"))).otherwise(F.concat(q, F.lit("e1")))
                     .alias("qty_text"),
                     "l_discount", "l_tax")


NUMERIC_TEXT_SQL = """
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber % 4 WHEN 0 THEN CAST(l_quantity AS VARCHAR)
            WHEN 1 THEN ' ' || CAST(l_quantity AS VARCHAR) || ' '
            WHEN 2 THEN CAST(l_quantity AS VARCHAR) || 'd'
            ELSE CAST(l_quantity AS VARCHAR) || 'e1' END AS qty_text,
       l_discount, l_tax
FROM lineitem"""


@query("coerce_numeric")
def q_coerce_num(spark, sf):
    return text.coerce_types(numeric_text_view(spark, sf), ["qty_text"], "numeric")


SQL["coerce_numeric"] = f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN regexp_matches(lower(qty_text), '^\\s*[+-]?((\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?|inf(inity)?|nan)\\s*$')
            THEN TRY_CAST(trim(qty_text) AS DOUBLE) END AS qty_text,
       l_discount, l_tax
FROM ({NUMERIC_TEXT_SQL})"""


@query("coerce_string")
def q_coerce_str(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                              "l_returnflag")
    return text.coerce_types(li, None, "string")


SQL["coerce_string"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
       CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_discount AS VARCHAR) AS l_discount,
       l_returnflag FROM lineitem"""
