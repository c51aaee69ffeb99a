"""Registered experiment queries (S4, X1-X26) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions import dist
from tablesmith.operators.eda.groups import group_box_stats
from tablesmith.operators.experiment import resample, sessions as sess_ops, stats
from tablesmith.operators.experiment.sessions import METRIC_FAMILY
from tablesmith.plans.common import round_doubles, sql_round
from tablesmith.plans.tables import event_log, sessions, table
from tablesmith.sources.events import EVENT_LOG_SQL

Q = {}
SQL = {}


def query(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


# --- SQL building blocks ----------------------------------------------------

EV = f"ev AS ({EVENT_LOG_SQL})"

SESS = """sess AS (
  SELECT session_id, ab_group, n_preview, n_apply, n_apply_success, session_duration_s,
         distinct_clean_actions,
         CASE WHEN n_preview + n_apply > 0 THEN n_apply / (n_preview + n_apply)
              ELSE CAST(0 AS DOUBLE) END AS apply_rate,
         CASE WHEN n_preview > 0 AND n_apply > 0 THEN CAST(1 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS preview_to_apply_conversion,
         CASE WHEN n_apply > 0 THEN n_apply_success / n_apply
              ELSE CAST(0 AS DOUBLE) END AS apply_success_rate,
         CAST(n_apply_success AS DOUBLE) AS successful_actions_per_session
  FROM (
    SELECT session_id, ab_group,
           CAST(SUM(CASE WHEN event_type = 'preview_clean' THEN 1 ELSE 0 END) AS BIGINT) AS n_preview,
           CAST(SUM(CASE WHEN event_type = 'apply_clean' THEN 1 ELSE 0 END) AS BIGINT) AS n_apply,
           CAST(SUM(CASE WHEN event_type = 'apply_clean' AND success_bool THEN 1 ELSE 0 END)
                AS BIGINT) AS n_apply_success,
           max(seconds_since_session_start) AS session_duration_s,
           CAST(count(DISTINCT NULLIF(clean_action, '')) AS BIGINT) AS distinct_clean_actions
    FROM ev GROUP BY session_id, ab_group))"""


def long_sql(metrics=METRIC_FAMILY, src="sess"):
    parts = [f"SELECT {i} AS metric_order, '{m}' AS metric, session_id, ab_group, "
             f"CAST({m} AS DOUBLE) AS v FROM {src}" for i, m in enumerate(metrics)]
    return "lng AS (" + "\nUNION ALL\n".join(parts) + ")"


MOM = """mom AS (
  SELECT metric_order, metric,
         CAST(count(v) FILTER (WHERE ab_group = 'A') AS BIGINT) AS n_a,
         CAST(count(v) FILTER (WHERE ab_group = 'B') AS BIGINT) AS n_b,
         sum(v) FILTER (WHERE ab_group = 'A') AS sum_a, sum(v) FILTER (WHERE ab_group = 'B') AS sum_b,
         avg(v) FILTER (WHERE ab_group = 'A') AS mean_a, avg(v) FILTER (WHERE ab_group = 'B') AS mean_b,
         var_samp(v) FILTER (WHERE ab_group = 'A') AS var_a,
         var_samp(v) FILTER (WHERE ab_group = 'B') AS var_b
  FROM lng GROUP BY metric_order, metric)"""

def cohen_sql(p: str = "") -> str:
    na, nb, va, vb, ma, mb = (f"{p}{c}" for c in ("n_a", "n_b", "var_a", "var_b", "mean_a", "mean_b"))
    pooled = f"sqrt((({na} - 1) * {va} + ({nb} - 1) * {vb}) / greatest({na} + {nb} - 2, 1))"
    return (f"CASE WHEN {na} < 2 OR {nb} < 2 THEN NULL WHEN {pooled} = 0 THEN 0.0 "
            f"ELSE ({mb} - {ma}) / {pooled} END")


COHEN_SQL = cohen_sql()


def with_(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


def t_p_sql(t: str, df: str, steps: int = 20000) -> str:
    """Two-sided p of Student's t by Simpson's rule over the angle atan(t / sqrt(df)) to a right angle."""
    a = f"atan(abs({t}) / sqrt({df}))"
    h = f"((pi() / 2 - {a}) / {steps})"
    weight = f"CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    total = f"list_sum([({weight}) * pow(greatest(cos({a} + i * {h}), 0), {df} - 1) for i in range({steps + 1})])"
    return f"(2 * exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt(pi()) * {h} / 3 * {total})"


def norm_p_sql(z: str, steps: int = 20000, reach: int = 14) -> str:
    """Two-sided p of a normal z by Simpson's rule over its tail."""
    h = reach / steps
    weight = f"CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"(2 / sqrt(2 * pi()) * {h} / 3 * list_sum([({weight}) * exp(-(abs({z}) + i * {h}) * (abs({z}) + i * {h}) / 2) for i in range({steps + 1})]))"


def bh_sql(rows: str, family: str, p: str = "p_value", out: str = "p_fdr") -> str:
    """``rows`` with the step-up adjustment of p within each family."""
    by = f"PARTITION BY {family} " if family else ""
    return f"""SELECT * EXCLUDE (_m, _r, _raw), CASE WHEN {p} IS NOT NULL THEN least(1.0, min(_raw) OVER ({by}ORDER BY _r DESC)) END AS {out}
FROM (SELECT *, {p} * _m / _r AS _raw FROM (SELECT *, count({p}) OVER ({by}) AS _m, row_number() OVER ({by}ORDER BY {p} NULLS LAST) AS _r FROM ({rows})))"""


# --- queries ----------------------------------------------------------------

@query("events_normalised")
def q_events(spark, sf):
    return event_log(spark, sf)


SQL["events_normalised"] = EVENT_LOG_SQL


@query("session_metrics")
def q_sessions(spark, sf):
    return sessions(spark, sf)


SQL["session_metrics"] = with_(EV, SESS) + "SELECT * FROM sess"


@query("arm_descriptives")
def q_arm_desc(spark, sf):
    return round_doubles(stats.arm_descriptives(sessions(spark, sf)))


SQL["arm_descriptives"] = sql_round(with_(EV, SESS, long_sql(), MOM) + """
SELECT metric_order, metric, n_a, n_b, mean_a, mean_b, sqrt(var_a) AS sd_a, sqrt(var_b) AS sd_b,
       mean_b - mean_a AS diff,
       CASE WHEN mean_a <> 0 THEN (mean_b - mean_a) / mean_a * 100.0 END AS lift_pct
FROM mom""", ["mean_a", "mean_b", "sd_a", "sd_b", "diff", "lift_pct"])


@query("welch_t")
def q_welch(spark, sf):
    return round_doubles(stats.welch_t(sessions(spark, sf), with_p=False))


WELCH_SQL = """
SELECT metric_order, metric, n_a, n_b, mean_a, mean_b,
       CASE WHEN n_a >= 2 AND n_b >= 2 AND (var_a / n_a + var_b / n_b) > 0
            THEN (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) END AS t,
       CASE WHEN n_a >= 2 AND n_b >= 2
            AND ((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1)) > 0
            THEN (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
                 / ((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1))
       END AS df
FROM mom"""
SQL["welch_t"] = sql_round(with_(EV, SESS, long_sql(), MOM) + WELCH_SQL,
                           ["mean_a", "mean_b", "t", "df"])


@query("two_prop_z")
def q_z(spark, sf):
    return round_doubles(stats.two_prop_z(sessions(spark, sf), with_p=False))


SQL["two_prop_z"] = sql_round(with_(EV, SESS, long_sql(["preview_to_apply_conversion"]), MOM) + """
SELECT metric, n_a, n_b, CAST(sum_a AS BIGINT) AS successes_a, CAST(sum_b AS BIGINT) AS successes_b,
       CASE WHEN n_a > 0 AND n_b > 0 THEN
         CASE WHEN sqrt(p * (1 - p) * (1.0 / n_a + 1.0 / n_b)) = 0 THEN 0.0
              ELSE (sum_b / n_b - sum_a / n_a) / sqrt(p * (1 - p) * (1.0 / n_a + 1.0 / n_b)) END
       END AS z,
       CASE WHEN n_a > 0 AND n_b > 0 THEN sum_b / n_b - sum_a / n_a END AS effect
FROM (SELECT *, (sum_a + sum_b) / (n_a + n_b) AS p FROM mom)""", ["z", "effect"])


@query("cohens_d")
def q_d(spark, sf):
    return round_doubles(stats.cohens_d(sessions(spark, sf)))


SQL["cohens_d"] = sql_round(with_(EV, SESS, long_sql(), MOM) + f"""
SELECT metric_order, metric, n_a, n_b, {COHEN_SQL} AS cohens_d FROM mom""", ["cohens_d"])


MW_SQL = """
cnt AS (SELECT metric, v,
               CAST(count(*) FILTER (WHERE ab_group = 'A') AS BIGINT) AS c_a,
               CAST(count(*) FILTER (WHERE ab_group = 'B') AS BIGINT) AS c_b,
               CAST(count(*) AS BIGINT) AS c
        FROM lng WHERE v IS NOT NULL GROUP BY metric, v),
rk AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY metric ORDER BY v
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c_below FROM cnt)"""


@query("mann_whitney_u")
def q_mw(spark, sf):
    return round_doubles(stats.mann_whitney_u(sessions(spark, sf), with_p=False))


SQL["mann_whitney_u"] = sql_round(with_(EV, SESS, long_sql(), MW_SQL) + """
SELECT metric, CAST(sum(c_a) AS BIGINT) AS n_a, CAST(sum(c_b) AS BIGINT) AS n_b,
       sum(c_a * (c_below + (c + 1) / 2.0)) - sum(c_a) * (sum(c_a) + 1) / 2.0 AS u_a,
       CAST(sum(c * c * c - c) AS DOUBLE) AS tie_term
FROM rk GROUP BY metric""", ["u_a", "tie_term"])


REPORT_COLS = ["metric_order", "metric", "group_a_mean", "group_b_mean", "group_a_n",
               "group_b_n", "statistic", "effect", "effect_label", "test_name"]


def _report_sql(src_filter: str = "") -> str:
    sess_src = "sess" + (f" WHERE {src_filter}" if src_filter else "")
    return sql_round(with_(EV, SESS, f"sf AS (SELECT * FROM {sess_src})",
                           long_sql(src="sf"), MOM, MW_SQL) + f"""
, mw AS (SELECT metric, sum(c_a * (c_below + (c + 1) / 2.0)) - sum(c_a) * (sum(c_a) + 1) / 2.0 AS u_a
         FROM rk GROUP BY metric),
w AS ({WELCH_SQL})
SELECT m.metric_order, m.metric, m.mean_a AS group_a_mean, m.mean_b AS group_b_mean,
       m.n_a AS group_a_n, m.n_b AS group_b_n,
       CASE WHEN m.metric = 'preview_to_apply_conversion' THEN
              CASE WHEN sqrt(p * (1 - p) * (1.0 / m.n_a + 1.0 / m.n_b)) = 0 THEN 0.0
                   ELSE (m.sum_b / m.n_b - m.sum_a / m.n_a) / sqrt(p * (1 - p) * (1.0 / m.n_a + 1.0 / m.n_b)) END
            WHEN m.metric = 'successful_actions_per_session' THEN mw.u_a
            ELSE w.t END AS statistic,
       CASE WHEN m.metric = 'preview_to_apply_conversion' THEN m.mean_b - m.mean_a
            ELSE {cohen_sql('m.')} END AS effect,
       CASE WHEN m.metric = 'preview_to_apply_conversion' THEN 'proportion diff (B - A)'
            ELSE 'Cohen''s d' END AS effect_label,
       CASE WHEN m.metric = 'preview_to_apply_conversion' THEN 'two-proportion z-test'
            WHEN m.metric = 'successful_actions_per_session' THEN 'Mann-Whitney U'
            ELSE 'Welch''s t-test' END AS test_name
FROM (SELECT *, (sum_a + sum_b) / (n_a + n_b) AS p FROM mom) m
JOIN mw ON mw.metric = m.metric JOIN w ON w.metric = m.metric""",
                     ["group_a_mean", "group_b_mean", "statistic", "effect"])


@query("metric_report")
def q_report(spark, sf):
    r = stats.metric_report(sessions(spark, sf), with_ci=False)
    return round_doubles(r.select(*REPORT_COLS))


SQL["metric_report"] = _report_sql()

ERROR_ONLY = "NOT (n_apply > 0 AND n_apply_success = 0 AND n_preview = 0)"


@query("sensitivity_report")
def q_sens(spark, sf):
    r = stats.sensitivity_report(sessions(spark, sf), with_ci=False)
    return round_doubles(r.select(*REPORT_COLS))


SQL["sensitivity_report"] = _report_sql(ERROR_ONLY)


@query("metric_report_full")
def q_report_full(spark, sf):
    """Full 13-field rows with p-values, Bonferroni, FDR and bootstrap CIs."""
    return round_doubles(stats.metric_report(sessions(spark, sf)), 6)


def _full_sql() -> str:
    """The whole report: test statistics, their p-values, both corrections and the bootstrap's interval."""
    z_of_u = "(greatest(u_a, n_a * n_b - u_a) - n_a * n_b / 2.0 - 0.5) / nullif(sqrt(n_a * n_b / 12.0 * ((n_a + n_b + 1) - tie_term / ((n_a + n_b) * (n_a + n_b - 1.0)))), 0)"
    rows = with_(EV, SESS, "sf AS (SELECT * FROM sess)", long_sql(src="sf"), MOM, MW_SQL) + f"""
, mw AS (SELECT metric, sum(c_a * (c_below + (c + 1) / 2.0)) - sum(c_a) * (sum(c_a) + 1) / 2.0 AS u_a,
                sum(c * 1.0 * c * c - c) AS tie_term FROM rk GROUP BY metric),
w AS ({WELCH_SQL}),
e AS (SELECT *, {COHEN_SQL} AS d FROM mom),
j AS (SELECT m.*, mw.u_a, mw.tie_term, w.t, w.df, (m.sum_a + m.sum_b) / (m.n_a + m.n_b) AS p
      FROM e m JOIN mw ON mw.metric = m.metric JOIN w ON w.metric = m.metric),
k AS (SELECT *, sqrt(p * (1 - p) * (1.0 / n_a + 1.0 / n_b)) AS se, {z_of_u} AS zu FROM j)
SELECT metric_order, metric, mean_a AS group_a_mean, mean_b AS group_b_mean, n_a AS group_a_n, n_b AS group_b_n,
       CASE metric WHEN 'preview_to_apply_conversion' THEN CASE WHEN se = 0 THEN 0.0 ELSE (mean_b - mean_a) / se END
                   WHEN 'successful_actions_per_session' THEN u_a ELSE t END AS statistic,
       CASE metric WHEN 'preview_to_apply_conversion' THEN {norm_p_sql("CASE WHEN se = 0 THEN 0.0 ELSE (mean_b - mean_a) / se END")}
                   WHEN 'successful_actions_per_session' THEN least(1.0, {norm_p_sql("zu")}) ELSE {t_p_sql("t", "df")} END AS p_value,
       CASE WHEN metric = 'preview_to_apply_conversion' THEN mean_b - mean_a ELSE d END AS effect,
       CASE WHEN metric = 'preview_to_apply_conversion' THEN 'proportion diff (B - A)' ELSE 'Cohen''s d' END AS effect_label,
       CASE metric WHEN 'preview_to_apply_conversion' THEN 'two-proportion z-test'
                   WHEN 'successful_actions_per_session' THEN 'Mann-Whitney U' ELSE 'Welch''s t-test' END AS test_name
FROM k"""
    return f"""SELECT r.*, least(1.0, p_value * {len(METRIC_FAMILY)}) AS p_value_bonferroni, ci_low, ci_high, (ci_low > 0 OR ci_high < 0) AS ci_excludes_zero
FROM ({bh_sql(rows, "", out="p_value_fdr")}) r LEFT JOIN ({_bootstrap_sql(METRIC_FAMILY, "mean_diff")}) ci USING (metric)"""


@query("bh_fdr")
def q_bh(spark, sf):
    """BH within each metric family over the subgroup-level Welch p-values."""
    ev = event_log(spark, sf)
    s = sessions(spark, sf)
    parts = None
    for m in METRIC_FAMILY:
        sub = resample.subgroup_effects(ev, s, metric=m, min_sessions_per_cell=2).select(
            F.lit(m).alias("metric"), "subgroup", "p_value")
        parts = sub if parts is None else parts.unionByName(sub)
    return round_doubles(stats.bh_adjust(parts, "p_value", family=["metric"]), 6)


@query("bh_fdr_many")
def q_bh_many(spark, sf):
    """One test a part: do its ordered quantities look normal? p = exp(-JB / 2), adjusted within the sizes of parts."""
    x = F.col("l_quantity")
    sums = [F.sum(x).alias("s1"), F.sum(x * x).alias("s2"), F.sum(x * x * x).alias("s3"), F.sum(x * x * x * x).alias("s4")]
    d = (table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), *sums)
         .join(table(spark, sf, "part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"), "left"))
    n, m = F.col("n"), F.col("s1") / F.col("n")
    m2 = F.col("s2") / n - m * m
    m3 = F.col("s3") / n - 3 * m * F.col("s2") / n + 2 * m * m * m
    m4 = F.col("s4") / n - 4 * m * F.col("s3") / n + 6 * m * m * F.col("s2") / n - 3 * m * m * m * m
    jb = n / 6.0 * (m3 * m3 / (m2 * m2 * m2) + (m4 / (m2 * m2) - 3) * (m4 / (m2 * m2) - 3) / 4)
    tests = d.select("l_partkey", "p_size", F.when((n > 3) & (m2 > 1e-9), F.exp(-jb / 2)).alias("p_value"))
    return round_doubles(stats.bh_adjust(tests, "p_value", family=["p_size"]), 6)


_JB_PARTS = """SELECT l_partkey, p_size, CASE WHEN n > 3 AND m2 > 1e-9 THEN
    exp(-(n / 6.0 * (m3 * m3 / (m2 * m2 * m2) + (m4 / (m2 * m2) - 3) * (m4 / (m2 * m2) - 3) / 4)) / 2) END AS p_value FROM (
  SELECT l_partkey, p_size, n, s2 / n - m * m AS m2, s3 / n - 3 * m * s2 / n + 2 * m * m * m AS m3,
         s4 / n - 4 * m * s3 / n + 6 * m * m * s2 / n - 3 * m * m * m * m AS m4 FROM (
    SELECT l_partkey, p_size, n, s1 / n AS m, s2, s3, s4 FROM (
      SELECT l_partkey, count(*) AS n, sum(l_quantity) AS s1, sum(l_quantity * l_quantity) AS s2,
             sum(l_quantity * l_quantity * l_quantity) AS s3, sum(l_quantity * l_quantity * l_quantity * l_quantity) AS s4
      FROM lineitem GROUP BY l_partkey) LEFT JOIN part ON p_partkey = l_partkey))"""
SQL["bh_fdr_many"] = sql_round(bh_sql(_JB_PARTS, "p_size"), ["p_value", "p_fdr"], 6)


@query("tost")
def q_tost(spark, sf):
    s = sessions(spark, sf)
    a = stats.tost(s, "apply_success_rate", 0.1, with_p=False)
    b = stats.tost(s, "successful_actions_per_session", 0.3, with_p=False)
    return round_doubles(a.unionByName(b))


def _tost_sql(metric, bound):
    return with_(EV, SESS, long_sql([metric]), MOM) + f"""
SELECT metric, n_a, n_b, mean_b - mean_a AS mean_diff, CAST({bound} AS DOUBLE) AS bound,
       (mean_b - mean_a + {bound}) / nullif(sqrt(var_a / n_a + var_b / n_b), 0) AS t_lower,
       (mean_b - mean_a - {bound}) / nullif(sqrt(var_a / n_a + var_b / n_b), 0) AS t_upper,
       CAST(n_a + n_b - 2 AS DOUBLE) AS df
FROM mom"""


SQL["tost"] = sql_round("SELECT * FROM (" + _tost_sql("apply_success_rate", 0.1)
                        + ")\nUNION ALL\nSELECT * FROM ("
                        + _tost_sql("successful_actions_per_session", 0.3) + ")",
                        ["mean_diff", "bound", "t_lower", "t_upper", "df"])


@query("srm_chi2")
def q_srm(spark, sf):
    return round_doubles(stats.srm_chi2(sessions(spark, sf), with_p=False))


SQL["srm_chi2"] = sql_round(with_(EV, SESS) + """
, first AS (SELECT session_id, min(ab_group) AS ab_group FROM sess GROUP BY session_id),
c AS (SELECT CAST(count(*) FILTER (WHERE ab_group = 'A') AS BIGINT) AS n_a,
             CAST(count(*) FILTER (WHERE ab_group = 'B') AS BIGINT) AS n_b FROM first)
SELECT n_a, n_b,
       CASE WHEN n_a + n_b > 0 THEN (n_a - (n_a + n_b) * 0.5) * (n_a - (n_a + n_b) * 0.5) / ((n_a + n_b) * 0.5)
            + (n_b - (n_a + n_b) * 0.5) * (n_b - (n_a + n_b) * 0.5) / ((n_a + n_b) * 0.5) END AS chi2,
       CASE WHEN n_a + n_b > 0 THEN n_a / (n_a + n_b) END AS ratio_observed
FROM c""", ["chi2", "ratio_observed"])


@query("arm_balance")
def q_balance(spark, sf):
    return stats.arm_balance(event_log(spark, sf), with_p=False)


SQL["arm_balance"] = with_(EV) + """
, first AS (SELECT session_id, arg_min(ab_group, ("timestamp", ab_group)) AS ab_group
            FROM ev GROUP BY session_id)
SELECT CAST(count(*) FILTER (WHERE ab_group = 'A') AS BIGINT) AS n_a,
       CAST(count(*) FILTER (WHERE ab_group = 'B') AS BIGINT) AS n_b FROM first"""


@query("levene_median")
def q_levene(spark, sf):
    return round_doubles(stats.levene_median(sessions(spark, sf), with_p=False))


SQL["levene_median"] = sql_round(with_(EV, SESS) + """
, med AS (SELECT ab_group, quantile_cont(apply_rate, 0.5) AS med FROM sess GROUP BY ab_group),
z AS (SELECT s.ab_group, abs(s.apply_rate - m.med) AS z FROM sess s JOIN med m USING (ab_group)),
per AS (SELECT ab_group, count(*) AS n, sum(z) AS sz, sum(z * z) AS szz FROM z GROUP BY ab_group),
tot AS (SELECT sum(n) AS "N", count(*) AS k, sum(sz) AS sz, sum(sz * sz / n) AS between_raw,
               sum(szz - sz * sz / n) AS within FROM per)
SELECT 'apply_rate' AS metric, CAST("N" AS BIGINT) AS n,
       ("N" - k) * (between_raw - "N" * (sz / "N") * (sz / "N")) / nullif((k - 1) * within, 0) AS w_stat,
       CAST(k - 1 AS DOUBLE) AS df1, CAST("N" - k AS DOUBLE) AS df2
FROM tot""", ["w_stat", "df1", "df2"])


@query("normality_jb")
def q_jb(spark, sf):
    return round_doubles(stats.normality_jb(sessions(spark, sf)))


SQL["normality_jb"] = sql_round(with_(EV, SESS) + """
, mu AS (SELECT ab_group, avg(apply_rate) AS m FROM sess GROUP BY ab_group),
c AS (SELECT s.ab_group, s.apply_rate - mu.m AS d FROM sess s JOIN mu USING (ab_group)),
mo AS (SELECT ab_group, CAST(count(*) AS BIGINT) AS n, avg(d * d) AS m2, avg(d * d * d) AS m3,
              avg(d * d * d * d) AS m4 FROM c GROUP BY ab_group),
sk AS (SELECT ab_group, n, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) - 3.0 AS excess_kurtosis FROM mo)
SELECT 'apply_rate' AS metric, ab_group, n, skew, excess_kurtosis,
       n / 6.0 * (skew * skew + excess_kurtosis * excess_kurtosis / 4.0) AS jb,
       exp(-(n / 6.0 * (skew * skew + excess_kurtosis * excess_kurtosis / 4.0)) / 2.0) AS p_value
FROM sk""", ["skew", "excess_kurtosis", "jb", "p_value"])


@query("subgroup_effects")
def q_subgroup(spark, sf):
    r = resample.subgroup_effects(event_log(spark, sf), sessions(spark, sf), with_p=False)
    return round_doubles(r)


def _subgroup_sql(metric: str, least: int) -> str:
    return (with_(EV, SESS) + """
, ac AS (SELECT session_id, clean_action, count(*) AS c FROM ev WHERE clean_action IS NOT NULL
         GROUP BY session_id, clean_action),
modal AS (SELECT session_id, clean_action AS subgroup FROM (
            SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY c DESC, clean_action) AS rn
            FROM ac) WHERE rn = 1),
g AS (SELECT subgroup, ab_group, count(*) AS n, avg(apply_rate) AS mean, var_samp(apply_rate) AS var
      FROM sess JOIN modal USING (session_id) GROUP BY subgroup, ab_group),
p AS (SELECT subgroup,
             coalesce(max(n) FILTER (WHERE ab_group = 'A'), 0) AS n_a,
             coalesce(max(n) FILTER (WHERE ab_group = 'B'), 0) AS n_b,
             max(mean) FILTER (WHERE ab_group = 'A') AS mean_a, max(mean) FILTER (WHERE ab_group = 'B') AS mean_b,
             max(var) FILTER (WHERE ab_group = 'A') AS var_a, max(var) FILTER (WHERE ab_group = 'B') AS var_b
      FROM g GROUP BY subgroup)
SELECT subgroup, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, mean_a, mean_b,
       CASE WHEN n_a >= 30 AND n_b >= 30 THEN """ + COHEN_SQL.replace("n_a < 2 OR n_b < 2", "FALSE") + """ END AS cohens_d,
       CASE WHEN n_a >= 30 AND n_b >= 30 THEN (mean_a - mean_b) / nullif(sqrt(var_a / n_a + var_b / n_b), 0) END AS t,
       CASE WHEN n_a >= 30 AND n_b >= 30 THEN (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
            / nullif((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1), 0) END AS df,
       CASE WHEN n_a >= 30 AND n_b >= 30 THEN '' ELSE 'insufficient N' END AS note
FROM p""").replace("apply_rate) AS", f"{metric}) AS").replace(">= 30", f">= {least}")


SQL["subgroup_effects"] = sql_round(_subgroup_sql("apply_rate", 30), ["mean_a", "mean_b", "cohens_d", "t", "df"])
_SUBGROUP_P = "\nUNION ALL\n".join(
    f"SELECT '{m}' AS metric, subgroup, {t_p_sql('t', 'df')} AS p_value FROM ({_subgroup_sql(m, 2)})" for m in METRIC_FAMILY)
SQL["bh_fdr"] = sql_round(bh_sql(_SUBGROUP_P, "metric"), ["p_value", "p_fdr"], 6)


@query("power_table")
def q_power(spark, sf):
    return round_doubles(stats.power_table(sessions(spark, sf)).drop("power"))


_ZA = dist.norm_ppf(0.975) + dist.norm_ppf(0.8)
SQL["power_table"] = sql_round(with_(EV, SESS, long_sql(), MOM) + f"""
SELECT metric_order, metric, n_a, n_b, d,
       CASE WHEN d IS NULL OR abs(d) < 1e-6 THEN CAST(1000000000 AS BIGINT)
            ELSE CAST(ceil({2.0 * _ZA * _ZA!r} / (d * d)) AS BIGINT) END AS required_n_per_arm,
       CASE WHEN least(n_a, n_b) >= 2 THEN {_ZA!r} * sqrt(2.0 / least(n_a, n_b)) END AS mde
FROM (SELECT *, {COHEN_SQL} AS d FROM mom)""", ["d", "mde"])


@query("funnel_by_arm")
def q_funnel(spark, sf):
    return round_doubles(sess_ops.funnel_by_arm(sessions(spark, sf)))


SQL["funnel_by_arm"] = sql_round(with_(EV, SESS) + """
, w AS (SELECT ab_group, count(*) AS sessions, count(*) FILTER (WHERE n_preview > 0) AS with_preview,
               count(*) FILTER (WHERE n_apply > 0) AS with_apply,
               count(*) FILTER (WHERE n_apply_success > 0) AS with_success FROM sess GROUP BY ab_group)
SELECT ab_group, stage_order, stage, CAST(n AS BIGINT) AS n_sessions, n / sessions AS share FROM (
  SELECT ab_group, sessions, 0 AS stage_order, 'sessions' AS stage, sessions AS n FROM w UNION ALL
  SELECT ab_group, sessions, 1, 'with_preview', with_preview FROM w UNION ALL
  SELECT ab_group, sessions, 2, 'with_apply', with_apply FROM w UNION ALL
  SELECT ab_group, sessions, 3, 'with_success', with_success FROM w)""", ["share"])


@query("rate_hist_by_arm")
def q_rate_hist(spark, sf):
    return round_doubles(sess_ops.rate_hist_by_arm(sessions(spark, sf)))


SQL["rate_hist_by_arm"] = sql_round(with_(EV, SESS) + """
, c AS (SELECT ab_group, CAST(least(19, floor(apply_rate * 20.0)) AS BIGINT) AS bin, count(*) AS n
        FROM sess WHERE apply_rate IS NOT NULL GROUP BY ALL),
grid AS (SELECT a.ab_group, CAST(b.bin AS BIGINT) AS bin FROM (SELECT DISTINCT ab_group FROM sess) a
         CROSS JOIN range(20) b(bin))
SELECT g.ab_group, g.bin, g.bin / 20.0 AS bin_lo, (g.bin + 1) / 20.0 AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN c USING (ab_group, bin)""", ["bin_lo", "bin_hi"])


@query("events_per_session_hist")
def q_eps(spark, sf):
    return sess_ops.events_per_session_hist(sessions(spark, sf))


SQL["events_per_session_hist"] = with_(EV, SESS) + """
SELECT ab_group, n_preview + n_apply AS n_events, CAST(count(*) AS BIGINT) AS n_sessions
FROM sess GROUP BY ALL"""


@query("success_box_by_arm")
def q_success_box(spark, sf):
    return round_doubles(group_box_stats(sessions(spark, sf), "successful_actions_per_session",
                                         "ab_group"))


SQL["success_box_by_arm"] = sql_round(with_(EV, SESS) + """
SELECT ab_group AS "group", CAST(count(successful_actions_per_session) AS BIGINT) AS count,
       avg(successful_actions_per_session) AS mean, stddev_samp(successful_actions_per_session) AS std,
       min(successful_actions_per_session) AS min,
       quantile_cont(successful_actions_per_session, 0.25) AS q1,
       quantile_cont(successful_actions_per_session, 0.5) AS median,
       quantile_cont(successful_actions_per_session, 0.75) AS q3,
       max(successful_actions_per_session) AS max
FROM sess WHERE successful_actions_per_session IS NOT NULL GROUP BY ab_group""",
                                      ["mean", "std", "min", "q1", "median", "q3", "max"])


@query("event_quality")
def q_quality(spark, sf):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    end = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    return sess_ops.event_quality(event_log(spark, sf), start, end)


SQL["event_quality"] = with_(EV) + """
SELECT CAST(count(*) AS BIGINT) AS n_events,
       CAST(count(*) FILTER (WHERE "timestamp" IS NULL) AS BIGINT) AS bad_timestamp,
       CAST(count(*) FILTER (WHERE NOT coalesce("timestamp" >= TIMESTAMP '2024-01-01 00:00:00'
                                   AND "timestamp" < TIMESTAMP '2024-01-29 00:00:00', FALSE)) AS BIGINT)
         AS outside_window,
       CAST(count(*) FILTER (WHERE seconds_since_session_start IS NULL) AS BIGINT) AS bad_seconds,
       CAST(count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN ('preview_clean', 'apply_clean'))
            AS BIGINT) AS bad_event_type,
       CAST(count(*) FILTER (WHERE event_type = 'apply_clean' AND success_bool IS NULL) AS BIGINT)
         AS apply_without_outcome,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT session_id FROM ev GROUP BY session_id
                                          HAVING count(DISTINCT ab_group) > 1)) AS arm_switch_sessions
FROM ev"""


# --- rows-only (random or iterative) ----------------------------------------

def _mixed(rows: str) -> str:
    """The scramble of column x, a step a level."""
    for step in (f"(xor(x, x >> 16) * {resample.MULTIPLIER}) & {resample.MASK}",) * 2 + ("xor(x, x >> 16)",):
        rows = f"(SELECT * REPLACE ({step} AS x) FROM {rows})"
    return rows


def _bootstrap_sql(metrics, stat: str, n_boot: int = 10_000, seed: int = 20260418) -> str:
    mask = resample.MASK
    keys = ", ".join(f"('{m}', '{arm}', {resample.arm_key(seed, m, arm)}::BIGINT)" for m in metrics for arm in ("A", "B"))
    low = _mixed("(SELECT metric, ab_group, v, c, q, xor(key, q & " + str(mask) + ") AS x FROM vc JOIN keys USING (metric, ab_group))")
    high = _mixed(f"(SELECT * REPLACE (xor(x, (q >> 32) & {mask}) AS x) FROM {low})")
    draws = _mixed(f"(SELECT metric, ab_group, v, c, r, (x + r * {resample.STEP}) & {mask} AS x FROM {high}, range({n_boot}) AS t(r))")
    pooled = "sqrt(((n_a - 1) * (q_a - s_a * s_a / n_a) / (n_a - 1) + (n_b - 1) * (q_b - s_b * s_b / n_b) / (n_b - 1)) / greatest(n_a + n_b - 2, 1))"
    value = {"mean_diff": "s_b / n_b - s_a / n_a",
             "cohens_d": f"CASE WHEN n_a < 2 OR n_b < 2 THEN NULL WHEN {pooled} = 0 THEN 0 ELSE (s_b / n_b - s_a / n_a) / {pooled} END"}[stat]
    return with_(EV, SESS, long_sql(metrics)) + f"""
, vc AS (SELECT metric, ab_group, v, count(*) AS c, CAST(floor(v * {resample.VALUE_SCALE} + 0.5) AS BIGINT) AS q FROM lng WHERE v IS NOT NULL GROUP BY 1, 2, 3),
keys(metric, ab_group, key) AS (VALUES {keys}),
table_of AS (SELECT c, k, coalesce(sum(exp(k * ln(c) - c - lgamma(k + 1))) OVER (PARTITION BY c ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT c, unnest(range(CAST(greatest(0, floor(c - 9 * sqrt(c) - 9)) AS BIGINT), CAST(ceil(c + 9 * sqrt(c) + 20) AS BIGINT))) AS k FROM (SELECT DISTINCT c FROM vc))),
draws AS (SELECT metric, ab_group, v, c, r, (x + 0.5) / 4294967296.0 AS u FROM {draws}),
sums AS (SELECT metric, r, {", ".join(f"sum({e}) FILTER (WHERE ab_group = '{arm}') AS {n}_{arm.lower()}" for n, e in (("n", "k"), ("s", "k * v"), ("q", "k * v * v")) for arm in ("A", "B"))}
  FROM draws ASOF JOIN table_of ON draws.c = table_of.c AND draws.u >= table_of.below GROUP BY metric, r),
reps AS (SELECT metric, {value} AS s FROM sums WHERE n_a > 0 AND n_b > 0)
SELECT metric, quantile_cont(s, 0.025) AS ci_low, quantile_cont(s, 0.975) AS ci_high, CAST(count(s) AS BIGINT) AS n_boot FROM reps WHERE s IS NOT NULL GROUP BY metric"""


@query("bootstrap_diff_ci")
def q_boot(spark, sf):
    return round_doubles(resample.bootstrap_diff_ci(sessions(spark, sf)))


SQL["bootstrap_diff_ci"] = sql_round(_bootstrap_sql(METRIC_FAMILY, "mean_diff"), ["ci_low", "ci_high"])


@query("bootstrap_d_ci")
def q_boot_d(spark, sf):
    return round_doubles(resample.bootstrap_d_ci(sessions(spark, sf)))


SQL["bootstrap_d_ci"] = sql_round(_bootstrap_sql(["apply_rate"], "cohens_d"), ["ci_low", "ci_high"])


@query("aa_check")
def q_aa(spark, sf):
    return resample.aa_check(sessions(spark, sf), replicates=10)


@query("assign_arm")
def q_assign(spark, sf):
    s = sessions(spark, sf).select("session_id").distinct()
    return sess_ops.assign_arm(s, "session_id", salt="rollout-2")


SQL["assign_arm"] = with_(EV, SESS) + """SELECT session_id, CASE WHEN contains('02468ace', substr(md5('rollout-2|' || session_id), 32, 1)) THEN 'A' ELSE 'B' END AS ab_group
FROM (SELECT DISTINCT session_id FROM sess)"""


@query("decision_row")
def q_decision(spark, sf):
    return round_doubles(stats.decision_row(stats.metric_report(sessions(spark, sf))), 6)


SQL["metric_report_full"] = sql_round(_full_sql(), ["group_a_mean", "group_b_mean", "statistic", "p_value", "p_value_bonferroni",
                                                    "p_value_fdr", "effect", "ci_low", "ci_high"], 6)
SQL["decision_row"] = sql_round(f"""
SELECT metric, p_value_bonferroni, effect, ci_low, ci_high,
       CASE WHEN p_value_bonferroni < 0.05 AND effect < 0 AND ci_high < 0 THEN 'ship'
            WHEN p_value_bonferroni >= 0.05 THEN 'do not ship' ELSE 'hold' END AS decision
FROM ({_full_sql()}) WHERE metric = 'apply_rate'""", ["p_value_bonferroni", "effect", "ci_low", "ci_high"], 6)
