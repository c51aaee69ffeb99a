"""Per-session metrics (X1), arm assignment (X25), funnels and histograms
(X20-X22) and event-quality counts (X26)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.sources.events import APPLY, PREVIEW

# The four metrics of the primary family, in report order.
METRIC_FAMILY = [
    "apply_rate",
    "preview_to_apply_conversion",
    "apply_success_rate",
    "successful_actions_per_session",
]


def session_metrics(events: DataFrame) -> DataFrame:
    """One row per (session_id, ab_group): counts, duration, distinct actions
    and the four rates. One shuffle on the session key with map-side partial
    aggregation, so a session holding a third of all events still arrives as
    one partial row per map task."""
    is_prev = F.col("event_type") == F.lit(PREVIEW)
    is_apply = F.col("event_type") == F.lit(APPLY)
    g = events.groupBy("session_id", "ab_group").agg(
        F.count_if(is_prev).alias("n_preview"),
        F.count_if(is_apply).alias("n_apply"),
        F.count_if(is_apply & (F.col("success_bool") == F.lit(True))).alias("n_apply_success"),
        F.max("seconds_since_session_start").alias("session_duration_s"),
        F.count_distinct(F.nullif(F.col("clean_action"), F.lit(""))).alias("distinct_clean_actions"),
    )
    total = F.col("n_preview") + F.col("n_apply")
    return g.select(
        "session_id", "ab_group", "n_preview", "n_apply", "n_apply_success",
        "session_duration_s", "distinct_clean_actions",
        F.when(total > 0, F.col("n_apply") / total).otherwise(F.lit(0.0)).alias("apply_rate"),
        F.when((F.col("n_preview") > 0) & (F.col("n_apply") > 0), F.lit(1.0))
        .otherwise(F.lit(0.0)).alias("preview_to_apply_conversion"),
        F.when(F.col("n_apply") > 0, F.col("n_apply_success") / F.col("n_apply"))
        .otherwise(F.lit(0.0)).alias("apply_success_rate"),
        F.col("n_apply_success").cast("double").alias("successful_actions_per_session"),
    )


def assign_arm(df: DataFrame, key: str = "session_id", salt: str = "arm",
               arms: tuple[str, str] = ("A", "B")) -> DataFrame:
    """Repeatable 50/50 assignment from the last bit of an MD5 of salt and key (X25), which any engine can repeat;
    a missing key has no arm."""
    last = F.substring(F.md5(F.concat(F.lit(f"{salt}|"), F.col(f"`{key}`").cast("string"))), 32, 1)
    return df.withColumn("ab_group", F.when(last.isin(*"02468ace"), F.lit(arms[0])).when(last.isNotNull(), F.lit(arms[1])))


def funnel_by_arm(sessions: DataFrame) -> DataFrame:
    """Sessions, >=1 preview, >=1 apply, >=1 success per arm, long form."""
    wide = sessions.groupBy("ab_group").agg(
        F.count("*").alias("sessions"),
        F.count_if(F.col("n_preview") > 0).alias("with_preview"),
        F.count_if(F.col("n_apply") > 0).alias("with_apply"),
        F.count_if(F.col("n_apply_success") > 0).alias("with_success"),
    )
    stages = ["sessions", "with_preview", "with_apply", "with_success"]
    steps = F.explode(F.array(*[
        F.struct(F.lit(i).alias("stage_order"), F.lit(s).alias("stage"),
                 F.col(s).alias("n_sessions")) for i, s in enumerate(stages)]))
    return (wide.select("ab_group", "sessions", steps.alias("x"))
            .select("ab_group", "x.stage_order", "x.stage", "x.n_sessions",
                    (F.col("x.n_sessions") / F.col("sessions")).alias("share")))


def rate_hist_by_arm(sessions: DataFrame, metric: str = "apply_rate", bins: int = 20) -> DataFrame:
    """Counts of a [0, 1] rate in ``bins`` fixed bins per arm; the last bin is
    closed. Empty bins are kept (dense grid of arms x bins)."""
    b = F.least(F.lit(bins - 1), F.floor(F.col(metric) * F.lit(float(bins)))).cast("long")
    counts = (sessions.filter(F.col(metric).isNotNull())
              .groupBy("ab_group", b.alias("bin")).agg(F.count("*").alias("n")))
    # Dense grid: every arm gets all ``bins`` bins (arms x bins rows).
    grid = (sessions.select("ab_group").distinct()
            .select("ab_group", F.explode(F.sequence(F.lit(0).cast("long"),
                                                     F.lit(bins - 1).cast("long"))).alias("bin")))
    return (grid.join(counts, ["ab_group", "bin"], "left")
            .select("ab_group", "bin",
                    (F.col("bin") / F.lit(float(bins))).alias("bin_lo"),
                    ((F.col("bin") + 1) / F.lit(float(bins))).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def events_per_session_hist(sessions: DataFrame) -> DataFrame:
    """Integer histogram of events (previews + applies) per session per arm."""
    return (sessions.groupBy("ab_group",
                             (F.col("n_preview") + F.col("n_apply")).alias("n_events"))
            .agg(F.count("*").alias("n_sessions")))


def event_quality(events: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Rows outside the test window, sessions seen in both arms, and rows with
    bad types; one aggregate over the raw log."""
    in_window = F.lit(True)
    if start is not None:
        in_window = in_window & (F.col("timestamp") >= start)
    if end is not None:
        in_window = in_window & (F.col("timestamp") < end)
    row_counts = events.agg(
        F.count("*").alias("n_events"),
        F.count_if(F.col("timestamp").isNull()).alias("bad_timestamp"),
        F.count_if(~F.coalesce(in_window, F.lit(False))).alias("outside_window"),
        F.count_if(F.col("seconds_since_session_start").isNull()).alias("bad_seconds"),
        F.count_if(F.col("event_type").isNull()
                   | ~F.col("event_type").isin(PREVIEW, APPLY)).alias("bad_event_type"),
        F.count_if((F.col("event_type") == APPLY) & F.col("success_bool").isNull())
        .alias("apply_without_outcome"),
    )
    switches = (events.groupBy("session_id")
                .agg(F.count_distinct("ab_group").alias("arms"))
                .agg(F.count_if(F.col("arms") > 1).alias("arm_switch_sessions")))
    # Both sides are single-row aggregates.
    return row_counts.join(switches, how="inner", on=F.lit(True))
