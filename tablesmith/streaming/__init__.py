"""Structured Streaming versions of the event-log half.

The same mapping and aggregates as the batch operators, on ``readStream``
sources. A stream's progress and output live below the cluster's shared
``spark.checkpoint.dir``, under the stream's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesmith.sources.events import APPLY, PREVIEW, event_log_from_activity

ACTIVITY_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                   "props string")


def _event_time(df: DataFrame, col: str, watermark: str) -> DataFrame:
    """Watermarks need TIMESTAMP (with zone); the session zone is UTC."""
    return df.withColumn(col, F.col(col).cast("timestamp")).withWatermark(col, watermark)


def stream_folder(spark: SparkSession, name: str) -> str:
    """The folder of a stream below the shared checkpoint root: its progress and its output. A stream that is
    started again under its name goes on where it stopped."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; streams need a shared checkpoint folder")
    return f"{base.rstrip('/')}/streams/{name}"


def activity_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """L1 source: activity rows from Parquet files as they land."""
    return (spark.readStream.schema(ACTIVITY_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def event_log_stream(spark: SparkSession, path: str) -> DataFrame:
    """L1: typed ingest of the event log (stateless; same mapping as batch)."""
    return event_log_from_activity(activity_stream(spark, path))


def session_metrics_windowed(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """L2: session metrics per (calendar-day window, session, arm). Works on a
    batch or a stream; on a stream each session is emitted once, when the
    watermark passes the end of its day (append mode). Distinct actions use
    the size of a set (exact distinct counts are not allowed in streams)."""
    is_prev = F.col("event_type") == F.lit(PREVIEW)
    is_apply = F.col("event_type") == F.lit(APPLY)
    src = _event_time(events, "timestamp", watermark) if events.isStreaming else events
    g = src.groupBy(F.window("timestamp", "1 day").alias("day"), "session_id", "ab_group").agg(
        F.count_if(is_prev).alias("n_preview"), F.count_if(is_apply).alias("n_apply"),
        F.count_if(is_apply & (F.col("success_bool") == F.lit(True))).alias("n_apply_success"),
        F.max("seconds_since_session_start").alias("session_duration_s"),
        F.size(F.collect_set(F.nullif(F.col("clean_action"), F.lit("")))).cast("long")
        .alias("distinct_clean_actions"))
    total = F.col("n_preview") + F.col("n_apply")
    return g.select(
        "session_id", "ab_group", "n_preview", "n_apply", "n_apply_success", "session_duration_s",
        "distinct_clean_actions",
        F.when(total > 0, F.col("n_apply") / total).otherwise(F.lit(0.0)).alias("apply_rate"),
        F.when((F.col("n_preview") > 0) & (F.col("n_apply") > 0), F.lit(1.0)).otherwise(F.lit(0.0))
        .alias("preview_to_apply_conversion"),
        F.when(F.col("n_apply") > 0, F.col("n_apply_success") / F.col("n_apply")).otherwise(F.lit(0.0))
        .alias("apply_success_rate"),
        F.col("n_apply_success").cast("double").alias("successful_actions_per_session"))


def gap_sessions(activity: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Sessions of a user closed by ``gap`` of inactivity. Spark merges
    events into sessions inside each map task before the shuffle, so a very
    active user travels as sessions, not as raw events."""
    src = _event_time(activity, "ts", watermark) if activity.isStreaming else activity
    g = src.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(
        F.count("*").alias("n_events"),
        F.count_if(F.col("event_type") == "purchase").alias("n_purchases"))
    return g.select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    F.col("n_events").cast("long"), F.col("n_purchases").cast("long"))


def arm_rates_windowed(events: DataFrame, size: str = "1 hour", slide: str | None = None,
                       watermark: str = "1 hour") -> DataFrame:
    """L3: tumbling (or sliding) counts and apply rate per arm."""
    src = _event_time(events, "timestamp", watermark) if events.isStreaming else events
    win = F.window("timestamp", size, slide) if slide else F.window("timestamp", size)
    g = src.groupBy(win.alias("w"), "ab_group").agg(
        F.count("*").alias("n_events"),
        F.count_if(F.col("event_type") == F.lit(APPLY)).alias("n_apply"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "ab_group",
                    F.col("n_events").cast("long"), F.col("n_apply").cast("long"),
                    (F.col("n_apply") / F.col("n_events")).alias("apply_rate"))


def dedupe_events(events: DataFrame, key: str = "event_id", watermark: str = "1 hour") -> DataFrame:
    """Exactly-once de-duplication of replayed events within the
    watermark (state is dropped once the watermark passes)."""
    if not events.isStreaming:
        return events.dropDuplicates([key])
    return _event_time(events, "ts", watermark).dropDuplicatesWithinWatermark([key])


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over everything available (``availableNow``) into a
    Parquet table of its own and return that table. Tasks write their rows and
    a batch counts when its files are committed, so a restart under the same
    name neither loses nor repeats rows, and no row passes the driver."""
    folder = stream_folder(df.sparkSession, name)
    (df.writeStream.format("parquet").queryName(name).outputMode("append").trigger(availableNow=True)
     .option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/table").awaitTermination())
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/table")


class RunningArmStats:
    """L4: running n, sum and sum of squares of a session metric per arm, for
    ``foreachBatch``. Each batch's sums are a folder of their own named by its
    id; a batch that runs again after a failure overwrites its folder, so
    totals count it once, also after a restart."""

    def __init__(self, path: str, metric: str = "apply_rate"):
        self.path, self.metric = path.rstrip("/"), metric

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        m = F.col(self.metric)
        (batch.groupBy("ab_group").agg(F.count("*").alias("n"), F.sum(m).alias("s"), F.sum(m * m).alias("q"))
         .write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}"))

    def _sums(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("ab_group string, n long, s double, q double, batch_id long").parquet(self.path)

    def totals(self, spark: SparkSession) -> DataFrame:
        """(ab_group, n, mean, var) over all batches so far."""
        g = self._sums(spark).groupBy("ab_group").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
        mean = F.col("s") / F.col("n")
        return g.select("ab_group", "n", mean.alias("mean"), F.when(
            F.col("n") > 1, (F.col("q") - F.col("n") * mean * mean) / (F.col("n") - 1)).alias("var"))

    def alerts(self, spark: SparkSession, alpha: float = 0.01) -> DataFrame:
        """(batch_id, p_value) of the batches after which the arms' sizes differ too much from one half each."""
        from tablesmith.functions import dist

        upto = Window.orderBy("batch_id")  # one row per batch
        sizes = self._sums(spark).groupBy("batch_id").agg(
            F.sum(F.when(F.col("ab_group") == "A", F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("ab_group") == "B", F.col("n")).otherwise(0)).alias("b"))
        run = sizes.select("batch_id", F.sum("a").over(upto).alias("a"), F.sum("b").over(upto).alias("b"))
        chi2 = F.try_divide((F.col("a") - F.col("b")) * (F.col("a") - F.col("b")), F.col("a") + F.col("b"))
        return (run.select("batch_id", dist.chi2_df1_sf_udf(chi2.cast("double")).alias("p_value"))
                .where(F.col("p_value") < alpha))
