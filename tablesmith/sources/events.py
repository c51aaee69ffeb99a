"""Experiment event log (S4) and the mapping from an activity table.

The log has ten columns in fixed order. Loading parses types, maps the
``success`` text to a tri-state boolean, upper-cases and trims the arm, and
keeps arms A and B only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.sources.files import CSV_DIALECT

# The event-log columns, in order.
EVENT_COLUMNS = [
    "timestamp", "session_id", "ab_group", "event_type", "clean_action",
    "dataset_key", "columns_count", "success", "seconds_since_session_start",
    "details",
]

# The seven cleaning actions a session can log, in order.
CLEAN_ACTIONS = [
    "handle_missing", "remove_duplicates", "scale_columns", "encode_columns",
    "handle_outliers", "standardize_text", "coerce_types",
]

PREVIEW = "preview_clean"
APPLY = "apply_clean"

# A decimal number as text (sign, digits, fraction, exponent) or inf/nan.
NUMERIC_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf(inity)?|nan)\s*$"


def guarded_double(c: Column) -> Column:
    """Text to double; anything that is not plain numeric text becomes NULL
    (trap T15: ``try_cast('1.0d')`` would give 1.0)."""
    s = c.cast("string")
    ok = F.lower(s).rlike(NUMERIC_TEXT)
    return F.when(ok, F.trim(s).try_cast("double"))


def success_flag(c: Column) -> Column:
    s = F.lower(F.trim(c.cast("string")))
    return (F.when(s.isin("true", "1", "yes"), F.lit(True))
            .when(s.isin("false", "0", "no"), F.lit(False)))


def normalise_events(df: DataFrame) -> DataFrame:
    missing = [c for c in EVENT_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"The event log lacks the column(s) {missing}")
    ts_type = df.schema["timestamp"].dataType
    ts = (F.col("timestamp") if isinstance(ts_type, (T.TimestampType, T.TimestampNTZType))
          else F.try_to_timestamp(F.col("timestamp").cast("string"),
                                  F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"))
    cc_type = df.schema["columns_count"].dataType
    cc = (F.col("columns_count").cast("int") if isinstance(cc_type, T.IntegralType)
          else guarded_double(F.col("columns_count")).cast("int"))
    sec_type = df.schema["seconds_since_session_start"].dataType
    sec = (F.col("seconds_since_session_start").cast("double")
           if isinstance(sec_type, T.NumericType)
           else guarded_double(F.col("seconds_since_session_start")))
    arm = F.upper(F.trim(F.col("ab_group").cast("string")))
    return (df.select(
        ts.alias("timestamp"),
        F.col("session_id").cast("string").alias("session_id"),
        arm.alias("ab_group"),
        F.col("event_type").cast("string").alias("event_type"),
        F.col("clean_action").cast("string").alias("clean_action"),
        F.col("dataset_key").cast("string").alias("dataset_key"),
        F.coalesce(cc, F.lit(0)).alias("columns_count"),
        F.col("success").cast("string").alias("success"),
        F.nanvl(sec, F.lit(None).cast("double")).alias("seconds_since_session_start"),
        F.col("details").cast("string").alias("details"),
        success_flag(F.col("success")).alias("success_bool"),
    ).filter(F.col("ab_group").isin("A", "B")))


def append_events(events: DataFrame, path: str, batch_id: str) -> bool:
    """Normalised events added to a log folder as one batch; True if this call added it.

    The batch id claims a folder of its own: a batch that stands there whole is
    left alone, so a writer may repeat an append after any failure. What a
    crashed writer left without Spark's mark of success is written anew;
    readers never see it.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError(f"{batch_id!r} is no batch id: letters, digits, dots, dashes and underscores only")
    spark = events.sparkSession
    folder = f"{path.rstrip('/')}/batch={batch_id}"
    if _whole(spark, folder):
        return False
    normalise_events(events).write.mode("overwrite").parquet(folder)
    return True


def _whole(spark: SparkSession, folder: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All whole batches of an appended log, with their ``batch`` ids."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [s.getPath().toString() for s in fs.listStatus(root)] if fs.exists(root) else []
    whole = sorted(f for f in folders if f.rpartition("/")[2].startswith("batch=") and _whole(spark, f))
    if not whole:
        raise ValueError(f"{path} holds no whole batch")
    return spark.read.option("basePath", path).parquet(*whole).withColumn("batch", F.col("batch").cast("string"))


def load_event_log(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read a CSV log with every column as text, then normalise. The header
    is checked against the ten required columns before any job runs."""
    raw = spark.read.options(**CSV_DIALECT).option("multiLine", multi_line).option("header", True).option("mode", "FAILFAST").csv(path)
    return normalise_events(raw)


def event_log_from_activity(events: DataFrame, preview_types=("click", "view"),
                            apply_types=("purchase",), success_threshold: int = 50) -> DataFrame:
    """Map an activity table ``(event_id, ts, user_id, event_type, value,
    props)`` onto the ten-column log.

    Session = (user, calendar day); arm = parity of user id + day of month,
    so a session never switches arm; success = apply with ``k >= threshold``
    from the ``props`` JSON; action = ``k % 7``; seconds are counted from the
    start of the session day. Rows of other types stay in the log under their
    own type, with no action.
    """
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    action = F.element_at(F.array(*[F.lit(a) for a in CLEAN_ACTIONS]),
                          (F.pmod(k, F.lit(len(CLEAN_ACTIONS))) + 1).cast("int"))
    is_apply = F.col("event_type").isin(*apply_types)
    is_preview = F.col("event_type").isin(*preview_types)
    raw = (events
           .select(
               F.col("ts").alias("timestamp"),
               F.concat(F.col("user_id").cast("string"), F.lit("-"),
                        F.date_format(F.col("ts"), "yyyy-MM-dd")).alias("session_id"),
               F.when(F.pmod(F.col("user_id") + F.dayofmonth(F.col("ts")), F.lit(2)) == 0,
                      F.lit("A")).otherwise(F.lit("B")).alias("ab_group"),
               F.when(is_apply, F.lit(APPLY)).when(is_preview, F.lit(PREVIEW)).otherwise(F.col("event_type")).alias("event_type"),
               F.when(is_apply | is_preview, action).otherwise(F.lit("")).alias("clean_action"),
               F.lit("activity").alias("dataset_key"),
               F.pmod(k, F.lit(10)).alias("columns_count"),
               F.when(is_apply, F.when(k >= success_threshold, F.lit("True"))
                      .otherwise(F.lit("False"))).otherwise(F.lit("")).alias("success"),
               (F.expr("timestampdiff(MICROSECOND, date_trunc('DAY', ts), ts)") / 1e6)
               .alias("seconds_since_session_start"),
               F.col("props").alias("details"),
           ))
    return normalise_events(raw)


# Same mapping in SQL, for the DuckDB oracle (``events`` is the activity view).
EVENT_LOG_SQL = """
SELECT ts AS "timestamp",
       CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
       CASE WHEN (user_id + day(ts)) % 2 = 0 THEN 'A' ELSE 'B' END AS ab_group,
       CASE WHEN event_type = 'purchase' THEN 'apply_clean' WHEN event_type IN ('click', 'view') THEN 'preview_clean'
            ELSE event_type END AS event_type,
       CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN '' ELSE (['handle_missing','remove_duplicates','scale_columns','encode_columns',
         'handle_outliers','standardize_text','coerce_types'])
         [CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 + 1] END AS clean_action,
       'activity' AS dataset_key,
       CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS columns_count,
       CASE WHEN event_type = 'purchase' THEN
            CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 THEN 'True' ELSE 'False' END
            ELSE '' END AS success,
       date_diff('microsecond', date_trunc('day', ts), ts) / 1e6 AS seconds_since_session_start,
       props AS details,
       CASE WHEN event_type = 'purchase' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50
            ELSE NULL END AS success_bool
FROM events
"""
