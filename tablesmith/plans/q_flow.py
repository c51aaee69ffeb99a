"""Registered queries for sources, step lists, k-NN and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablesmith import streaming
from tablesmith.operators import knn
from tablesmith.plans import steps
from tablesmith.plans.common import round_doubles, sql_round
from tablesmith.plans.q_clean import GL
from tablesmith.plans.q_experiment import SESS
from tablesmith.plans.tables import event_log, gappy_lineitem, table
from tablesmith.plans.versions import VersionStore
from tablesmith.session import staging_root
from tablesmith.sources import files
from tablesmith.sources.events import EVENT_LOG_SQL, append_events, read_appended

Q = {}
SQL = {}


def query(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


# --- S2: JSON records inside a table --------------------------------------------

@query("scan_json_props")
def q_json(spark, sf):
    """Parse the JSON ``props`` text of every activity row into typed columns."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


SQL["scan_json_props"] = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"


# --- S1-S3, S5: files and the appended log -----------------------------------------

def _scratch(spark, name):
    """A folder of this run's own below the shared one."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


@query("scan_csv_roundtrip")
def q_csv(spark, sf):
    """Orders exported as CSV and scanned again under their own schema."""
    orders, path = table(spark, sf, "orders"), _scratch(spark, "csv")
    files.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema)


SQL["scan_csv_roundtrip"] = "SELECT * FROM orders"


@query("scan_json_table")
def q_json_table(spark, sf):
    """Customers written as nested JSON lines; the reader flattens them."""
    customers, path = table(spark, sf, "customer"), _scratch(spark, "json")
    keys = [c for c in customers.columns if c.endswith("key")]
    rest = [c for c in customers.columns if c not in keys]
    customers.select(*keys, F.struct(*rest).alias("about")).write.json(path)
    schema = f"{', '.join(f'{c} {customers.schema[c].dataType.simpleString()}' for c in keys)}, about struct<{','.join(f'{c}:{customers.schema[c].dataType.simpleString()}' for c in rest)}>"
    return files.read_json(spark, path, schema, multi_line=False)


SQL["scan_json_table"] = "SELECT c_custkey, c_name AS about_c_name, c_nationkey, c_acctbal AS about_c_acctbal, c_mktsegment AS about_c_mktsegment FROM customer"


@query("append_events")
def q_append(spark, sf):
    """The log appended in two batches, each twice, as a writer does that lost the answer; every event stands once."""
    log, path = event_log(spark, sf), _scratch(spark, "log")
    half = F.pmod(F.crc32(F.col("session_id").cast("binary")), F.lit(2)) == 0
    for part, batch_id in ((log.where(half), "even"), (log.where(~half), "odd")):
        if not append_events(part, path, batch_id) or append_events(part, path, batch_id):
            raise RuntimeError("a batch was not added exactly once")
    return read_appended(spark, path).drop("batch")


SQL["append_events"] = EVENT_LOG_SQL


# --- V3, V4: versions ---------------------------------------------------------------

@query("versions_lineage")
def q_versions(spark, sf):
    """Lineage of four saves of customers, and the rows each key holds now and as of each save."""
    store, customers = VersionStore(spark, _scratch(spark, "versions")), table(spark, sf, "customer")
    first = store.register(customers, "customers", "all")
    few = store.register(customers.where("c_nationkey < 10"), "few", "ten nations", first, "c_nationkey < 10")
    store.overwrite(few, customers.where("c_nationkey < 5"), "c_nationkey < 5")
    store.overwrite(first, customers.drop("c_acctbal"), "drop c_acctbal")
    lines = store.history().select("seq", "key", "label", "n_rows", "n_cols", "source_key", "transform")
    held = None
    for seq in range(4):
        for key in (first, few) if seq else (first,):
            one = store.load(key, seq).agg(F.lit(seq).cast("long").alias("as_of"), F.lit(key).alias("held_key"), F.count("*").alias("held_rows"))
            held = one if held is None else held.unionByName(one)
    return held.join(lines, (held["as_of"] == lines["seq"]), "left")


SQL["versions_lineage"] = """
WITH n AS (SELECT count(*) AS a, count(*) FILTER (WHERE c_nationkey < 10) AS t, count(*) FILTER (WHERE c_nationkey < 5) AS f FROM customer),
w AS (SELECT CAST(count(*) AS INTEGER) AS c FROM (DESCRIBE customer)),
l AS (SELECT unnest([0, 1, 2, 3])::BIGINT AS seq, unnest(['customers_1', 'few_1', 'few_1', 'customers_1']) AS key,
             unnest(['all', 'ten nations', 'ten nations', 'all']) AS label, unnest([a, t, f, a]) AS n_rows, unnest([c, c, c, c - 1]) AS n_cols,
             unnest([NULL, 'customers_1', 'customers_1', NULL]) AS source_key,
             unnest([NULL, 'c_nationkey < 10', 'c_nationkey < 5', 'drop c_acctbal']) AS transform FROM n, w),
h AS (SELECT unnest([0, 1, 1, 2, 2, 3, 3])::BIGINT AS as_of, unnest(['customers_1', 'customers_1', 'few_1', 'customers_1', 'few_1', 'customers_1', 'few_1']) AS held_key,
             unnest([a, a, t, a, f, a, f]) AS held_rows FROM n)
SELECT * FROM h JOIN l ON as_of = seq"""


# --- V1: declarative step list ----------------------------------------------------

CLEAN_STEPS = [
    {"action": "handle_missing", "strategy": "mean", "columns": ["l_quantity", "l_extendedprice"]},
    {"action": "handle_outliers", "column": "l_extendedprice", "action_type": "cap"},
    {"action": "scale_columns", "columns": ["l_quantity"], "method": "minmax"},
    {"action": "encode_columns", "columns": ["l_returnflag"], "method": "label"},
    {"action": "remove_duplicates"},
]


@query("clean_steps")
def q_steps(spark, sf):
    return round_doubles(steps.run_steps(gappy_lineitem(spark, sf), CLEAN_STEPS),
                         only=["l_quantity", "l_extendedprice"])


SQL["clean_steps"] = sql_round("WITH " + GL + """,
f AS (SELECT * REPLACE (coalesce(l_quantity, (SELECT avg(l_quantity) FROM g)) AS l_quantity,
                       coalesce(l_extendedprice, (SELECT avg(l_extendedprice) FROM g)) AS l_extendedprice) FROM g),
qb AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM f),
c AS (SELECT f.* REPLACE (CASE WHEN l_extendedprice IS NULL THEN NULL ELSE
        least(greatest(l_extendedprice, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) END AS l_extendedprice)
      FROM f, qb),
s AS (SELECT c.* REPLACE ((l_quantity - (SELECT min(l_quantity) FROM c))
        / (SELECT CASE WHEN max(l_quantity) - min(l_quantity) = 0 THEN 1.0 ELSE max(l_quantity) - min(l_quantity) END
           FROM c) AS l_quantity) FROM c),
lm AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS BIGINT) AS code
       FROM (SELECT DISTINCT coalesce(l_returnflag, 'nan') AS v FROM s))
SELECT DISTINCT s.* REPLACE (lm.code AS l_returnflag) FROM s JOIN lm ON lm.v = coalesce(s.l_returnflag, 'nan')""",
                               ["l_quantity", "l_extendedprice"])


@query("preview_steps")
def q_preview(spark, sf):
    head, _summary = steps.preview(gappy_lineitem(spark, sf), CLEAN_STEPS, 20,
                                   ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag"])
    return round_doubles(head, only=["l_quantity", "l_extendedprice"])


SQL["preview_steps"] = "SELECT * FROM (" + SQL["clean_steps"] + """) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
l_extendedprice, l_discount, l_tax, l_returnflag LIMIT 20"""


# --- M8: k-NN imputation ---------------------------------------------------------

def gappy_part(spark, sf):
    p = table(spark, sf, "part")
    return p.withColumn("p_retailprice", F.when(F.col("p_partkey") % 10 == 0, F.lit(None).cast("double"))
                        .otherwise(F.col("p_retailprice")))


@query("knn_impute")
def q_knn(spark, sf):
    return round_doubles(knn.knn_impute(gappy_part(spark, sf), ["p_retailprice"], k=5, tie_key="p_partkey")[0])


SQL["knn_impute"] = sql_round("""
WITH g AS (SELECT * REPLACE (CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice END AS p_retailprice) FROM part),
refs AS (SELECT * FROM g WHERE p_retailprice IS NOT NULL),
w AS (SELECT 1.0 / var_pop(p_partkey) AS wk, 1.0 / var_pop(p_size) AS ws FROM refs),
near AS (SELECT q.p_partkey AS qk, r.p_retailprice AS v, row_number() OVER (PARTITION BY q.p_partkey ORDER BY
             CAST((q.p_partkey - r.p_partkey) * (q.p_partkey - r.p_partkey) AS DOUBLE) * wk
             + CAST((q.p_size - r.p_size) * (q.p_size - r.p_size) AS DOUBLE) * ws, r.p_partkey) AS place
         FROM g q, refs r, w WHERE q.p_retailprice IS NULL),
fill AS (SELECT qk, avg(v) AS v FROM near WHERE place <= 5 GROUP BY qk)
SELECT g.* REPLACE (coalesce(p_retailprice, fill.v) AS p_retailprice) FROM g LEFT JOIN fill ON qk = p_partkey
""", ["p_retailprice"])


# --- streams and their batch twins ---------------------------------------------------

@query("gap_sessions")
def q_gap_sessions(spark, sf):
    return streaming.gap_sessions(table(spark, sf, "events"), "30 minutes")


SQL["gap_sessions"] = """
WITH o AS (SELECT user_id, ts, event_type,
                  CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                         OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS brk FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
       CAST(count(*) AS BIGINT) AS n_events, CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT)
       AS n_purchases
FROM s GROUP BY user_id, sid"""


@query("events_hourly")
def q_hourly(spark, sf):
    return round_doubles(streaming.arm_rates_windowed(event_log(spark, sf), "1 hour"))


SQL["events_hourly"] = sql_round("""
WITH ev AS (""" + EVENT_LOG_SQL + """)
SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") AS window_start,
       time_bucket(INTERVAL 1 HOUR, "timestamp") + INTERVAL 1 HOUR AS window_end, ab_group,
       CAST(count(*) AS BIGINT) AS n_events, CAST(count(*) FILTER (WHERE event_type = 'apply_clean') AS BIGINT) AS n_apply,
       count(*) FILTER (WHERE event_type = 'apply_clean') / count(*) AS apply_rate
FROM ev GROUP BY 1, 2, 3""", ["apply_rate"])


@query("events_sliding")
def q_sliding(spark, sf):
    return round_doubles(streaming.arm_rates_windowed(event_log(spark, sf), "1 hour", "15 minutes"))


SQL["events_sliding"] = sql_round("""
WITH ev AS (""" + EVENT_LOG_SQL + """)
SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, ab_group, CAST(count(*) AS BIGINT) AS n_events,
       CAST(count(*) FILTER (WHERE event_type = 'apply_clean') AS BIGINT) AS n_apply,
       count(*) FILTER (WHERE event_type = 'apply_clean') / count(*) AS apply_rate
FROM (SELECT ab_group, event_type, time_bucket(INTERVAL 15 MINUTE, "timestamp") - k * INTERVAL 15 MINUTE AS w
      FROM ev, (SELECT unnest(range(4)) AS k))
GROUP BY 1, 2, 3""", ["apply_rate"])


def _run_name(query_name: str) -> str:
    """A registered query reads its tables anew each time; a service would keep one name and go on."""
    return f"{query_name}-{uuid.uuid4().hex}"


@query("stream_event_log")
def q_stream_ingest(spark, sf):
    return streaming.run_to_table(streaming.event_log_stream(spark, f"{sf.rstrip('/')}/events*.parquet"),
                                  _run_name("stream_event_log"))


SQL["stream_event_log"] = EVENT_LOG_SQL


@query("stream_session_metrics")
def q_stream_sessions(spark, sf):
    """The sessions that the stream has closed: those whose day ended an hour before the newest event."""
    ev = streaming.event_log_stream(spark, f"{sf.rstrip('/')}/events*.parquet")
    return streaming.run_to_table(streaming.session_metrics_windowed(ev), _run_name("stream_session_metrics"))


_CLOSED = """(SELECT * FROM (""" + EVENT_LOG_SQL + """) AS _e
  WHERE date_trunc('day', "timestamp") + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR)"""
SQL["stream_session_metrics"] = f"WITH ev AS {_CLOSED},\n{SESS}\nSELECT * FROM sess"


@query("stream_dedupe")
def q_stream_dedupe(spark, sf):
    """Every event arrives twice and is kept once."""
    path = f"{sf.rstrip('/')}/events*.parquet"
    twice = streaming.activity_stream(spark, path).unionByName(streaming.activity_stream(spark, path))
    return streaming.run_to_table(
        streaming.dedupe_events(twice).withColumn("ts", F.col("ts").cast("timestamp_ntz")), _run_name("stream_dedupe"))


SQL["stream_dedupe"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@query("stream_arm_stats")
def q_stream_arm_stats(spark, sf):
    """L4: running per-arm n, mean and variance of the apply rate over the
    sessions a stream closes, merged in ``foreachBatch``."""
    ev = streaming.event_log_stream(spark, f"{sf.rstrip('/')}/events*.parquet")
    folder = streaming.stream_folder(spark, _run_name("stream_arm_stats"))
    acc = streaming.RunningArmStats(f"{folder}/sums", "apply_rate")
    (streaming.session_metrics_windowed(ev).writeStream.foreachBatch(acc).trigger(availableNow=True)
     .option("checkpointLocation", f"{folder}/checkpoint").start().awaitTermination())
    return round_doubles(acc.totals(spark))


SQL["stream_arm_stats"] = sql_round(f"""WITH ev AS {_CLOSED},
{SESS}
SELECT ab_group, CAST(count(*) AS BIGINT) AS n, avg(apply_rate) AS mean, var_samp(apply_rate) AS var
FROM sess GROUP BY ab_group""", ["mean", "var"])


@query("two_column_dispatch")
def q_two_columns(spark, sf):
    from tablesmith.operators.eda.dispatch import two_columns
    return round_doubles(two_columns(gappy_lineitem(spark, sf), "l_returnflag", "l_extendedprice", kind="box"))


SQL["two_column_dispatch"] = sql_round("WITH " + GL + """
SELECT l_returnflag AS "group", CAST(count(l_extendedprice) AS BIGINT) AS count,
       avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS std, min(l_extendedprice) AS min,
       quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
       quantile_cont(l_extendedprice, 0.75) AS q3, max(l_extendedprice) AS max
FROM g WHERE l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1""",
                                       ["mean", "std", "min", "q1", "median", "q3", "max"])
