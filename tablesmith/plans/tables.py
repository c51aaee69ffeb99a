"""Loading the shared tables and the derived inputs the queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.operators.experiment.sessions import session_metrics
from tablesmith.sources.events import event_log_from_activity
from tablesmith.sources.files import read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log_from_activity(table(spark, sf_dir, "events"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_metrics(event_log(spark, sf_dir))


def gappy_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with gaps injected by key, the same way the oracle does:
    quantity missing when orderkey % 10 = 0, price when orderkey % 7 = 3,
    return flag when linenumber = 3."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_orderkey") % 10 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_orderkey") % 7 == 3, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount", "l_tax",
        F.when(F.col("l_linenumber") == 3, F.lit(None).cast("string"))
        .otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus", "l_shipdate")


# SQL twin of gappy_lineitem.
GAPPY_LINEITEM_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
       CASE WHEN l_orderkey % 7 = 3 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
       l_discount, l_tax,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS l_returnflag,
       l_linestatus, l_shipdate
FROM lineitem
"""
