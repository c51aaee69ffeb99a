"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.staging import dropped, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Alternates two rewrites of the link table until nothing changes: every
    node's larger neighbours move to its smallest neighbour, then every node's
    smaller ones do. Each round writes its links below the shared folder. A
    hub of any degree is only ever aggregated by ``min`` (map-side first) and
    joined on, so the skew-join rewrite can split it.

    Nulls: links with a null end are ignored. Self links and repeated links
    change nothing. No links: an empty table.
    """
    both = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = written(both.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while True:
        ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ends.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(near, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        after = written(small, "links")
        same = after.count() == edges.count() and not after.join(edges, ["u", "v"], "left_anti").take(1)
        dropped(edges)
        edges = after
        if same:
            break
    stars = edges.groupBy("u").agg(F.min("v").alias("component"))
    return stars.select(F.col("u").alias("node"), "component").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
