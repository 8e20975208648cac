"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairopanel.llm.common import drop_folder, stored, work_dir


def _nearest(edges: DataFrame, folder: str) -> DataFrame:
    """(u, v) with m, the least of u and all its v.

    The least are a written table, so that Spark sees their size: small ones are broadcast and the edges stay where they
    are; beyond that both sides of the join come straight from a shuffle, where adaptive execution splits a hub's edges.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("mu"), F.least("u", "m").alias("m"))
    return edges.join(stored(least, "least", folder), F.col("u") == F.col("mu")).select("u", "v", "m")


def _large_star(edges: DataFrame, folder: str) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _nearest(both, folder).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, folder: str) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _nearest(down, folder)
    links = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
    return links.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(u, v); root is the smallest node of its component.

    Rows may repeat and self-links are ignored. A round costs a few shuffles of the edge table, which never grows,
    and is written to the shared folder; the number of rounds grows with the logarithm of the components' size.
    """
    spark, before = edges.sparkSession, None
    folder = work_dir(spark, "components")
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", folder)
    while True:
        last, folder = folder, work_dir(spark, "components")
        edges = stored(_small_star(_large_star(edges, folder), folder), "edges", folder)
        drop_folder(spark, last)  # the new edges are written, nothing reads the old ones again
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
