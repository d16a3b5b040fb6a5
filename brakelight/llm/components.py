"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove_tables, scratch_table


def components(links: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node connected with it.

    Alternating star contractions: first every node hands its larger neighbours to its smallest neighbour, then
    its smaller ones. Each half step is an aggregation (combined before the shuffle) and a join, links are
    distinct after it and written to the shared folder; it ends when a round changes nothing. Nothing is collected
    but the number and a checksum of the links. The table of a round is removed once the next one is written; the last
    one, which the result reads, is added to ``paths``.
    """
    paths = [] if paths is None else paths
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    spark, before, old = links.sparkSession, None, []
    edges = scratch_table(edges, "links", old)
    while True:
        new: list[str] = []
        edges = scratch_table(_small_star(_large_star(edges)), "links", new)
        remove_tables(spark, old)
        old = new
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if before == now:
            paths += old
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
