"""Connected components by alternating large-star and small-star rounds, each an aggregate and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_work, read_work, write_work


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours under the least node it knows."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours under the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (node, component): the smallest node that each node reaches, for nodes that have edges.

    Self-links, repeated links and links with a null end change nothing; no edges give no rows. A node with very many
    links is pre-aggregated by the map-side minimum, and the join back is one that AQE can split. The edges of each
    round are written to the shared folder, those of the round before are deleted.
    """
    spark = edges.sparkSession
    tidy = edges.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    tidy = tidy.where("a > b").distinct()
    path, seen = write_work(tidy, "edges"), None
    while True:
        now = read_work(spark, path, tidy)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod("b", F.lit(1_000_003)))).first()
        if state[0] == 0 or state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component"))
            ).distinct()
        seen = state
        following = write_work(_small_star(_large_star(now)), "edges")
        drop_work(spark, path)
        path = following
