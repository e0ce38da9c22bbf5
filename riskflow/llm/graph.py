"""Connected components of a table of links, as DataFrame rounds (large-star / small-star).

Every round is a map-side combined minimum per node and a join back, which adaptive execution splits where a node
has very many links; nothing is gathered on the driver but whether a round was the last. Rounds are cut from each other
by tables in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import join_apart, materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return join_apart(both.filter("v > u"), least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_apart(e, least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node that ``links`` (a, b) mention; null ends are dropped.

    Rounds go on until all is settled; their number grows with the logarithm of the longest chain."""
    e = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(e, "components")
    while True:
        e = materialize(_small_star(_large_star(e)), "components")
        # done when every node hangs on one root, and no root on another
        ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            e.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up > 0 and down > 0").head(1):
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
