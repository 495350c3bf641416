"""Connected components by alternating large-star and small-star steps.

Links live in a DataFrame and stay there; each round costs a minimum per node
and a join, and is stored in the shared folder so that lineage stays short.  The
minimum is combined before the shuffle.  The minima are dealt out anew before they are
joined back, so that both sides of the join are plain exchanges: adaptive execution then splits
a node with very many neighbours over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base


def _dealt(least: DataFrame) -> DataFrame:
    return least.repartition(max(1, int(least.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(_dealt(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = _dealt(down.groupBy("a").agg(F.min("b").alias("m")))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) of bigint nodes.  (node, root) for every node that is linked to
    a smaller one; roots themselves, and nodes without links, are left out."""
    now = base.cut(links.select("a", "b").where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (state := _state(now)) != before:
        before = state
        if state[0]:
            now = base.cut(_small_star(_large_star(now)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
