"""Connected components of a table of links, by alternating large and small stars.

Each round is two aggregations and joins over the links; the table of links stays in the shared
folder and nothing is collected but a count and a checksum. A node with very many links is a skewed
join key, never one group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from estatelens.session import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b > least").select(F.col("b").alias("a"),
                                                             F.col("least").alias("b"))
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): every node that has a link and is not its component's smallest id, with
    that id. ``links``: bigint columns a and b, any direction, repeated or not."""
    now = written(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        # Exact decimal sum: a checksum that does not overflow.
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state or new[0] == 0:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
        state = new
        now = written(_small_star(_large_star(now)), "links")
