"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of distinct edges and a sum over them that moves when one does."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), where root is the smallest node of its component.

    Each pass hangs all neighbours of a node under the smallest one, with a partial minimum and a join, so a node with very many links is
    summed where its links lie and split in the join. The number of passes grows with the logarithm of the longest path; the state between
    passes is a written table. Links may repeat, run either way, or join a node with itself; null ends are ignored. No links, no rows.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = materialize(edges, "links")
    seen = _fingerprint(edges)
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), F.col("b")).where("a < b").distinct()
        smaller = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(smaller, "b").select(F.col("m").alias("m"), F.explode(F.array("a", "b")).alias("b")).where("m < b").select(F.col("m").alias("a"), "b").distinct()
        edges = materialize(small, "links")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
