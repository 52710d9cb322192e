"""Connected components of a graph of links, by large-star and small-star rounds.

Each round points every node's larger (then smaller) neighbours at the least node around
it; a hub's neighbours stay rows of their own throughout.  The rounds end when the
links no longer change, which takes about the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .shared import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points at the least node around it."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    # written, so that the join has a plain exchange on each side and a hub can be split
    least = written(both.groupBy("a").agg(F.min("b").alias("m")), "star-least")
    near = both.join(least.select("a", F.least("a", "m").alias("m")).hint("merge"), "a")
    return written(near.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), "star-large")


def _small_star(links: DataFrame) -> tuple[DataFrame, tuple]:
    """Every smaller neighbour of a node, and the node, point at the least of them.

    After a large star a node has few smaller neighbours.
    """
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("mark"))
    links = written(out, "star-small")
    return links, (seen.get["n"], seen.get["mark"])


def connected_components(links: DataFrame) -> DataFrame:
    """From columns ``a`` and ``b``: ``node`` and its ``root``, the least node it reaches.

    A root itself, and a node without links, is not listed.  ``links`` is read twice and
    should be a written table.
    """
    links, seen = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), None
    while True:
        links, now = _small_star(_large_star(links))
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
