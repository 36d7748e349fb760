"""Connected components of a graph of any size, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstar.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    others = down.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.unionAll(others)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the smallest node.

    Hubs do not gather in one task: minima are combined before the shuffle, and the
    joins with them are split where keys are skewed. Rounds grow with the logarithm of
    the graph's size; each is written to the shared folder.
    """
    links = stored(edges.where("a <> b").select("a", "b").distinct(), "links")
    mark = None
    for _ in range(max_rounds):
        links = stored(_small_star(_large_star(links)).where("a <> b").distinct(), "links")
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
