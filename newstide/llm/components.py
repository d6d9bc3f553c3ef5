"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import written


def _kept(links: DataFrame, name: str) -> DataFrame:
    """A table of a round, in about two files a core: rounds write many tables, and most are small."""
    return written(links.coalesce(2 * links.sparkSession.sparkContext.defaultParallelism), name)


def _lower(links: DataFrame) -> DataFrame:
    """Every link once, from its larger to its smaller end."""
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.where("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour, or the node."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = _kept(least, "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = _kept(links.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every linked node.

    ``links`` has long columns ``a`` and ``b``; order, repeats and loops do not matter.
    A node without links to others has no row. Each round reads a stored table and stores
    the next one; the number of rounds grows with the logarithm of the longest chain. The
    smallest neighbours are partial minima, stored before they are joined back: both sides
    of the join are then plain shuffles, and adaptive execution splits a node with very many
    links over tasks.
    """
    current = _kept(_lower(links), "links")
    for _ in range(rounds):
        nxt = _kept(_lower(_small_star(_lower(_large_star(current)))), "links")
        # a star per component: no node is both an inner and an outer end
        settled = nxt.select("a").intersect(nxt.select("b")).isEmpty()
        single = settled and nxt.groupBy("a").count().where("count > 1").isEmpty()
        current = nxt
        if single:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
