"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def _directed(links: DataFrame) -> DataFrame:
    """Links (x, y) with x > y, once each."""
    return (
        links.where(F.col("x") != F.col("y"))
        .select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        .distinct()
    )


def _star_round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (x, y) with x > y.

    Large star: every neighbour above a node is hung on the node's least neighbour.
    Small star: a node and its lower neighbours are hung on the least of them.

    Skew: the first join is by a key of its own, so that both sides are shuffled for it
    and AQE can split a node with very many neighbours.
    """
    both = links.unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    key = F.bitwise_not("x").alias("k")
    large = both.select(key, "x", "y").join(least.select(key, "m"), "k")
    large = large.where(F.col("y") > F.col("x")).select(F.col("y").alias("x"), F.col("m").alias("y"))
    large = large.where(F.col("x") != F.col("y")).distinct()
    low = large.groupBy("x").agg(F.min("y").alias("m"))
    hung = large.join(low, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
    return hung.unionAll(low.select("x", F.col("m").alias("y"))).where(F.col("x") != F.col("y")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (x long, y long): root is the least node reachable.

    Rounds of star contraction until nothing changes; their number grows with the
    logarithm of the longest path.  Each round's links are written to the shared
    folder, which cuts the lineage; the driver sees a count and a checksum only.
    Self-links and repeats are ignored, an empty table gives an empty one.
    """

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()

    now = materialise(_directed(links), "links")
    before, after = None, state(now)
    while after[0] and before != after:
        now = materialise(_star_round(now), "links")
        before, after = after, state(now)
    roots = now.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct()
    return now.select(F.col("x").alias("node"), F.col("y").alias("root")).unionAll(roots)
