"""Connected components of links as DataFrame joins."""

from pyspark.sql import DataFrame, functions as F

from vitals.llm.common import stored


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a``-``b``; the root is the least node of its component.

    Alternates large-star and small-star steps: links are moved to the least
    neighbour until every component is a star. Minima are aggregated before
    they meet the links, so a node with many links gathers nothing. A step
    makes one link of each, so copies of links are only removed in the first
    round, which makes most of them; a step is then a shuffle of the links and
    one of the minima.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, first = _state(edges), True
    while True:
        turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = edges.unionByName(turned).groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = stored(turned.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # a node's link to its least neighbour stays, those to others become theirs
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges, first = stored(small.distinct() if first else small, "links"), False
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
