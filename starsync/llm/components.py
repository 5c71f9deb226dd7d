"""Connected components of links between ids, as repeated Spark jobs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsync.session import stage


def _least(edges: DataFrame) -> DataFrame:
    """The least of each node and its neighbours (partial results per task, so hubs are no burden)."""
    return edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node.

    Alternates two star steps.  The large one hangs a node's larger neighbours on the least of its
    neighbourhood, the small one its smaller neighbours; each keeps the components and brings them
    nearer to stars around their least nodes, in a number of rounds that grows with the logarithm of
    their size.  It ends when a round changes nothing.  Each round is a table in the shared folder,
    so the plan does not grow and a lost executor costs one round at most.
    """
    edges = stage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = _both(edges)
        large = both.join(_least(both), "a").where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "links-large")
        least = _least(large)
        small = large.join(least, "a").select("b", "m").union(
            least.select(F.col("a").alias("b"), "m"))
        edges = stage(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
            "links-small")
    # Now every edge is (node, least node of its component).
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
