"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearplate.session import written


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node with an edge: the least node that can be reached.

    ``edges`` has two columns ``a, b`` of one orderable type. Large-star and small-star
    rounds in turn, each written to the shared folder: every round joins each node to its
    least neighbour, so long chains shrink by doubling and the links of one hub are spread
    over its neighbours. Joins read written tables, which Spark may split at a hot hub.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter("a != b").distinct(), "large")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").union(least.select("a", F.col("m").alias("b")))
        edges = written(small.distinct(), "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        before = now
    raise RuntimeError(f"components still changing after {max_rounds} rounds")
