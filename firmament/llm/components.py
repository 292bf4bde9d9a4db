"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmament.llm.common import materialised


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node that has an edge: ``node, component``, from ``a, b``.

    Null ends and loops are no edges. In a large star every larger neighbour of a node is linked to its smallest one, in a small
    star every smaller neighbour; both shrink paths by half or more, so the rounds grow with the logarithm of the
    longest path. A node's minimum is a partial aggregate, never a collected group. Each round is written to the shared
    folder.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialised(links, "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                                F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        links = materialised(small.select("e.*").where("a <> b").distinct(), "links")
        state = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
