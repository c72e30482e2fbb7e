"""Connected components of a graph given as links, by alternating stars.

Every round points each node's larger neighbours, then its smaller ones, to the
smallest node known around it (Kiveris et al., "Connected Components in
MapReduce and Beyond").  The number of links never grows and no node's links
meet in one task: the minimum is a partial aggregate and the join back is one
that Spark can split on a hot node.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm._common import written


def _around(pairs: DataFrame, smaller: bool) -> DataFrame:
    """Links to each node's smallest neighbour (itself included), from its smaller or its larger neighbours."""
    nearest = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = pairs.join(nearest.withColumnRenamed("a", "k"), F.col("a") == F.col("k"))
    if smaller:
        # the node itself and its smaller neighbours; the smallest needs no link to itself
        return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                .union(nearest.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
    return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: bigint): component is the smallest node reachable.

    Links may repeat, point either way or join a node to itself (such a node alone is left out); null ends are ignored.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _around(both, smaller=False)
        edges = written(_around(large, smaller=True), label)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
