"""Connected components of a large graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqflow.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b). large: the greater neighbours of each node are hung on the least node
    of its neighbourhood; else each node and its smaller neighbours are. Minima are combined before the
    shuffle, and the join back splits hubs, so no neighbourhood is gathered."""
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).withColumn("m", F.least("n", "m"))
    met = near.join(least, F.col("a") == F.col("n"), "inner")
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return out.where("a != b")


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of ordered ids -> (node, root): root is the least node of the component. Nodes without
    an edge to another node have no row. The edges are written once a round; rounds grow with the
    logarithm of the number of nodes."""
    edges = written(edges.select("a", "b").where("a != b").distinct(), "cc-edges")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = mark
        edges = written(_star(_star(edges, True), False).distinct(), "cc-edges")
