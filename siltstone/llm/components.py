"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import dropped, settled


def _size(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges: their number and two sums of hashes."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(h % (1 << 31)), F.sum(F.shiftright(h, 33))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges: distinct or not, columns a and b of one orderable type -> (node, root), root the least
    node of the component; a node that is the root itself has no row, nor has a node without edges.
    Edges with a null end and loops are left out; no edges give no rows.

    Each round is a few joins and minima by key, the rounds grow with the logarithm of the size of
    a component; no list of neighbours is ever gathered. Every round is written to the shared folder.
    """
    edges = edges.select("a", "b").filter("a <> b")
    edges = settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    size = _size(edges)
    while size[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = settled(large.unionByName(edges.join(least.withColumnRenamed("a", "k"), F.col("a") == F.col("k")).select("a", F.col("m").alias("b")).filter("a <> b")).distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        old, edges = edges, settled(small.filter("a <> b").distinct(), "edges")
        dropped(old, large)
        before, size = size, _size(edges)
        if before == size:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
