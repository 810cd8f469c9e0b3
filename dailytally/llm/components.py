"""Connected components of a table of links by alternating large-star and small-star.

Large-star joins each node's larger neighbours to its smallest neighbour (itself
included), small-star its smaller ones; repeated until nothing changes, every
node is linked with the smallest of its component alone. The smallest neighbour
is a partial aggregate, and the rows of a node are dealt by the edge join, so a
node with very many links needs no task of its own. Each round is written to
the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (a, b) with b < a; returns the same form."""
    if large:  # neighbours of either size; the larger ones move
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # smaller neighbours only, which all move, and the node itself
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    joined = both.join(least, "a")
    if large:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in the links (a, b); component is its least node."""
    ordered = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = stored(ordered, "links"), None
    while True:
        edges = stored(_star(_star(edges, True), False), "links")
        # Both sums change as long as some node's root does.
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if now == before:
            break
        before = now
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
