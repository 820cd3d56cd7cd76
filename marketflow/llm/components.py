"""Connected components by alternating stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Links each node's larger (or smaller) neighbours with the least node around it."""
    ways = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not small:
        ways = ways.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = ways.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.filter("a != b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a link: root is the least node it reaches.

    ``edges``: columns a, b. Each round is two joins; the number of rounds grows
    with the logarithm of the longest chain. A hub's links are never gathered:
    its least neighbour is an aggregate, and the join back may be split.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    state = None
    while True:
        # large star: what is above a node links to its least neighbour; small star: so does what is below
        large = _star(now, small=False)
        now = stored(_star(large, small=True), "links")
        said = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if said == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = said
