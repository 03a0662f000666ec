"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkstream.llm.common import kept


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node each node is connected to.

    Every round joins all nodes to the smallest neighbour and their neighbours to that (large star, small star), so
    rounds grow with the logarithm of the longest chain. Each round is written to the shared folder. A node with very
    many neighbours is read by an aggregate with partial results, never as one list. Null ends are no links.
    """
    now = kept(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # large star: larger neighbours of a node go to its smallest neighbour
        ways = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = kept(large, "edges")
        # small star: smaller neighbours of a node, and itself, go to its smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        after = kept(small.distinct(), "edges")
        stamp = after.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if stamp == before:
            break
        now, before = after, stamp
    roots = after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
