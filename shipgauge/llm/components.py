"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node it can reach.

    Only roots are hooked: every root goes below its smallest neighbouring root,
    pointers are doubled until all lead to a root, and the links are contracted
    to links between different roots. Each round leaves only roots that had no
    smaller neighbour, and every step at least doubles the reach of a pointer,
    so steps grow with the logarithm of a component's size, in whatever order
    its nodes are numbered along it. Every step is written to the shared folder,
    and the one before it deleted. No links give no rows; repeated links and
    links of a node to itself are harmless.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a is not null and b is not null").distinct()
    left = written(pairs, "links")
    nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = written(nodes.select("node", F.col("node").alias("root")), "roots")
    left_now = left.where("a <> b")
    while not left_now.isEmpty():
        both = left_now.select(F.col("b").alias("node"), F.col("a").alias("up")).unionByName(
            left_now.select(F.col("a").alias("node"), F.col("b").alias("up")))
        hooked = written(both.groupBy("node").agg(F.min("up").alias("up")).select("node", F.least("node", "up").alias("up")), "hooked")
        while True:
            above = hooked.select(F.col("node").alias("up"), F.col("up").alias("top"))
            further = written(hooked.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") < F.col("up")).alias("moved")),
                              "hooked")
            discard(hooked)
            done, hooked = further.where("moved").isEmpty(), further.select("node", "up")
            if done:
                break
        onto = hooked.select(F.col("node").alias("root"), F.col("up"))
        new = written(roots.join(onto, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        ends = [hooked.select(F.col("node").alias(c), F.col("up").alias(f"_{c}")) for c in ("a", "b")]
        fewer = written(left_now.join(ends[0], "a").join(ends[1], "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
                        .where("a <> b").distinct(), "links")
        for old in (roots, left, hooked):
            discard(old)
        roots, left, left_now = new, fewer, fewer
    return roots
