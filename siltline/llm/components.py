"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltline.llm.common import checkpointed, joined_evenly


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the least node that links reach.

    Large-star and small-star steps in turn until nothing changes: each row moves to the
    least neighbour of its node. Nodes with very many neighbours are joined by broadcast, so
    no task gathers the neighbours of one node, and the number of rounds grows as a logarithm.
    Every round is cut off by checkpoints.
    Loops and repeated links change nothing; no links give no rows; null ends are left out.
    """
    ends = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    ends = checkpointed(ends.where("v > u").distinct())  # v hangs on the smaller u
    state = ends.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    while state[0]:
        # large star: the larger neighbours of a node move to its least neighbour
        both = ends.select(F.col("v").alias("x"), F.col("u").alias("y")).unionAll(ends.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = checkpointed(both.groupBy("x").agg(F.min("y").alias("m"), F.count("*").alias("_n")))
        moved = joined_evenly(ends.withColumnRenamed("u", "x"), least, "x", 2 * state[0])
        moved = checkpointed(moved.select("v", F.least("x", "m").alias("u")).where("v > u").distinct())
        # small star: a node's smaller neighbours and itself move to the least of them
        least = checkpointed(moved.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("_n")))
        small = joined_evenly(moved, least, "v", state[0])
        small = small.select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct("v", F.col("m").alias("u")))).alias("e"))
        ends = checkpointed(small.select("e.v", "e.u").where("v > u").distinct())
        new = ends.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    roots = ends.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.unionAll(ends.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
