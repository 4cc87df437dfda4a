"""Connected components by contraction, as joins and aggregates over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenyard.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b: longs); root is one node of the component.

    Each round every node joins its least neighbour, chains are shortened, and the edges between the merged
    nodes go on to the next round; a component of any shape at least halves, so rounds grow with its logarithm.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    left = staged(both.where("a <> b").distinct(), "edges")
    result = None
    while not left.isEmpty():
        parent = left.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p"))
        for _ in range(2):
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
            parent = staged(parent.join(up, "p").select("a", F.col("q").alias("p")), "parents")
        step = parent.select(F.col("a").alias("node"), F.col("p").alias("root"))
        if result is None:
            result = step
        else:
            on = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            result = staged(result.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root")),
                            "roots")
        a = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = staged(left.join(a, "a").join(b, "b").where("ra <> rb")
                      .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if result is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return result
