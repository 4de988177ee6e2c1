"""Connected components by contraction, entirely in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm import staging


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the component's smallest node.

    Each round points every node at its smallest neighbour if that is smaller, follows the pointers to their
    ends by doubling, and redraws the edges between those ends. Only local minima are ends, so at most half of
    the nodes stay in a round; a path takes one round of a few doublings. Rounds are staged, so lineage stays short.
    """
    spark = edges.sparkSession
    maps: list[DataFrame] = []
    live = staged_edges(edges)
    while not live.isEmpty():
        # An edge's smaller end comes first: a node that only comes first is a local minimum and stays.
        up = staging.staged(live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "cc")
        while True:
            hop = up.select(F.col("node").alias("up"), F.col("up").alias("upper"))
            if up.join(hop, "up", "left_semi").isEmpty():
                break
            up = staging.staged(up.join(hop, "up", "left").select("node", F.coalesce("upper", "up").alias("up")), "cc")
        maps.append(up)
        left = live.join(up.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a", "left").select(F.coalesce("ua", "a").alias("a"), "b")
        both = left.join(up.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
        live = staged_edges(both.select("a", F.col("ub").alias("b")))
    if not maps:
        return spark.createDataFrame([], "node long, root long")
    roots = maps[0].select("node", F.col("up").alias("root"))
    for later in maps[1:]:
        step = later.select(F.col("node").alias("root"), F.col("up").alias("next"))
        moved = roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        # Staged: it is named twice a round.
        roots = staging.staged(moved.union(later.select("node", F.col("up").alias("root")).join(roots.select("node"), "node", "left_anti")), "roots")
    tops = roots.select(F.col("root").alias("node")).distinct()
    return roots.union(tops.select("node", F.col("node").alias("root")))


def staged_edges(edges: DataFrame) -> DataFrame:
    """Each edge between two nodes once, smaller end first."""
    once = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return staging.staged(once.distinct(), "edges")
