"""Connected components of a graph that is never held in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.storage import drop_table, write_table


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of undirected edges (a, b); nodes of one component share their root.

    Each round every node joins the neighbour that comes first in a random order of that round (or stays, if it comes
    first itself) and the edges between joined nodes are contracted; rounds end when no edge is left. The order differs
    from round to round, so chains shrink by a constant share too. Minima are combined before the shuffle, and joins
    read written tables, so that rows of a node with very many edges can be split. Edges from a node to itself only
    make it a component of its own.
    """
    edges, labels, number = write_table(edges.select("a", "b").distinct(), "edges"), None, 0
    count = nodes = 2 * edges.count()
    while True:
        both = edges.union(edges.select("b", "a")).union(edges.selectExpr("a", "a")).union(edges.selectExpr("b", "b"))
        first = F.min_by("b", F.struct(F.xxhash64("b", F.lit(number)), "b"))
        joined = write_table(both.groupBy(F.col("a").alias("node")).agg(first.alias("next")), "joined", count)
        if labels is None:
            new = joined.withColumnRenamed("next", "root")
        else:
            step = joined.withColumnRenamed("node", "root")
            new = labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        new = write_table(new, "labels", nodes)
        start = joined.select(F.col("node").alias("a"), F.col("next").alias("to_a"))
        end = joined.select(F.col("node").alias("b"), F.col("next").alias("to_b"))
        left = edges.join(start, "a").join(end, "b").filter("to_a <> to_b")
        left = left.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        left = write_table(left, "edges", count)
        for old in (edges, joined, *([labels] if labels is not None else [])):
            drop_table(old)
        edges, labels, number, count = left, new, number + 1, 2 * left.count()
        if not count:
            return labels
