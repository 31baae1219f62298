"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.session import stage

# A table of so many rows of two numbers, a few megabytes, is sent to every task; a larger one is shuffled.
SENT = 200_000
ROWS_A_TASK = 100_000


def sent(df: DataFrame, rows: int) -> DataFrame:
    """``df``, broadcast if its counted rows are few."""
    return F.broadcast(df) if rows <= SENT else df


def tasks(rows: int) -> int:
    """As many tasks as a table of so many rows of two numbers is worth."""
    return max(1, -(-rows // ROWS_A_TASK))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node reached.

    Every node takes the smallest among itself and its neighbours for its label, edges are
    renamed to the labels of their ends, and what joins a label to itself goes.  Labels are
    linked whenever their nodes were, so this is repeated on ever smaller tables until no edge
    is left, and the labels are then followed from the last round back to the first.  Each
    round writes two tables to the shared folder, in as many tasks as they have rows for; a
    hub is split by Spark, as the joins read plain tables, or needs no join by shuffles once
    they are counted to be small.  Loops and repeated edges change nothing; no edges, no rows.
    """
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    rounds = []
    while n := edges.count():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        labels = both.groupBy("node").agg(F.min("other").alias("root")).select("node", F.least("node", "root").alias("root"))
        labels = stage(labels.coalesce(tasks(2 * n)), "labels")
        rounds.append((labels, 2 * n))
        renamed = edges.join(sent(labels.select(F.col("node").alias("a"), F.col("root").alias("x")), 2 * n), "a").join(
            sent(labels.select(F.col("node").alias("b"), F.col("root").alias("y")), 2 * n), "b")
        renamed = renamed.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        edges = stage(renamed.distinct().coalesce(tasks(n)), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots, n = rounds.pop()
    while rounds:
        further = sent(roots.select(F.col("node").alias("root"), F.col("root").alias("last")), n)
        labels, n = rounds.pop()
        roots = labels.join(further, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return roots
