"""Connected components of links as joins and groupings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumark.session import stored

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id in `links` (a, b).

    Each round every node takes its lowest neighbour, if that is lower than
    itself, and links between taken nodes are the next round's. What is low is
    the id itself in the first round, which ends stars around their smallest
    node, and a new hash in each further one, which halves long chains. Nodes
    and links never leave Spark's tables; only whether links are left is asked.
    """
    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    labels = links.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("node", F.col("id"))

    def rank(node: Column, turn: int) -> Column:
        return F.struct((F.lit(0) if turn == 0 else F.xxhash64(node, F.lit(turn))).cast("bigint").alias("rank"), node.alias("node"))

    for turn in range(MOST_ROUNDS):
        if not links.take(1):
            break
        ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        taken = ways.groupBy("a").agg(F.min(rank(F.col("b"), turn)).alias("low"))
        taken = stored(taken.select("a", F.least("low", rank(F.col("a"), turn))["node"].alias("to")), "hooks")
        labels = stored(
            labels.join(taken, labels["node"] == taken["a"], "left").select("id", F.coalesce("to", "node").alias("node")), "labels"
        )
        first, second = taken.select("a", F.col("to").alias("x")), taken.select(F.col("a").alias("b"), F.col("to").alias("y"))
        moved = links.join(first, "a").join(second, "b").where("x != y")
        links = stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    else:
        raise RuntimeError(f"links are left after {MOST_ROUNDS} rounds")
    smallest = labels.groupBy("node").agg(F.min("id").alias("component"))
    return labels.join(smallest, "node").select("id", "component")
