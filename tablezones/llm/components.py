"""Connected components of links, as joins and aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablezones.llm.staging import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links`` (a, b).

    Each round sends every node to the neighbour, or itself, of the lowest
    hash under a new seed and carries the links over, so that the number of
    nodes shrinks by a factor a round whatever the order of ids. Minima are
    aggregated in each task first, so a node with very many links is no hot
    spot. Links from a node to itself make it a component of its own."""
    links = staged(links.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna(), "links")
    open_links = links.where("a <> b")
    moves: list[DataFrame] = []
    while not open_links.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(moves))).alias("h"), F.col(c).alias("id"))
        both = open_links.select("a", "b").unionAll(open_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("low"))
        move = staged(best.select(F.col("a").alias("node"), F.least(rank("a"), F.col("low"))["id"].alias("to")), "moves")
        moves.append(move)
        left, right = (move.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        moved = open_links.join(left, "a").join(right, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        open_links = staged(moved.where("a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node"))).distinct()
    if not moves:
        return nodes.withColumn("component", F.col("node"))

    def before(later: DataFrame, move: DataFrame) -> DataFrame:
        """Where ``move`` leads in the end; composed from the last round, so each round joins its own nodes only."""
        return move.join(later.select(F.col("node").alias("to"), F.col("at")), "to", "left").select("node", F.coalesce("at", "to").alias("at"))

    last = moves[-1].withColumnRenamed("to", "at")
    ends = staged(reduce(before, reversed(moves[:-1]), last), "labels")
    at = nodes.join(ends, "node", "left").select("node", F.coalesce("at", "node").alias("at"))
    least = at.groupBy("at").agg(F.min("node").alias("component"))
    return at.join(least, "at").select("node", "component")
