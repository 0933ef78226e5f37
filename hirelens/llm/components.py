"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def roots(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of longs -> ``(node, root)`` for every linked node,
    where ``root`` is the smallest node of its component (the root itself
    has no row).

    Each round hangs every larger neighbour of a node on the node's smallest
    neighbour (large star), then every smaller one (small star); it ends when
    a round changes nothing, after about log(n) rounds. Only grouped minima
    and equi-joins are used, and each round's edges are written to the shared
    folder. Self links and repeated links are ignored; no link gives no row.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # The minima are written first: the joins are then of plain tables, and Spark can split a hub's links.
        lowest = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "lowest")
        large = written(both.join(lowest, "u").where("v > u")
                        .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")
        lowest = written(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = (large.join(lowest, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
        edges, before = written(small, "stars"), state
        state = _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
