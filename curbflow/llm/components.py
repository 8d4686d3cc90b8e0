"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import checkpoint

MAX_ROUNDS = 200


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _to_least(edges: DataFrame) -> DataFrame:
    """Each (u, v) with the least neighbour of u, u included."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Hang the neighbours above each node on its least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = _to_least(both).where("v > u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its lower neighbours on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = _to_least(down)
    hung = stars.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return hung.where("u <> v").distinct()


def connected_components(edges: DataFrame, src: str, dst: str, out: str = "component") -> DataFrame:
    """(node, ``out``) for every node with an edge; ``out`` is the least node reachable.

    ``edges`` holds 64-bit ids in any direction; nulls and loops are left
    out, repeats do no harm. Steps work on aggregates and equi-joins only, so
    a node with a third of the edges is combined before its shuffle and its
    join partition can be split. Each round is checkpointed in the shared
    folder. No edges give no rows.
    """
    pairs = edges.select(F.col(src).cast("bigint").alias("u"), F.col(dst).cast("bigint").alias("v"))
    pairs = checkpoint(pairs.where("u <> v").distinct())
    state = _state(pairs)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        pairs = checkpoint(small_star(large_star(pairs)))
        now = _state(pairs)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias(out))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias(out)).distinct()
    return nodes.union(roots)
