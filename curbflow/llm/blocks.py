"""Comparing the members of a group in blocks, so that no group has to fit one task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import grouped, map_arrow

UNIT_KEYS = ["_group", "_i", "_j"]


def block_members(members: DataFrame, group: str, member: Column, load: Column, most: int) -> DataFrame:
    """Rows of every group with two or more of them, dealt into pairs of blocks.

    ``load`` is what a row weighs in its block; a group gets as many blocks as
    keep a block's load near ``most``. A row lies in one block and is sent to each unit
    (_i <= _j) that pairs it with another block or itself, so each two members
    meet in exactly one unit if their blocks differ, and in (b, b) if not. A group
    within ``most`` is one unit. Rows with a null group are left out.
    """
    sized = (
        members.where(F.col(group).isNotNull()).groupBy(group)
        .agg(F.count(F.lit(1)).alias("_n"), F.ceil(F.sum(load) / most).cast("int").alias("_blocks"))
        .where("_n > 1").drop("_n")
    )
    joined = members.join(sized, group).withColumn("_blocks", F.greatest("_blocks", F.lit(1)))
    joined = joined.withColumn("_b", F.pmod(F.xxhash64(member, F.lit(11)), F.col("_blocks")).cast("int"))
    return joined.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        F.col(group).alias("_group"), F.least("_b", "_k").alias("_i"), F.greatest("_b", "_k").alias("_j"), "_b",
        *[c for c in members.columns if c != group],
    )


def map_units(units: DataFrame, fn: Callable[[tuple, pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to each unit; units of a partition pass one after the other."""
    def over(batches):
        for key, rows in grouped(batches, UNIT_KEYS):
            out = fn(key, rows)
            if out is not None and out.num_rows:
                yield out

    partitions = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.repartition(partitions, *UNIT_KEYS).sortWithinPartitions(*UNIT_KEYS)
    return map_arrow(dealt, over, schema)


class Forest:
    """Union-find over positions; keeps the links that joined two trees."""

    def __init__(self, size: int):
        self.parent = np.arange(size)
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = int(self.parent[x])
        return x

    def link(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.parent[max(ra, rb)] = min(ra, rb)
            self.links.append((a, b))
