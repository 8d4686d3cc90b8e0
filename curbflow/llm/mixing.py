"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.llm.common import SPACE, stage
from curbflow.operators import lookup_join

BLOCK_WORDS = 16
SHARD_DOCS = 1000
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    spaced = F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" "))
    return (F.size(F.split(spaced, SPACE)) - 2).cast("bigint")


def water_fill(sources: DataFrame, keys: Sequence[str], size: str, weight: str, cap: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` (double): shares of all sizes by weight, none above ``cap`` times its size.

    What a capped source can't take is shared again by weight among the
    others. In the order of size / weight the capped sources come first, so
    one running sum finds them all. ``sources`` has one row per source.
    """
    order = Window.orderBy(F.col(size) / F.col(weight), *keys)
    everything = Window.partitionBy()
    above = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum(size).over(everything) - cap * F.coalesce(F.sum(size).over(before), F.lit(0))) / F.sum(weight).over(above)
    ranked = sources.select("*", level.alias("_level"))
    capped = F.col("_level") * F.col(weight) >= cap * F.col(size)
    first_free = F.min(F.when(~capped, F.struct(F.col(size) / F.col(weight), "_level"))).over(everything)["_level"]
    return ranked.select(
        *sources.columns,
        F.when(capped | first_free.isNull(), cap * F.col(size)).otherwise(first_free * F.col(weight)).alias("target"),
    )


def apportion(
    parties: DataFrame, group: Sequence[str], party: Sequence[str], weight: str, seats: str, cap: str, out: str
) -> DataFrame:
    """Add ``out``: the integer ``seats`` of each group shared among its parties by Sainte-Laguë.

    Seat number j of a party has the quotient weight / (2 j - 1); the highest
    quotients get the seats, ties go to the party that sorts first. No party
    gets more than ``cap``. ``seats`` is the same on all rows of a group and
    at most the sum of their caps. Every party surely holds the seats that
    its exact share, less the spread of the rounding of all parties, leaves; only
    the few quotients around the edge are ranked.
    """
    w = Window.partitionBy(*group) if group else Window.partitionBy()
    part = F.coalesce(F.try_divide(F.col(weight).cast("double"), F.sum(weight).over(w)), F.lit(0.0))
    share = part * F.col(seats)
    spread = F.ceil(F.count(F.lit(1)).over(w) * part) + 2
    bounds = parties.withColumn(
        "_low", F.least(F.greatest(F.lit(0), F.floor(share - spread)), F.col(cap)).cast("bigint")
    ).withColumn(
        "_high", F.least(F.ceil(share + spread), F.col(cap)).cast("bigint")
    ).withColumn("_open", F.col(seats) - F.sum("_low").over(w))
    contested = bounds.where("_high > _low").withColumn("_j", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))))
    best = Window.partitionBy(*group).orderBy((F.col(weight) / (2 * F.col("_j") - 1)).desc(), *party, "_j")
    won = (
        contested.withColumn("_rank", F.row_number().over(best)).where("_rank <= _open")
        .groupBy(*[F.col(c).alias(f"_{c}") for c in (*group, *party)]).agg(F.count(F.lit(1)).alias("_won"))
    )
    on = [bounds[c] == won[f"_{c}"] for c in (*group, *party)]
    return bounds.join(won, on, "left").select(
        *[bounds[c] for c in parties.columns], (F.col("_low") + F.coalesce("_won", F.lit(0))).alias(out)
    )


def _marks(position: Column, quota: Column, blocks: Column, offset: Column) -> Column:
    """How many of the first ``position`` blocks are chosen in the partial epoch."""
    part = quota % blocks
    return F.floor((position * part + offset) / blocks)


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3), block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: int = 7,
) -> DataFrame:
    """(id, size, source_size, target, taken) per document: how many words the mix takes of it.

    Sources sort by code point, null last, and weigh ``weights`` in turn.
    Their targets share the words of all documents by weight, capped at three times a
    source's own words. Targets become whole blocks of ``block_words``
    words by Sainte-Laguë, first over the sources, then over the lanes of a source
    and the shards of a lane (about ``shard_docs`` documents each, so no window
    grows with the input). A shard lays its documents in seeded order on a line
    of blocks and takes its quota: whole epochs, and for the rest blocks spread
    evenly from a seeded start. A document gets the words of the taken blocks
    that fall on it, repeats counted; blocks cross document borders.

    Texts that are null or empty have size 0 and get 0. Documents with equal or
    null ids and repeated rows stay separate rows; ties in the seeded order go by
    id and size, among which rows are alike. An empty table gives no rows.
    Further columns are ignored. The sizes are staged in the shared folder, so
    texts are read once; only totals of sources and shards are shuffled beside
    (id, source, size).
    """
    sizes = stage(
        docs.select(
            F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
            F.col(source_col).isNull().alias("no_source"), word_count(F.col(text_col)).alias("size"),
        ), "mix-sizes",
    )
    key = ["no_source", "source"]
    totals = sizes.groupBy(*key).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    number = F.row_number().over(Window.orderBy("no_source", F.col("source").cast("binary"))) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    totals = totals.withColumn("weight", F.get(cycle, number % len(weights)))
    totals = water_fill(totals, key, "source_size", "weight")
    blocks_of = lambda c: F.ceil(c / F.lit(block_words)).cast("bigint")
    totals = totals.withColumn("n_shards", F.ceil(F.col("n_docs") / shard_docs).cast("int")).withColumn(
        "n_lanes", F.ceil(F.sqrt("n_shards")).cast("int")
    ).withColumn("cap", MAX_EPOCHS * blocks_of(F.col("source_size"))).withColumn(
        "seats", F.least(F.round(F.sum("target").over(Window.partitionBy()) / block_words), F.sum("cap").over(Window.partitionBy())).cast("bigint")
    )
    totals = stage(apportion(totals, [], key, "target", "seats", "cap", "source_blocks"), "mix-sources")

    placed = lookup_join(sizes, totals.select(*key, "n_shards", "n_lanes"), key)
    mixed_id = F.xxhash64("id", F.lit(seed))
    placed = placed.withColumn("shard", F.pmod(F.xxhash64(mixed_id, "size"), F.col("n_shards")).cast("int")).withColumn(
        "lane", F.pmod("shard", "n_lanes")
    )
    shards = placed.groupBy(*key, "lane", "shard").agg(F.sum("size").alias("shard_size")).withColumn(
        "blocks", blocks_of(F.col("shard_size"))
    ).withColumn("cap", MAX_EPOCHS * F.col("blocks"))
    lanes = shards.groupBy(*key, "lane").agg(F.sum("blocks").alias("lane_blocks"), F.sum("cap").alias("lane_cap"))
    lanes = lookup_join(lanes, totals.select(*key, "source_blocks"), key).withColumn(
        "seats", F.least("source_blocks", F.sum("lane_cap").over(Window.partitionBy(*key)))
    )
    lanes = apportion(lanes, key, ["lane"], "lane_blocks", "seats", "lane_cap", "seats_of_lane")
    shards = shards.join(lanes.select(*key, "lane", "seats_of_lane"), [*key, "lane"])
    quotas = apportion(shards, [*key, "lane"], ["shard"], "blocks", "seats_of_lane", "cap", "quota")
    quotas = quotas.select(*key, "shard", "blocks", "quota")

    line = Window.partitionBy(*key, "shard").orderBy(mixed_id, "id", "size")
    laid = placed.withColumn("stop", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    laid = laid.join(quotas, [*key, "shard"]).withColumn("start", F.col("stop") - F.col("size"))
    laid = laid.withColumn("blocks", F.greatest("blocks", F.lit(1)))
    offset = F.pmod(F.xxhash64("source", "shard", F.lit(seed)), F.col("blocks"))

    def words_before(position: Column) -> Column:
        """Words of the first ``position`` words of the line that the partial epoch takes."""
        block = F.floor(position / block_words)
        done = _marks(block, F.col("quota"), F.col("blocks"), offset)
        here = _marks(block + 1, F.col("quota"), F.col("blocks"), offset) - done
        return (done - _marks(F.lit(0), F.col("quota"), F.col("blocks"), offset)) * block_words + here * (position % block_words)

    epochs = F.floor(F.col("quota") / F.col("blocks"))
    taken = F.when(
        F.col("size") > 0, epochs * F.col("size") + words_before(F.col("stop")) - words_before(F.col("start"))
    ).otherwise(0).cast("bigint")
    result = laid.select("id", *key, "size", taken.alias("taken"))
    return lookup_join(result, totals.select(*key, "source_size", "target"), key).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "taken"
    )
