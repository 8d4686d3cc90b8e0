"""Benchmark passages in documents by spaced seeds. Column functions only."""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import lower_ascii, stage
from curbflow.operators.lookup import lookup_join

# Fixed masks: which of some consecutive words count (1) and which may differ (0). Of 13 words with any two
# changed, and of 11 or 12 with any one, a mask of the first group hits at some offset; the others are for
# 10, 9, and 7 or 8 words with one changed. ``masks_for`` proves it before it takes a group.
GROUPS = (("11101111", "110101111", "11110010011"), ("11011011",), ("1101101",), ("11011",))
MAX_PROVED = 10_000
WINDOW = 13
MIN_EQUAL = 0.84
MIN_WORDS = 1
SEED_ROWS = 1_000_000  # of three numbers each: about 100 MB as a broadcast table
PIECE_WORDS = 4096
_SEPARATOR = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """64-bit hashes of the runs of letters and digits, lower-cased; an empty array without any."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATOR, -1)
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seed(words: str, at: Column, mask: str) -> Column:
    """Hash of the counted words of a mask from ``at`` on."""
    counted = [F.get(words, at + i) for i, c in enumerate(mask) if c == "1"]
    return F.xxhash64(F.lit(mask), *counted)


def covers(masks: tuple[str, ...], width: int, misses: int) -> bool:
    """Whether, wherever ``misses`` of ``width`` words differ, a mask lies somewhere with all its counted words equal."""
    laid = [{at + i for i, c in enumerate(m) if c == "1"} for m in masks for at in range(width - len(m) + 1)]
    return all(any(ones.isdisjoint(gone) for ones in laid) for gone in combinations(range(width), misses))


def misses_of(width: int, min_equal: float) -> int:
    """How many of ``width`` words may differ."""
    return width - min(width, max(1, ceil(width * min_equal)))


def masks_for(width: int, misses: int) -> tuple[str, ...]:
    """Masks that find ``width`` words with any ``misses`` of them changed: the first group that does, or else
    a solid run, which one of misses + 1 parts of the words always holds."""
    if misses and comb(width, misses) <= MAX_PROVED:
        for group in GROUPS:
            if covers(group, width, misses):
                return group
    return ("1" * (width // (misses + 1)),)


def test_pieces(items: DataFrame, window: int) -> DataFrame:
    """(piece, item_ids, item, start, width): every text of ``items`` (item_id, item) once, the ids that have it, and how
    many words are compared at once; longer ones in pieces of PIECE_WORDS places, each with all words of its windows."""
    width = F.least(F.size("item"), F.lit(window))
    texts = items.groupBy("item").agg(F.collect_set(F.struct("item_id")).alias("item_ids"))  # in a struct nulls are kept
    starts = texts.withColumn("width", width).select("*", F.explode(F.sequence(F.lit(0), F.size("item") - F.col("width"), F.lit(PIECE_WORDS))).alias("start"))
    return starts.select(
        F.monotonically_increasing_id().alias("piece"), "item_ids", F.slice("item", F.col("start") + 1, F.col("width") - 1 + PIECE_WORDS).alias("item"),
        "start", "width",
    )


def test_seeds(pieces: DataFrame, masks: dict[int, tuple[str, ...]]) -> DataFrame:
    """(seed, piece, item_at, long): every seed of every piece, where it starts and its mask's length; ``masks`` by compared words."""
    frames = []
    for width, group in masks.items():
        fit = pieces.where(F.col("width") == width)
        for mask in group:
            places = fit.select("piece", "item", F.explode(F.sequence(F.lit(0), F.size("item") - len(mask))).alias("item_at"))
            frames.append(places.select(_seed("item", F.col("item_at"), mask).alias("seed"), "piece", "item_at", F.lit(len(mask)).alias("long")))
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def blocks_of(seeds: DataFrame, seed_rows: int) -> int:
    """Into how many blocks the pieces have to be dealt by hash, so that none has over ``seed_rows`` seeds, or is one piece."""
    counts = seeds.groupBy("piece").count()
    pieces, total = counts.agg(F.count(F.lit(1)), F.sum("count")).first()
    blocks = 1
    while blocks * seed_rows < (total or 0):
        blocks *= 2
    while blocks < pieces:
        (most,) = counts.groupBy(_block(blocks)).agg(F.sum("count").alias("n")).agg(F.max("n")).first()
        if most <= seed_rows:
            break
        blocks *= 2
    return blocks


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("piece"), F.lit(blocks))


def overlap(words: Column, words_at: Column, shift: Column, near: Column, first: Column, start: Column, width: Column) -> Column:
    """Most equal words in any ``width`` of an item's words ``near`` a hit, laid over the document, as (equal, length, at).

    ``words`` are the document's from ``words_at`` on, ``near`` those of an item's piece from ``first`` on; the piece begins at ``start``.
    Every window of the item that holds the hit's seed lies in ``near``; a pair that is accepted has a hit in its best window.
    """
    place = shift + start + first - words_at
    below = F.transform(F.sequence(F.lit(0), F.size(near) - 1), lambda k: F.get(words, place + k))
    same = F.zip_with(near, below, lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
    windows = lambda told: F.array_max(F.transform(F.sequence(F.lit(0), F.size(told) - width), lambda a: F.struct(
        F.aggregate(F.slice(told, a + 1, width), F.lit(0), lambda s, x: s + x).alias("equal"), width.alias("length"), (-(start + first + a)).alias("at")
    )))
    return F.get(F.transform(F.array(same), windows), F.lit(0))  # worked out once, though each window reads it


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, min_equal: float = MIN_EQUAL, min_words: int = MIN_WORDS, seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """(id, item_id, equal_words, window_words, item_start, doc_start): the items each document contains.

    Words are lower-cased runs of letters and digits. A document contains an item if, laid over it at some shift
    without gaps, some ``window`` consecutive words of the item (all of a shorter one)
    equal it in at least ``min_equal`` of the places: one of 7 to 12 words may differ, two of 13, and
    shorter items must agree in full. Items under ``min_words`` words, none by default, are not looked for. The best window is returned, once per document and item.

    Every place of a document gives a hash for each mask, which ignores some words, and meets the hashes of the
    benchmark by equality; the masks leave a hit in every pair the rule accepts. Around each hit the words are compared there and then, so neither
    texts nor hits that fail are shuffled; only (document, item) pairs are, combined per task. Benchmark
    hashes are broadcast as numbers alone, beside the items' words, each text once, in blocks of at most ``seed_rows`` rows;
    there is one pass over the documents for each, whose pairs are staged before the next, so executors hold one block at a time.

    Null and empty texts on either side contain nothing. Rows with a null id or a null item id are judged too, and
    rows with equal ids as one document. Empty tables give no rows. Further columns are ignored.
    """
    items = benchmark.select(F.col(item_id_col).alias("item_id"), tokens(F.col(item_text_col)).alias("item")).where(
        F.size("item") >= max(1, min_words)
    )
    pieces = stage(test_pieces(items, window), "benchmark-items")
    widths = [r[0] for r in pieces.select("width").distinct().collect()] or [window]
    masks = {w: masks_for(w, misses_of(w, min_equal)) for w in sorted(widths)}
    seeds = stage(test_seeds(pieces, masks), "benchmark-seeds")
    blocks = blocks_of(seeds, seed_rows)

    read = docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("words"))
    used = sorted({mask for group in masks.values() for mask in group})
    # outer: a plain explode would add a filter that cuts the texts into words a second time
    every = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))
    places = read.select("id", "words", F.explode_outer(every).alias("at")).where("at is not null")
    keys = F.array(*[F.when(F.col("at") + len(mask) <= F.size("words"), _seed("words", F.col("at"), mask)) for mask in used])
    hashed = places.select("id", "words", "at", F.explode(keys).alias("seed"))
    pairs = None
    for block in range(blocks):
        own = (lambda df: df.where(_block(blocks) == block)) if blocks > 1 else (lambda df: df)
        # a hit keeps the words that a window over its seed can reach, not those of the whole document
        from_ = F.greatest(F.lit(0), F.col("at") - (window - 1))
        hits = hashed.join(F.broadcast(own(seeds)), "seed").select(
            "id", "piece", "at", "item_at", "long", from_.alias("words_at"), F.slice("words", from_ + 1, F.lit(2 * window - 1)).alias("words"),
        ).join(F.broadcast(own(pieces.select("piece", "item", "start", "width"))), "piece")
        first = F.greatest(F.lit(0), F.col("item_at") + F.col("long") - F.col("width"))
        last = F.least(F.size("item"), F.col("item_at") + F.col("width")) - 1
        shift = F.col("at") - F.col("item_at") - F.col("start")
        found = overlap(F.col("words"), F.col("words_at"), shift, F.slice("item", first + 1, last - first + 1), first, F.col("start"), F.col("width"))
        checked = hits.select("id", "piece", shift.alias("shift"), found.alias("o"))
        # tested after the aggregates: as a join condition it would copy the words of every place
        best = stage(checked.groupBy("id", "piece").agg(
            F.max(F.struct("o.equal", "o.length", "o.at", (-F.col("shift")).alias("shift"))).alias("b")
        ), "benchmark-pairs")
        pairs = best if pairs is None else pairs.union(best)
    named = lookup_join(pairs, pieces.select("piece", "item_ids"), ["piece"], "inner").select("id", F.explode("item_ids.item_id").alias("item_id"), "b")
    merged = named.groupBy("id", "item_id").agg(F.max("b").alias("b"))
    need = F.greatest(F.lit(1), F.ceil(F.col("b.length") * min_equal))
    return merged.where(F.col("b.equal") >= need).select(
        F.col("id").alias(id_col), F.col("item_id").alias(item_id_col), F.col("b.equal").alias("equal_words"),
        F.col("b.length").alias("window_words"), (-F.col("b.at")).alias("item_start"), (-F.col("b.shift") - F.col("b.at")).alias("doc_start"),
    )
