"""Near-duplicate documents: universal hash minima, banding, exact checks, star components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.blocks import Forest, block_members, map_units
from curbflow.llm.common import map_arrow, stage, utf8, word_hashes
from curbflow.llm.components import connected_components
from curbflow.operators.lookup import fits_broadcast

SHINGLE = 5
THRESHOLD = 80  # per cent
BANDS, ROWS = 32, 4
# Share of equal minima below which a pair is not checked on full sets: five standard
# deviations of 128 minima under a similarity of 0.8, so it loses one pair in some millions.
SIGNATURE_SHARE = 0.62
BLOCK_TEXTS = 1024
BLOCK_SHINGLES = 1 << 20
SET_PIECE = 4096
BROADCAST_IDS = 2_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _constants(seed: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``size`` words; fewer words are one run; none, no set."""
    if not len(hashes):
        return hashes
    factor, _ = _constants(5, 64)
    width = min(size, len(hashes))
    total = np.full(len(hashes) - width + 1, np.uint64(width), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            total = (total ^ (total >> np.uint64(29))) * factor[j] + hashes[j : len(hashes) - width + 1 + j]
        total = (total ^ (total >> np.uint64(32))) * _MIX
    return np.unique(total)


def minima(shingles: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Least value of every hash a x + b mod 2^64 (upper half) over the set."""
    best = np.full(len(odd), np.iinfo(np.uint32).max, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), 2048):
            block = shingles[start : start + 2048]
            for k in range(0, len(odd), 32):
                values = (block[None, :] * odd[k : k + 32, None] + add[k : k + 32, None]) >> np.uint64(32)
                np.minimum(best[k : k + 32], values.min(axis=1).astype(np.uint32), out=best[k : k + 32])
    return best


def _sets(batch: pa.RecordBatch, size: int):
    for row, text in enumerate(batch.column("text").to_pylist()):
        yield row, shingle_set(word_hashes(utf8(text).lower()), size)


def signatures(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """(id, n, key, sig) per document; key is a 128-bit digest of the set, null for empty sets."""
    def over(batches):
        odd, add = _constants(seed, BANDS * ROWS)
        for batch in batches:
            counts, keys, sigs = [], [], []
            for _, shingles in _sets(batch, size):
                counts.append(len(shingles))
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                sigs.append(minima(shingles, odd, add).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                names=["id", "n", "key", "sig"],
            )

    return map_arrow(docs, over, "id long, n long, key binary, sig binary")


def _band_keys(classes: DataFrame) -> DataFrame:
    """(id, bucket) for every band of a signature."""
    def over(batches):
        factor, _ = _constants(3, ROWS)
        band = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint32)
            sig = sig.reshape(batch.num_rows, BANDS, ROWS).astype(np.uint64)
            with np.errstate(over="ignore"):
                key = np.broadcast_to(band, (batch.num_rows, BANDS)) * _MIX
                for r in range(ROWS):
                    key = (key ^ (key >> np.uint64(31))) * factor[r] + sig[:, :, r]
                key = (key ^ (key >> np.uint64(32))) * _MIX
            ids = np.repeat(batch.column("id").to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(key.ravel().view(np.int64))], names=["id", "bucket"])

    return map_arrow(classes.select("id", "sig"), over, "id long, bucket long")


def _pairs_out(ids: np.ndarray, links: list[tuple[int, int]]) -> pa.RecordBatch | None:
    if not links:
        return None
    a, b = np.array(links).T
    return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["u", "v"])


def _likely_links(key: tuple, rows: pa.Table) -> pa.RecordBatch | None:
    """A spanning forest of the pairs whose signatures agree enough."""
    ids = rows.column("id").to_numpy()
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), dtype=np.uint32).reshape(len(ids), -1)
    forest, need = Forest(len(ids)), SIGNATURE_SHARE * sig.shape[1]
    across = key[1] != key[2]
    block = rows.column("_b").to_numpy()
    for i in range(len(ids) - 1):
        others = np.arange(i + 1, len(ids))
        if across:
            others = others[block[others] != block[i]]
        if len(ids) > 8 and len(others):
            others = others[np.count_nonzero(sig[others, :16] == sig[i, :16], axis=1) > 0]
        for j in others[np.count_nonzero(sig[others] == sig[i], axis=1) >= need]:
            forest.link(i, int(j))
    return _pairs_out(ids, forest.links)


def _sure_links(key: tuple, rows: pa.Table) -> pa.RecordBatch | None:
    """A spanning forest of the pairs whose full sets are similar enough."""
    order = rows.sort_by([("id", "ascending"), ("piece", "ascending")])
    piece_ids = order.column("id").to_numpy()
    parts = [np.frombuffer(p, dtype=np.uint64) for p in order.column("part").to_pylist()]
    ids, first = np.unique(piece_ids, return_index=True)
    block = order.column("_b").to_numpy()[first]
    sizes = np.add.reduceat(np.array([len(p) for p in parts]), first)
    values = np.concatenate(parts)
    _, codes = np.unique(values, return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    forest, present = Forest(len(ids)), np.zeros(int(codes.max()) + 1, dtype=np.int32)
    across = key[1] != key[2]
    for i in range(len(ids)):
        own = codes[starts[i] : starts[i] + sizes[i]]
        root = forest.root(i)
        if i + 1 == len(ids):
            break
        present[own] = 1
        common = np.add.reduceat(present[codes], starts)
        present[own] = 0
        similar = 100 * common >= THRESHOLD * (sizes + sizes[i] - common)
        similar[: i + 1] = False
        if across:
            similar &= block != block[i]
        for j in np.flatnonzero(similar):
            if forest.root(int(j)) != root:
                forest.link(i, int(j))
                root = forest.root(i)
    return _pairs_out(ids, forest.links)


def _set_pieces(docs: DataFrame, size: int) -> DataFrame:
    """(id, piece, part) with at most SET_PIECE hashes a row, so long texts keep batches small."""
    def over(batches):
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for row, shingles in _sets(batch, size):
                cut = [shingles[s : s + SET_PIECE].tobytes() for s in range(0, len(shingles), SET_PIECE)]
                if cut:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[row]] * len(cut), pa.int64()), pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())],
                        names=["id", "piece", "part"],
                    )

    return map_arrow(docs, over, "id long, piece int, part binary")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = 17
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Words are lower-cased (A-Z) and cut at white space. Two documents are linked if
    100 * intersection >= 80 * union of their sets of ``shingle``-word shingles. A text with
    fewer words is one shingle; a null or blank one has none and is linked with nothing.

    1. One pass makes each document's set digest and 128 universal hash minima.
    2. Documents with equal sets form a class, carried by its least id.
    3. 32 bands of 4 minima bring classes together (a pair at 0.8 misses all bands
       once in 20 million). Buckets are compared in blocks by signature; only a
       spanning forest of likely links leaves a task.
    4. The connected groups of likely links are fetched again, their full sets compared
       exactly, in blocks, and again a spanning forest of true links is kept. What
       counts as linked is decided by full sets alone.
    5. Large-star and small-star give the components.

    Ids are integers. Rows with a null id are returned with a null component and kept, as
    nothing can name them. Rows with the same id count as one node with the links
    of all of them. Equal texts need equal digests of 128 bits. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    signed = stage(signatures(texts, shingle, seed), "near-signatures")
    known = signed.where("id is not null and key is not null")
    classes = known.groupBy("key").agg(F.min_by(F.struct("id", "n", "sig"), "id").alias("c")).select("c.*", "key")
    classes = stage(classes, "near-classes")

    buckets = _band_keys(classes)
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1").select("bucket")
    members = buckets.join(shared, "bucket").join(classes.select("id", "sig"), "id")
    units = block_members(members, "bucket", F.col("id"), F.lit(1), BLOCK_TEXTS)
    likely = connected_components(map_units(units, _likely_links, "u long, v long"), "u", "v", "grp")
    likely = likely.withColumnRenamed("node", "id")

    sized = likely.join(classes.select("id", "n"), "id")
    units = block_members(sized, "grp", F.col("id"), F.col("n"), BLOCK_SHINGLES).select("_group", "_i", "_j", "_b", "id")
    wanted = likely.select("id")
    ids = F.broadcast(wanted) if fits_broadcast(wanted, BROADCAST_IDS) else wanted
    sets = _set_pieces(texts.join(ids, "id", "left_semi"), shingle)
    sure = map_units(units.join(sets, "id"), _sure_links, "u long, v long")

    # rows that share an id, or a set, hang together through the class
    alike = known.join(classes.select("key", F.col("id").alias("rep")), "key").select("id", "rep", "key")
    repeated = alike.where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    edges = stage(sure, "near-links").union(_double_ids(alike))
    found = connected_components(edges, "u", "v", "component_id")
    roots = repeated.join(found, repeated["v"] == found["node"], "left").select(
        "u", F.coalesce("component_id", "v").alias("c")
    )
    resolved = roots.groupBy(F.col("u").alias("node")).agg(F.min("c").alias("component_id"))
    labels = found.unionByName(resolved).groupBy("node").agg(F.min("component_id").alias("component_id"))
    joined = signed.select("id", "n").join(labels, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
    )


def _double_ids(alike: DataFrame) -> DataFrame:
    """Links between the classes of ids that stand for several different sets."""
    many = alike.groupBy("id").agg(F.min("rep").alias("v"), F.max("rep").alias("m")).where("v <> m").select("id", "v")
    linked = alike.join(many, "id")
    own = linked.select(F.col("id").alias("u"), "v")
    return linked.select(F.col("rep").alias("u"), "v").union(own)
