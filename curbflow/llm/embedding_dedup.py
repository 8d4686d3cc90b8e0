"""Near-equal embeddings: cross-polytope hashes after fast Hadamard rotations, exact cosine checks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.blocks import Forest, block_members, map_units
from curbflow.llm.common import map_arrow, stage
from curbflow.llm.components import connected_components

THRESHOLD = 0.98
BLOCK_VECTORS = 1024
BUCKET_VECTORS = 8
MISS = 1e-6


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        y = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x


def cross_polytope(unit: np.ndarray, seed: int, table: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest and second nearest of the signed axes after three signed Hadamard steps."""
    width = 1 << max(1, math.ceil(math.log2(max(2, unit.shape[1]))))
    x = np.zeros((len(unit), width), dtype=np.float32)
    x[:, : unit.shape[1]] = unit
    rng = np.random.default_rng((seed, table, number, width))
    for _ in range(3):
        x = hadamard(x * rng.choice(np.array([-1, 1], dtype=np.float32), width))
    size = np.abs(x)
    two = np.argpartition(-size, 1, axis=1)[:, :2]
    rows = np.arange(len(x))[:, None]
    two = np.take_along_axis(two, np.argsort(-size[rows, two], axis=1, kind="stable"), axis=1)
    signed = 2 * two + (x[rows, two] < 0)
    return signed[:, 0], signed[:, 1]


def _probes(unit: np.ndarray, seed: int, table: int, hashes: int) -> np.ndarray:
    """(rows, hashes + 1, hashes) codes: the own bucket, then one hash at a time moved to its second axis."""
    best = [cross_polytope(unit, seed, table, k) for k in range(hashes)]
    own = np.stack([b[0] for b in best], axis=1)
    out = np.repeat(own[:, None, :], hashes + 1, axis=1)
    for k in range(hashes):
        out[:, k + 1, k] = best[k][1]
    return out


def tables_for(dim: int, hashes: int, threshold: float, miss: float = MISS, seed: int = 23) -> int:
    """Tables after which a pair at the threshold is missed with less than ``miss``; measured on made-up pairs."""
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((4000, max(2, dim)))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = threshold * a + math.sqrt(1 - threshold**2) * b
    pa_, pb = _probes(a, seed, 0, hashes), _probes(b, seed, 0, hashes)
    met = (pa_ == pb[:, :1]).all(axis=2).any(axis=1) | (pb == pa_[:, :1]).all(axis=2).any(axis=1)
    return max(4, math.ceil(math.log(miss) / math.log(max(1e-9, 1 - 0.95 * met.mean()))))


def usable(values: list | None) -> np.ndarray | None:
    """The vector in double precision, scaled to a largest component of 1, or None if it links with nothing."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, dtype=np.float64)
    largest = np.abs(x).max()
    return x / largest if np.isfinite(largest) and largest > 0 else None


def _vectors(rows: DataFrame) -> DataFrame:
    """(id, label, dim, key, v): usable vectors, as raw doubles with the digest of what they hold."""
    def over(batches):
        for batch in batches:
            ids, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
            vectors = [usable(v) for v in batch.column("embedding").to_pylist()]
            good = [i for i, v in enumerate(vectors) if v is not None]
            raw = [vectors[i].tobytes() for i in good]
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in good], pa.int64()), pa.array([labels[i] for i in good], pa.string()),
                pa.array([len(vectors[i]) for i in good], pa.int32()),
                pa.array([xxhash.xxh3_128_digest(r) for r in raw], pa.binary()), pa.array(raw, pa.binary()),
            ], names=["id", "label", "dim", "key", "v"])

    return map_arrow(rows, over, "id long, label string, dim int, key binary, v binary")


def _matrix(column, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(column), dtype=np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _bucket_rows(classes: DataFrame, seed: int, hashes: int, tables: int) -> DataFrame:
    """(id, bucket, stored): the own bucket of every table and, not stored, the neighbouring ones."""
    def over(batches):
        for batch in batches:
            dims, v = batch.column("dim").to_numpy(), batch.column("v").to_pylist()
            labels = np.array([xxhash.xxh3_64_intdigest(s) for s in batch.column("label").to_pylist()], dtype=np.uint64)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                unit = _matrix([v[i] for i in at], int(dim))
                for table in range(tables):
                    codes = _probes(unit, seed, table, hashes).astype(np.uint64)
                    with np.errstate(over="ignore"):
                        key = np.repeat(labels[at][:, None], hashes + 1, axis=1) + np.uint64(table + 1) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dim)
                        for k in range(hashes):
                            key = (key ^ (key >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + codes[:, :, k]
                        key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                    stored = np.zeros(key.shape, dtype=bool)
                    stored[:, 0] = True
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(ids[at], hashes + 1)), pa.array(key.ravel().view(np.int64)), pa.array(stored.ravel()),
                    ], names=["id", "bucket", "stored"])

    return map_arrow(classes.select("id", "label", "dim", "v"), over, "id long, bucket long, stored boolean")


def _close(rows: pa.Table, threshold: float):
    """For each vector the positions of later ones that are near enough, equal label and width only."""
    dims = rows.column("dim").to_numpy()
    labels = np.array(rows.column("label").to_pylist(), dtype=object)
    v = rows.column("v").to_pylist()
    for dim in np.unique(dims):
        for label in set(labels[dims == dim]):
            at = np.flatnonzero((dims == dim) & (labels == label))
            unit = _matrix([v[i] for i in at], int(dim))
            for start in range(0, len(at), 256):
                near = unit[start : start + 256] @ unit.T >= threshold
                for r, c in zip(*np.nonzero(near)):
                    if c > start + r:
                        yield int(at[start + r]), int(at[c])


def _links(threshold: float):
    def unit(key, rows):
        ids, block, stored = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("id", "_b", "stored"))
        forest = Forest(len(ids))
        for a, b in _close(rows, threshold):
            if ids[a] != ids[b] and (stored[a] or stored[b]) and (key[1] == key[2] or block[a] != block[b]):
                forest.link(a, b)
        if not forest.links:
            return None
        a, b = np.array(forest.links).T
        return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["u", "v"])

    return unit


def _counts(threshold: float):
    def unit(key, rows):
        ids, block, copies = (rows.column(c).to_numpy() for c in ("id", "_b", "copies"))
        found = np.zeros(len(ids), dtype=np.int64)
        for a, b in _close(rows, threshold):
            if key[1] == key[2] or block[a] != block[b]:
                found[a] += copies[b]
                found[b] += copies[a]
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found)], names=["id", "found"])

    return unit


def near_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, hashes: int | None = None, seed: int = 41,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``embeddings``.

    Two vectors of equal, non-null label and equal width are linked if their cosine in double
    precision is at least ``threshold``. Vectors that are null, empty or zero, or hold null or
    non-finite components, are linked with nothing.

    Vectors that hold the same numbers form a class, which is hashed once and counts as many
    times as it has members. A table joins ``hashes`` cross-polytope hashes (by default
    as many as leave about eight vectors of a label to a bucket); the number of tables follows from the
    chance that a pair at the threshold meets, measured on made-up pairs, so that it is missed
    once in a million. A vector is stored in its own bucket and looks into the
    neighbouring ones, too. Buckets are compared in blocks by exact cosine and give a spanning
    forest of links; large-star and small-star join it to components. Links always lie inside a
    component, so the numbers of links come from comparing each component with itself, in
    blocks, which also finds links that no bucket has shown.

    Ids are integers. Rows with a null id have no component, no links and are kept. Rows that
    share an id are one node, yet each counts as a link of the others it is near to. An empty table
    gives no rows. Columns beyond those named are not read.
    """
    rows = embeddings.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("embedding")
    )
    vectors = stage(_vectors(rows.where("id is not null and label is not null and embedding is not null")), "vectors")
    same = ["label", "dim", "key"]
    classes = stage(
        vectors.groupBy(*same).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")), "vector-classes"
    ).withColumn("node", F.xxhash64("label", "dim", "key"))
    most = classes.groupBy("label", "dim").count().agg(F.max("count"), F.max("dim")).first()
    dim = most[1] or 2
    if hashes is None:
        hashes = max(1, math.ceil(math.log(max(2, (most[0] or 1) / BUCKET_VECTORS)) / math.log(2 * max(2, dim))))
    tables = tables_for(dim, hashes, threshold)

    nodes = classes.select(F.col("node").alias("id"), "label", "dim", "v", "copies")
    buckets = _bucket_rows(nodes, seed, hashes, tables)
    met = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("_size"), F.max("stored").alias("_any"))
    members = buckets.join(met.where("_size > 1 and _any").select("bucket"), "bucket").join(nodes.drop("copies"), "id")
    units = block_members(members, "bucket", F.col("id"), F.lit(1), BLOCK_VECTORS)
    links = stage(map_units(units, _links(threshold), "u long, v long"), "vector-links")
    found = stage(connected_components(links, "u", "v", "grp").withColumnRenamed("node", "id"), "vector-groups")

    units = block_members(found.join(nodes, "id"), "grp", F.col("id"), F.lit(1), BLOCK_VECTORS)
    counts = map_units(units, _counts(threshold), "id long, found long").groupBy("id").agg(F.sum("found").alias("found"))
    # ids: the least of a component; rows that share an id join the components of all of them
    of_class = classes.join(found.withColumnRenamed("id", "node"), "node", "left").join(
        counts.withColumnRenamed("id", "node"), "node", "left"
    ).select(*same, F.col("id").alias("first_id"), F.coalesce("grp", "node").alias("grp"), (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    of_row = stage(vectors.select("id", *same).join(of_class, same), "vector-rows")
    least = of_row.groupBy("grp").agg(F.min("id").alias("c"))
    shared = of_row.groupBy("id").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).where("a <> b").select("id")
    bridges = of_row.join(shared, "id").join(least, "grp").select("id", "c")
    merged = connected_components(bridges, "id", "c", "least")
    comp = least.join(merged, least["c"] == merged["node"], "left").select("grp", F.coalesce("least", "c").alias("component_id"))
    per_row = of_row.join(comp, "grp").groupBy("id", *same).agg(
        F.first("n_links").alias("n_links"), F.first("component_id").alias("component_id"), F.count(F.lit(1)).alias("n")
    )
    linked = per_row.select(
        "id", "n_links", "component_id", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_copy")
    ).drop("_copy")
    alone = _unusable(rows).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    everything = linked.unionByName(alone)
    return everything.select(
        F.col("id").alias(id_col), "n_links", "component_id", (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept")
    )


def _unusable(rows: DataFrame) -> DataFrame:
    """Ids of the rows that are linked with nothing."""
    def over(batches):
        for batch in batches:
            ids, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
            vectors = batch.column("embedding").to_pylist()
            out = [i for i, s, v in zip(ids, labels, vectors) if i is None or s is None or usable(v) is None]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["id"])

    return map_arrow(rows, over, "id long")
