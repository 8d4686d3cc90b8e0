"""What the operators share: word rules, staging in the shared folder, Arrow batches."""

from __future__ import annotations

import atexit
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.session import ensure_checkpoint_dir, scratch_path

# White space between words, and the letters that are lower-cased.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BATCH_BYTES = 32 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts give an empty one."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACE}|{SPACE}\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def crc_mod(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of long texts small, unless the session already sets a bound."""
    if int(spark.conf.get(_BATCH_CONF, str(2**31 - 1))) >= 2**31 - 1:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended; whoever owns the folder clears it
        return


def shared_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = scratch_path(spark, name)
    atexit.register(_delete, spark, path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: computed once, lineage cut."""
    spark = df.sparkSession
    path = shared_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(97).integers(1, 1 << 63, 256, dtype=np.uint64)
_PIECE = 1 << 22


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.bases = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up, self.down = (np.ones(1, dtype=np.uint64) for _ in range(2))

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            grown = max(size, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up, self.down = (
                    np.cumprod(np.concatenate([[np.uint64(1)], np.full(grown - 1, b)]), dtype=np.uint64) for b in self.bases
                )
        return self.up[:size], self.down[:size]


_POWERS = Powers(_BASE)


def run_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Polynomial hash modulo 2^64 of each run values[start:end], from one running sum."""
    up, down = powers.to(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[:-1], out=total[1:])
        return (total[ends] - total[starts]) * down[starts]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word of a text in UTF-8, equal for equal words everywhere."""
    if len(data) > _PIECE:  # keep the running sums of very long texts small: cut them between words
        parts = data.split()
        whole = [b" ".join(parts[s : s + 65536]) for s in range(0, len(parts), 65536)]
        if len(whole) > 1:
            return np.concatenate([word_hashes(p) for p in whole])
    codes = np.frombuffer(data, dtype=np.uint8)
    edges = np.diff(np.concatenate([[True], _SPACES[codes], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    with np.errstate(over="ignore"):
        value = run_sums(_BYTE_VALUES[codes], starts, ends, _POWERS)
        value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + (ends - starts).astype(np.uint64)
        return (value ^ (value >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def byte_words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8; ``bytes.split`` splits at exactly the six characters of SPACE."""
    return utf8(text).split()


def grouped(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of equal keys from batches sorted by them; holds one group at a time."""
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        if starts[1] == 0:
            starts = starts[1:]
        for start, stop in zip(starts, starts[1:]):
            key = tuple(column[start] for column in columns)
            if held_key is not None and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(start, stop - start))
    if held_key is not None:
        yield held_key, pa.Table.from_batches(held)


def give_back() -> None:
    """Return what this process has freed to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn`` over the batches of each task. A worker waits for later tasks beside work that needs none: it keeps no freed memory."""
    def over(batches):
        yield from fn(batches)
        give_back()

    bound_batches(df.sparkSession)
    return df.mapInArrow(over, schema)
