"""The table of recent predictions: batches of rows, listed by numbered commits."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.operators.score import CACHE_TTL_SECONDS
from curbflow.session import delete_path
from curbflow.sources.commits import commit_next, latest, prune
from curbflow.spec import CACHE_COLS, require_columns

_TYPES = dict(zip(CACHE_COLS, ("int", "int", "string", "double", "timestamp")))
_SCHEMA = ", ".join(f"{c} {t}" for c, t in _TYPES.items()) + ", cached_on date, batch string"
COMMITS_KEPT = 20


def _folder(path: str, batch: str) -> str:
    return f"{path.rstrip('/')}/data/batch={batch}"


def _write_batch(rows: DataFrame, path: str) -> str:
    """Write cache rows as a new batch with a folder per day; it counts once a commit lists it."""
    batch = uuid.uuid4().hex
    dated = rows.withColumn("cached_on", F.col("cached_at").cast("date"))
    dated.hint("rebalance", F.col("cached_on")).write.partitionBy("cached_on").parquet(_folder(path, batch))
    return batch


def append_predictions(entries: DataFrame, path: str) -> None:
    """Add cache rows as a batch of their own, in a folder per day.

    Other jobs may append, probe or expire meanwhile: a reader sees the whole batch or nothing of it, and
    no batch is lost. Times without a zone are taken to be in the session's, since a table
    must not mix the two kinds.
    """
    require_columns(entries, CACHE_COLS)
    batch = _write_batch(entries.select(*[F.col(c).cast(t).alias(c) for c, t in _TYPES.items()]), path)
    commit_next(entries.sparkSession, path, lambda old: {
        "batches": [*(old or {}).get("batches", []), batch], "retired": (old or {}).get("retired", []),
    })


def _table(spark: SparkSession, path: str, batches: list[str]) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], _SCHEMA)
    folders = [_folder(path, b) for b in batches]
    return spark.read.schema(_SCHEMA).option("basePath", f"{path.rstrip('/')}/data").parquet(*folders)


def stored_predictions(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the table as the newest commit lists it, whatever is added later; ``None`` if there is no table."""
    found = latest(spark, path)
    return None if found is None else _table(spark, path, found[1]["batches"]).drop("batch")


def read_predictions(
    spark: SparkSession, path: str, now: datetime, ttl_seconds: int = CACHE_TTL_SECONDS
) -> DataFrame | None:
    """The days of the prediction table that can hold live entries; ``None`` if there is no table."""
    table = stored_predictions(spark, path)
    if table is None:
        return None
    first_day = (now - timedelta(seconds=ttl_seconds)).date()
    return table.filter(F.col("cached_on").between(F.lit(first_day), F.lit(now.date()))).select(*CACHE_COLS)


def expire_predictions(spark: SparkSession, path: str, now: datetime, ttl_seconds: int = CACHE_TTL_SECONDS) -> None:
    """Drop the entries that are past their lifetime and compact the others into one batch.

    What is alive, entries later than ``now`` included, is written anew, days rebalanced over tasks by their
    size; only the days that can hold live entries are read. The new batch then takes the place of the batches that were
    listed at the start; batches added since stay listed. Replaced batches remain on disk until the next
    expiry, for readers that have pinned them. An absent table stays absent.
    """
    pinned = latest(spark, path)
    if pinned is None:
        return
    old = pinned[1]
    oldest = now - timedelta(seconds=ttl_seconds)
    alive = _table(spark, path, old["batches"]).filter(
        (F.col("cached_on") >= F.lit(oldest.date())) & (F.col("cached_at") > F.lit(oldest.isoformat(sep=" ")).cast("timestamp"))
    )
    batch = _write_batch(alive.select(*CACHE_COLS), path)
    gone = set(old["batches"])

    def change(current: dict | None) -> dict:
        if not gone <= set(current["batches"]):
            raise RuntimeError(f"{path} was expired by another job meanwhile")
        return {"batches": [batch, *[b for b in current["batches"] if b not in gone]], "retired": old["batches"]}

    commit_next(spark, path, change)
    for retired in old["retired"]:
        delete_path(spark, _folder(path, retired))
    prune(spark, path, COMMITS_KEPT)
