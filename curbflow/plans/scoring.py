"""Requests to responses: a table at a time, or a single one."""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.sql import DataFrame, Row, SparkSession

from curbflow.operators.lookup import lookup_join
from curbflow.operators.score import (
    CACHE_TTL_SECONDS,
    FROM_MODEL,
    cache_entries,
    score_all,
    score_requests,
    to_response,
    validate_requests,
)
from curbflow.sources.predictions import append_predictions, read_predictions
from curbflow.spec import REQUEST_COLS, RESPONSE_COLS


def run_scoring(
    spark: SparkSession,
    requests: DataFrame,
    model: Transformer,
    zones: DataFrame | None,
    out_path: str,
    now: datetime,
    cache_path: str | None = None,
    ttl_seconds: int = CACHE_TTL_SECONDS,
) -> None:
    """Write the responses and, with a ``cache_path``, reuse and extend the prediction table.

    ``requests`` should be a written table: with a cache it is read twice,
    the first time for its distinct keys alone, which are far fewer than the
    requests. Each key is probed and scored once; requests look their key up,
    so all requests of a key missing from the cache count as misses within a
    run. ``now`` is naive and read in the session's time zone, like the
    stored times.
    """
    if cache_path is None:
        score_requests(requests, model, zones, None, now, ttl_seconds=ttl_seconds).write.mode("overwrite").parquet(out_path)
        return
    cache = read_predictions(spark, cache_path, now, ttl_seconds)
    keys = requests.select(*REQUEST_COLS).distinct()
    scored = score_all(keys, model, zones, cache, now, ttl_seconds).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        responses = lookup_join(requests.select(*REQUEST_COLS), to_response(scored), list(REQUEST_COLS), "inner")
        responses.select(*RESPONSE_COLS).write.mode("overwrite").parquet(out_path)
        append_predictions(cache_entries(scored, now), cache_path)
    finally:
        scored.unpersist()


def predict(
    spark: SparkSession,
    model: Transformer,
    zones: DataFrame | None,
    zone: int,
    hour: int,
    date: str,
    now: datetime,
    cache_path: str | None = None,
    ttl_seconds: int = CACHE_TTL_SECONDS,
) -> Row:
    """The response to a single request; ``ValueError`` with the reason if it is invalid."""
    request = spark.createDataFrame([(zone, hour, date)], "zone int, hour int, date string")
    reason = validate_requests(request).first()["reject_reason"]
    if reason is not None:
        raise ValueError(reason)
    cache = None if cache_path is None else read_predictions(spark, cache_path, now, ttl_seconds)
    scored = score_all(request, model, zones, cache, now, ttl_seconds)
    response = to_response(scored).first()
    if cache_path is not None and response["source"] == FROM_MODEL:
        append_predictions(cache_entries(scored, now), cache_path)
    return response
