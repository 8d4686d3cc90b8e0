"""Scoring a table of (zone, hour, date) requests, with recent predictions reused."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.functions.calendar import day_of_week, is_weekend, request_date
from curbflow.operators.lookup import lookup_join
from curbflow.operators.zones import enrich_with_zone
from curbflow.spec import CACHE_COLS, REQUEST_COLS, RESPONSE_COLS, ZONE_KEY, require_columns

# Lifetime of a prediction and the two values of ``source``.
CACHE_TTL_SECONDS = 600
FROM_CACHE = "cache_redis"
FROM_MODEL = "model_inference"


def validate_requests(requests: DataFrame) -> DataFrame:
    """Add ``reject_reason``: NULL, or the first of bad_zone, bad_hour, bad_date that applies."""
    require_columns(requests, REQUEST_COLS)
    zone, hour = F.col("zone"), F.col("hour")
    return requests.withColumn(
        "reject_reason",
        F.when(zone.isNull() | (zone < 1), "bad_zone")
        .when(hour.isNull() | ~hour.between(0, 23), "bad_hour")
        .when(request_date(F.col("date")).isNull(), "bad_date"),
    )


def _moment(now: datetime | Column, dtype: T.DataType) -> Column:
    return (F.lit(now.isoformat(sep=" ")) if isinstance(now, datetime) else now).cast(dtype)


def fresh_entries(cache: DataFrame, now: datetime | Column, ttl_seconds: int = CACHE_TTL_SECONDS) -> DataFrame:
    """Cache rows younger than the lifetime and not later than ``now``, one or more per key."""
    require_columns(cache, CACHE_COLS)
    newest = _moment(now, cache.schema["cached_at"].dataType)
    oldest = newest - F.make_dt_interval(secs=F.lit(ttl_seconds))
    alive = (F.col("cached_at") > oldest) & (F.col("cached_at") <= newest)
    return cache.filter(alive & F.col("prediction").isNotNull()).select(*CACHE_COLS)


def fresh_predictions(cache: DataFrame, now: datetime | Column, ttl_seconds: int = CACHE_TTL_SECONDS) -> DataFrame:
    """The latest prediction per key among the entries younger than the lifetime.

    Equal times are settled by the greater prediction, so that the result
    does not depend on row order.
    """
    newest = F.max_by("prediction", F.struct("cached_at", "prediction"))
    return fresh_entries(cache, now, ttl_seconds).groupBy(*REQUEST_COLS).agg(newest.alias("cached"))


def probe_cache(
    requests: DataFrame, cache: DataFrame | None, now: datetime | Column, ttl_seconds: int = CACHE_TTL_SECONDS
) -> DataFrame:
    """Add ``cached`` (NULL on a miss) and ``source``.

    The date takes part as the text it was given. ``cache`` may be ``None``.
    """
    if cache is None:
        return requests.withColumns({"cached": F.lit(None).cast("double"), "source": F.lit(FROM_MODEL)})
    probed = lookup_join(
        requests, fresh_predictions(cache, now, ttl_seconds), REQUEST_COLS,
        sized_by=fresh_entries(cache, now, ttl_seconds),
    )
    source = F.when(F.col("cached").isNull(), FROM_MODEL).otherwise(FROM_CACHE)
    return probed.select(*requests.columns, "cached").withColumn("source", source)


def score_all(
    requests: DataFrame,
    model: Transformer,
    zones: DataFrame | None,
    cache: DataFrame | None,
    now: datetime | Column,
    ttl_seconds: int = CACHE_TTL_SECONDS,
) -> DataFrame:
    """Every valid request with features, cache state, zone attributes and both predictions.

    ``model`` is any transformer that reads feature columns and adds a
    ``prediction`` column. It comes last, so that the optimizer can merge it
    with the choice between the two predictions and run it on misses only.
    """
    valid = validate_requests(requests).filter(F.col("reject_reason").isNull()).drop("reject_reason")
    # The cache comes first: a shuffled probe then moves no feature columns.
    probed = probe_cache(valid, cache, now, ttl_seconds)
    # Only dates of the right form are left; the pattern need not be matched again.
    date = F.col("date").try_cast("date")
    featured = probed.withColumns({
        "day_of_week": day_of_week(date),
        "month": F.month(date),
        "is_weekend": is_weekend(date),
        "pickup_hour": F.col("hour"),
        ZONE_KEY: F.col("zone"),
    })
    return model.transform(enrich_with_zone(featured, zones, "zone"))


def to_response(scored: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The response columns of :func:`score_all`, preceded by request columns to carry along.

    A fresh prediction is rounded to two decimals, a reused one is given as
    it was stored.
    """
    demand = F.coalesce(F.col("cached"), F.round("prediction", 2))
    return scored.withColumns({
        "predicted_demand": demand, "is_weekend": F.col("is_weekend").cast("boolean"),
    }).select(*carry, *RESPONSE_COLS)


def score_requests(
    requests: DataFrame,
    model: Transformer,
    zones: DataFrame | None,
    cache: DataFrame | None,
    now: datetime | Column,
    carry: Sequence[str] = (),
    ttl_seconds: int = CACHE_TTL_SECONDS,
) -> DataFrame:
    """Responses for the valid requests, one per request row."""
    return to_response(score_all(requests, model, zones, cache, now, ttl_seconds), carry)


def cache_entries(scored: DataFrame, now: datetime | Column) -> DataFrame:
    """New cache rows: one unrounded prediction per key that was not in the cache."""
    return (
        scored.filter(F.col("cached").isNull())
        .groupBy(*REQUEST_COLS).agg(F.max("prediction").alias("prediction"))
        .withColumn("cached_at", _moment(now, T.TimestampType()))
    )
