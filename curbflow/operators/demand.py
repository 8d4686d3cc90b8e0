"""From trips to demand tables.

All aggregates here are counts and sums, so Spark combines them before the
shuffle and a busy zone or hour costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.operators.clean import clean_trips
from curbflow.spec import DEMAND_COLS, DEMAND_KEYS, ZONE_KEY, DemandSpec


def add_trip_features(trips: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Add pickup time, hour, day (1 = Sunday), month and date; keep all columns."""
    spec.check(trips)
    ts = F.col(spec.ts_col)
    return trips.withColumns({
        "pickup_datetime": ts,
        "pickup_hour": F.hour(ts),
        "pickup_day": F.dayofweek(ts),
        "pickup_month": F.month(ts),
        "date_str": ts.cast("date"),
    })


def hourly_demand(featured: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Demand per date x hour x zone.

    ``trip_count`` counts the non-NULL values of ``spec.count_col`` and may
    be 0. ``avg_distance`` is the **sum** of the distances: the name is part
    of the table contract and is kept.
    """
    return (
        featured.groupBy("date_str", "pickup_hour", F.col(spec.zone_col).alias(ZONE_KEY))
        .agg(
            F.count(spec.count_col).alias("trip_count"),
            F.sum(spec.distance_col).alias("avg_distance"),
        )
    )


def demand_from_trips(trips: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Raw trips to hourly demand: clean, add features, aggregate."""
    return hourly_demand(add_trip_features(clean_trips(trips, spec), spec), spec)


def demand_by_window(
    trips: DataFrame,
    spec: DemandSpec = DemandSpec(),
    width: str = "1 minute",
    late_after: str | None = None,
) -> DataFrame:
    """Cleaned trips counted per tumbling window x hour x zone.

    Works on static and streaming input alike. ``late_after`` sets the
    watermark of a stream; watermarks need a zoned timestamp, so times
    without a zone are read in the session's time zone there.
    """
    clean = clean_trips(trips, spec)
    if late_after is not None:
        clean = clean.withColumn(spec.ts_col, F.col(spec.ts_col).cast("timestamp"))
        clean = clean.withWatermark(spec.ts_col, late_after)
    return (
        clean.groupBy(
            F.window(spec.ts_col, width).alias("window"),
            F.hour(spec.ts_col).alias("pickup_hour"),
            F.col(spec.zone_col).alias(ZONE_KEY),
        )
        .agg(
            F.count(spec.count_col).alias("trip_count"),
            F.sum(spec.distance_col).alias("avg_distance"),
        )
    )


def rollup_demand(rows: DataFrame) -> DataFrame:
    """Sum demand-shaped rows per key.

    Rows with a NULL key are dropped, NULL and NaN measures count as 0.
    """
    return (
        rows.dropna(subset=list(DEMAND_KEYS))
        .groupBy(*DEMAND_KEYS)
        .agg(*[
            F.coalesce(F.sum(number_or_null(rows, c)), F.lit(0)).alias(c)
            for c in ("trip_count", "avg_distance")
        ])
        .select(*DEMAND_COLS)
    )


def number_or_null(df: DataFrame, column: str):
    """The column with NaN turned into NULL where its type can hold NaN."""
    col = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(col, F.lit(None))
    return col
