"""Column contracts shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

# Column names of the tables this package reads and writes.
ZONE_KEY = "PULocationID"
DEMAND_KEYS = ("date_str", "pickup_hour", ZONE_KEY)
DEMAND_COLS = (*DEMAND_KEYS, "trip_count", "avg_distance")
WINDOW_DATE = "window_date"
FEATURES = ("day_of_week", "month", "is_weekend", "pickup_hour", ZONE_KEY)
HOUR_ZONE_FEATURES = ("pickup_hour", ZONE_KEY)
TARGET = "trip_count"
ZONE_COLS = ("location_id", "zone_name", "borough", "service_zone")
REQUEST_COLS = ("zone", "hour", "date")
RESPONSE_COLS = (
    "source", "zone", "zone_name", "borough", "service_zone", "hour", "date",
    "day_of_week", "month", "is_weekend", "predicted_demand",
)
CACHE_COLS = (*REQUEST_COLS, "prediction", "cached_at")


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise ``ValueError`` naming every column ``df`` lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


@dataclass(frozen=True)
class DemandSpec:
    """Names of the four trip columns the demand pipeline reads.

    ``count_col`` is the column whose non-NULL values are counted as trips.
    """

    ts_col: str = "tpep_pickup_datetime"
    zone_col: str = ZONE_KEY
    distance_col: str = "trip_distance"
    count_col: str = "VendorID"

    @property
    def columns(self) -> tuple[str, ...]:
        """The distinct input columns, in reading order."""
        return tuple(dict.fromkeys((self.count_col, self.ts_col, self.distance_col, self.zone_col)))

    def check(self, df: DataFrame) -> None:
        require_columns(df, self.columns)
