"""Trip cleaning rules and the audit of what they remove."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.spec import DEMAND_COLS, ZONE_KEY, DemandSpec

# Audit names of the three rules, in the order they apply.
REJECT_REASONS = ("missing_time", "bad_distance", "missing_zone")


def clean_trips(trips: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Keep trips with a pickup time, a distance above zero and a pickup zone.

    One conjunctive filter over raw columns, so that a Parquet scan takes it
    as pushed filters. NULL distances fail the comparison; NaN passes it.
    """
    spec.check(trips)
    return trips.filter(
        F.col(spec.ts_col).isNotNull()
        & (F.col(spec.distance_col) > 0)
        & F.col(spec.zone_col).isNotNull()
    )


def picked_up_between(trips: DataFrame, first: date, last: date, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Trips picked up from the start of ``first`` to the end of ``last``; both bounds reach a Parquet scan.

    Zoned times are compared in the session's zone.
    """
    spec.check(trips)
    kind = trips.schema[spec.ts_col].dataType
    start, end = (F.lit(d.isoformat()).cast(kind) for d in (first, last + timedelta(days=1)))
    return trips.filter((F.col(spec.ts_col) >= start) & (F.col(spec.ts_col) < end))


def _reject_reason(spec: DemandSpec) -> Column:
    time, distance, zone = REJECT_REASONS
    return (
        F.when(F.col(spec.ts_col).isNull(), time)
        .when(~F.coalesce(F.col(spec.distance_col) > 0, F.lit(False)), distance)
        .when(F.col(spec.zone_col).isNull(), zone)
    )


def audited_demand(trips: DataFrame, spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Demand and removal counts out of a single pass over the trips.

    Kept trips form the usual date x hour x zone groups with a NULL
    ``reject_reason``; the removed ones form one group per reason with NULL
    keys. ``input_rows`` counts the trips of a group. Counting inside the
    aggregate stays exact when tasks are run again after a lost executor,
    which metrics gathered on the side do not promise.
    """
    spec.check(trips)
    reason = _reject_reason(spec)
    kept = F.col("reject_reason").isNull()
    return (
        trips.select(*spec.columns, reason.alias("reject_reason"))
        .groupBy(
            "reject_reason",
            F.when(kept, F.col(spec.ts_col).cast("date")).alias("date_str"),
            F.when(kept, F.hour(spec.ts_col)).alias("pickup_hour"),
            F.when(kept, F.col(spec.zone_col)).alias(ZONE_KEY),
        )
        .agg(
            F.count(spec.count_col).alias("trip_count"),
            F.sum(spec.distance_col).alias("avg_distance"),
            F.count(F.lit(1)).alias("input_rows"),
        )
        .select("reject_reason", *DEMAND_COLS, "input_rows")
    )


def quality_report(audited: DataFrame) -> DataFrame:
    """One row of counts from :func:`audited_demand`: input, removed per rule, kept, demand rows."""
    reason, rows = F.col("reject_reason"), F.col("input_rows")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)).cast("bigint")

    return audited.agg(
        total(F.lit(True)).alias("input_rows"),
        *[total(reason == name).alias(name) for name in REJECT_REASONS],
        total(reason.isNull()).alias("clean_rows"),
        total(reason.isNotNull()).alias("removed_rows"),
        F.count_if(reason.isNull()).alias("demand_rows"),
    )
