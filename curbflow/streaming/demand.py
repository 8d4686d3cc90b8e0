"""The streaming producer of per-minute demand, and the trips it came too late for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbflow.operators.clean import clean_trips
from curbflow.operators.demand import demand_by_window, number_or_null
from curbflow.sources.demand import read_optional
from curbflow.spec import WINDOW_DATE, ZONE_KEY, DemandSpec, require_columns

WINDOW_KEYS = ("window", "pickup_hour", ZONE_KEY)
TASKS_PER_FILE = 16
_NOISE = 1e-9


def unique_trips(trips: DataFrame, trip_id: str, spec: DemandSpec = DemandSpec(), late_after: str = "10 minutes") -> DataFrame:
    """Cleaned trips, each id once: a repeat that arrives while the first is within the watermark's delay is dropped.

    Trips without an id can't be told apart and are one to the stream, so they are left out: filter or
    number them before if they are to count. Ids are kept in the state no longer than ``late_after``.
    """
    require_columns(trips, [trip_id])
    clean = clean_trips(trips, spec).filter(F.col(trip_id).isNotNull())
    timed = clean.withColumn(spec.ts_col, F.col(spec.ts_col).cast("timestamp")).withWatermark(spec.ts_col, late_after)
    return timed.dropDuplicatesWithinWatermark([trip_id]) if trips.isStreaming else timed.dropDuplicates([trip_id])


def start_demand_stream(
    trips: DataFrame,
    out_path: str,
    checkpoint_path: str,
    spec: DemandSpec = DemandSpec(),
    width: str = "1 minute",
    late_after: str = "10 minutes",
    trigger: dict | None = None,
    files_per_trigger: int | None = None,
    trip_id: str | None = None,
) -> StreamingQuery:
    """Count a stream of trips per window x zone and append closed windows to Parquet.

    A window is written once, when the watermark has passed its end; trips
    that arrive after that are dropped here and found again by :func:`late_windows`. With ``trip_id`` a trip sent
    twice counts once, see :func:`unique_trips`. ``checkpoint_path`` must be on
    shared storage. ``trigger`` holds arguments of ``DataStreamWriter.trigger``.
    The output has a folder per date of the window's start, so that readers
    of some dates skip the others, and a trigger is written by ``files_per_trigger`` tasks, by
    default one for every 16 shuffle partitions: more on a larger cluster, without a file for each partition of the state.
    """
    if files_per_trigger is None:
        files_per_trigger = max(1, int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions")) // TASKS_PER_FILE)
    if trip_id is None:
        demand = demand_by_window(trips, spec, width, late_after)
    else:
        demand = demand_by_window(unique_trips(trips, trip_id, spec, late_after), spec, width)
    dated = demand.withColumn(WINDOW_DATE, F.col("window.start").cast("date")).repartition(files_per_trigger)
    writer = (
        dated.writeStream.format("parquet").outputMode("append").partitionBy(WINDOW_DATE)
        .option("path", out_path).option("checkpointLocation", checkpoint_path)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def late_windows(
    trips: DataFrame, written: DataFrame, spec: DemandSpec = DemandSpec(), width: str = "1 minute", trip_id: str | None = None
) -> DataFrame:
    """What the stream's table lacks: per window, hour and zone the trips that came after their window was closed.

    ``trips`` are all trips as a static table, ``written`` the stream's output, together with late rows found before.
    Only windows up to the last one written are judged, for later ones may still be open. The rows have the form
    of the stream's, so adding them to its table makes it equal a batch count of these windows; a second
    run then finds nothing. One job for that last window and one aggregate: trips count for a window, what is written against it.
    """
    require_columns(written, [*WINDOW_KEYS, "trip_count", "avg_distance"])
    zoned = trips.withColumn(spec.ts_col, F.col(spec.ts_col).cast("timestamp"))
    expected = demand_by_window(zoned if trip_id is None else unique_trips(zoned, trip_id, spec), spec, width)
    bound = "struct<start: timestamp, end: timestamp>"
    counted = written.select(F.col("window").cast(bound).alias("window"), *WINDOW_KEYS[1:], "trip_count", "avg_distance")
    last = counted.agg(F.unix_micros(F.max("window.end"))).first()[0]
    distance = F.coalesce(number_or_null(expected, "avg_distance"), F.lit(0))
    both = expected.select(
        F.col("window").cast(bound).alias("window"), *WINDOW_KEYS[1:], "trip_count", distance.alias("avg_distance"), distance.alias("whole")
    ).unionByName(counted.select(
        *WINDOW_KEYS, (-F.col("trip_count")).alias("trip_count"), (-F.coalesce("avg_distance", F.lit(0))).alias("avg_distance"),
        F.lit(0).alias("whole"),
    ))
    sums = both.groupBy(*WINDOW_KEYS).agg(*[F.sum(c).alias(c) for c in ("trip_count", "avg_distance", "whole")])
    lacks = (F.col("trip_count") != 0) | (F.abs("avg_distance") > _NOISE * (1 + F.abs("whole")))
    return sums.where((F.unix_micros("window.end") <= F.lit(last)) & lacks).select(*WINDOW_KEYS, "trip_count", "avg_distance")


def append_late_windows(
    trips: DataFrame, stream_path: str, late_path: str, spec: DemandSpec = DemandSpec(), width: str = "1 minute", trip_id: str | None = None
) -> tuple[int, int]:
    """Add what the stream's table lacks to the table of late windows; returns (rows, trips) added.

    The late table lies beside the stream's, which only its query may write, and has the same columns and date folders, so
    both can be read, or merged with a batch table, as one.
    """
    spark = trips.sparkSession
    written, before = read_optional(spark, stream_path), read_optional(spark, late_path)
    if written is None:
        return 0, 0
    late = late_windows(trips, written if before is None else written.unionByName(before, allowMissingColumns=True), spec, width, trip_id)
    dated = late.withColumn(WINDOW_DATE, F.col("window.start").cast("date")).persist()
    try:
        rows, count = dated.agg(F.count(F.lit(1)), F.coalesce(F.sum("trip_count"), F.lit(0))).first()
        if rows:
            dated.hint("rebalance", F.col(WINDOW_DATE)).write.mode("append").partitionBy(WINDOW_DATE).parquet(late_path)
    finally:
        dated.unpersist()
    return rows, count
