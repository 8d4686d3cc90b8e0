"""The given tables seen as trips, zones, requests and stored predictions.

Each view here has a twin in ``workload/oracle.py``. ``events`` has no NULLs
and no value at or below 0, so the trip view makes some: without them the
cleaning rules would have nothing to do. Every view covers its whole table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.spec import DemandSpec
from curbflow.operators import zone_dimension

NOW = datetime(2024, 2, 1)
EVENT_SPEC = DemandSpec(ts_col="pickup_ts", zone_col="zone_id", distance_col="trip_distance", count_col="vendor_id")
LINE_SPEC = DemandSpec(ts_col="l_shipdate", zone_col="l_suppkey", distance_col="l_quantity", count_col="l_linenumber")
# The event types a streaming job delivers in the two-source queries; the rest arrive by batch.
STREAMED = ("view", "error")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_trips(events: DataFrame, *carry: str) -> DataFrame:
    """Events as trips, static or streaming, with the columns to carry."""
    return events.select(
        *carry,
        F.when(F.col("event_type") != "signup", F.col("event_id")).alias("vendor_id"),
        F.when(F.col("event_id") % 17 != 0, F.col("ts")).alias("pickup_ts"),
        (F.col("value") - 2.0).cast("decimal(12,2)").alias("trip_distance"),
        F.when(F.col("event_id") % 13 != 0, (F.col("user_id") % 30).cast("int")).alias("zone_id"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trips(table(spark, sf_dir, "events"))


def batch_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trips(table(spark, sf_dir, "events").filter(~F.col("event_type").isin(*STREAMED)))


def stream_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trips(table(spark, sf_dir, "events").filter(F.col("event_type").isin(*STREAMED)))


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        key.alias("location_id"),
        F.when(key != 7, F.col("n_name")).alias("zone_name"),
        F.col("r_name").alias("borough"),
        F.when(key % 5 == 1, "N/A").when(key % 5 != 0, "Boro Zone").alias("service_zone"),
    )


def zone_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a lookup file: each zone twice, of which the later counts, some without an id, with quotes and line breaks."""
    raw = raw_zones(spark, sf_dir)
    key = F.col("location_id")
    early = raw.withColumns({"zone_name": F.lit("early, \"old\""), "line": F.lit(0)})
    named = F.when(key % 3 == 0, F.concat("zone_name", F.lit(' "A", \nnorth'))).otherwise(F.col("zone_name"))
    late = raw.withColumns({"zone_name": named, "line": F.lit(1)})
    nameless = raw.withColumns({"location_id": F.lit(None).cast("int"), "line": F.lit(2)})
    return early.unionByName(late).unionByName(nameless)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_dimension(raw_zones(spark, sf_dir))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event; some have a zone, hour or date outside the contract."""
    ts = F.col("ts")
    second = F.second(ts)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        (F.col("user_id") % 30).cast("int").alias("zone"),
        F.when(F.minute(ts) == 59, 24).otherwise(F.hour(ts)).alias("hour"),
        F.when(second == 0, "2025-02-30").when(second == 1, F.date_format(ts, "yyyyMMdd"))
        .when(second == 2, "").when(second == 4, F.date_format(ts, "yyyy-MM-dd'\n'"))
        .when(second != 3, F.date_format(ts, "yyyy-MM-dd")).alias("date"),
    )


def stored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction stored for every event's key, 555 to 614 seconds before ``NOW`` or a minute after it."""
    ts = F.col("ts")
    age = F.make_dt_interval(secs=F.when(F.minute(ts) % 10 == 0, -60).otherwise(F.second(ts) + 555))
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 30).cast("int").alias("zone"),
        F.hour(ts).alias("hour"),
        F.date_format(ts, "yyyy-MM-dd").alias("date"),
        F.col("value").alias("prediction"),
        (now - age).alias("cached_at"),
    )


def labelled(trips_seen: DataFrame) -> DataFrame:
    """Raw trips with a window label as text, one row per trip."""
    minute = F.date_trunc("minute", "pickup_ts").cast("timestamp_ntz")
    form = "yyyy-MM-dd HH:mm:ss"
    label = F.concat(
        F.lit("["), F.date_format(minute, form), F.lit(", "),
        F.date_format(minute + F.expr("INTERVAL 1 MINUTE"), form), F.lit(")"),
    )
    return trips_seen.select(
        label.alias("window"), F.hour("pickup_ts").alias("pickup_hour"),
        F.col("zone_id").alias("PULocationID"), "trip_distance",
    )


def unlike_lines(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The line items under ``path`` as files of three kinds, whose columns differ in type as those of different years do.

    By year of shipping: small whole numbers; long ones; broken numbers, as tools write that hold missing values as such.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_shipdate", "l_quantity", "l_suppkey", "l_extendedprice")
    kind = F.year("l_shipdate") % 3
    types = [
        {"l_linenumber": "int", "l_suppkey": "int", "l_quantity": "double"},
        {"l_linenumber": "bigint", "l_suppkey": "bigint", "l_quantity": "double"},
        {"l_linenumber": "double", "l_suppkey": "int", "l_quantity": "float", "l_extendedprice": "string"},
    ]
    for i, casts in enumerate(types):
        lines.where(kind == i).withColumns({c: F.col(c).cast(t) for c, t in casts.items()}).write.parquet(f"{path}/kind{i}")
