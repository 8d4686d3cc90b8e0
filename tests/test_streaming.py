"""The streaming producer against the static operator."""

from pathlib import Path
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from curbflow.operators import demand_by_window, demand_from_trips, merge_demand
from curbflow.sources import load_demand
from curbflow.streaming import append_late_windows, start_demand_stream, unique_trips
from test_trips_and_demand import DEMAND_DDL, TRIP_DDL, found
from workload.tables import EVENT_SPEC, as_trips, table

START = datetime(2025, 1, 5, 16, 0)


def test_complete_stream_equals_batch(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events*.parquet")
    query = (
        demand_by_window(as_trips(stream), EVENT_SPEC, late_after="10 minutes")
        .writeStream.format("memory").queryName("by_minute").outputMode("complete").start()
    )
    query.processAllAvailable()
    query.stop()
    static = demand_by_window(
        as_trips(events).withColumn("pickup_ts", F.col("pickup_ts").cast("timestamp")), EVENT_SPEC
    )
    streamed = spark.table("by_minute")
    assert streamed.exceptAll(static).isEmpty() and static.exceptAll(streamed).isEmpty()


def _deliver(spark, folder, *minutes):
    rows = [(1, START + timedelta(minutes=m), 1.0, 7) for m in minutes]
    spark.createDataFrame(rows, TRIP_DDL).coalesce(1).write.mode("append").parquet(folder)


def _run(spark, source, out, state):
    stream = spark.readStream.schema(TRIP_DDL).parquet(source)
    start_demand_stream(stream, out, state, trigger={"availableNow": True}).awaitTermination()


def test_closed_windows_are_written_once_and_late_trips_dropped(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    _deliver(spark, source, 0, 0, 5, 30)
    _run(spark, source, out, state)
    assert found(spark.read.parquet(out).select("window.start", "trip_count")) == [
        (START, 2), (START + timedelta(minutes=5), 1),
    ]
    _deliver(spark, source, 1, 25, 60)
    _run(spark, source, out, state)
    written = {r.start: r.trip_count for r in spark.read.parquet(out).select("window.start", "trip_count").collect()}
    assert written == {START: 2, START + timedelta(minutes=5): 1, START + timedelta(minutes=25): 1, START + timedelta(minutes=30): 1}


def test_stream_output_merges_with_batch(spark, tmp_path):
    source, out, state, batch = (f"{tmp_path}/{n}" for n in ("in", "out", "state", "batch"))
    _deliver(spark, source, 0, 1, 2, 59)
    _run(spark, source, out, state)
    day = START.date()
    spark.createDataFrame([(day, 16, 7, 10, 5.0)], DEMAND_DDL).write.parquet(batch)
    assert found(load_demand(spark, batch, out)) == [(day, 16, 7, 13, 8.0)]
    assert found(load_demand(spark, None, out)) == [(day, 16, 7, 3, 3.0)]


def test_stream_output_has_date_folders_that_prune(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    _deliver(spark, source, 0, 1, 2, 24 * 60, 48 * 60)
    _run(spark, source, out, state)
    folders = sorted(p.name for p in Path(out).glob("window_date=*"))
    assert len(folders) == 2 and all(len(list((Path(out) / f).glob("*.parquet"))) == 1 for f in folders)
    second = START.date() + timedelta(days=1)
    some = load_demand(spark, None, out, first_date=second)
    assert {r.date_str for r in some.collect()} == {second}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan


def test_minutes_sum_to_the_hour(spark, sf_dir):
    trips = as_trips(table(spark, sf_dir, "events"))
    rolled = merge_demand(None, demand_by_window(trips, EVENT_SPEC))
    hourly = demand_from_trips(trips, EVENT_SPEC)
    assert rolled.exceptAll(hourly).isEmpty() and hourly.exceptAll(rolled).isEmpty()


def _late(spark, source, out, late, **options):
    return append_late_windows(spark.read.schema(options.pop("schema", TRIP_DDL)).parquet(source), out, late, **options)


def test_trips_that_came_too_late_are_found_once(spark, tmp_path):
    source, out, state, late = (f"{tmp_path}/{n}" for n in ("in", "out", "state", "late"))
    assert _late_absent(spark, tmp_path) == (0, 0)
    _deliver(spark, source, 0, 0, 5, 30)
    _run(spark, source, out, state)
    assert _late(spark, source, out, late) == (0, 0)
    _deliver(spark, source, 0, 1, 1, 25, 60)  # minutes 0 and 1 are closed by now
    _run(spark, source, out, state)
    assert _late(spark, source, out, late) == (2, 3)
    assert _late(spark, source, out, late) == (0, 0)
    both = spark.read.parquet(out).unionByName(spark.read.parquet(late))
    static = demand_by_window(spark.read.parquet(source))
    want = static.where(F.col("window.end") <= START + timedelta(minutes=31)).selectExpr("cast(window.start as timestamp) s", "trip_count", "avg_distance")
    got = both.groupBy("window", "pickup_hour", "PULocationID").agg(F.sum("trip_count").alias("n"), F.sum("avg_distance").alias("d"))
    assert found(got.selectExpr("window.start", "n", "d")) == found(want)


def _late_absent(spark, tmp_path):
    trips = spark.createDataFrame([], TRIP_DDL)
    return append_late_windows(trips, f"{tmp_path}/no-stream", f"{tmp_path}/no-late")


def test_a_trip_sent_twice_counts_once(spark, tmp_path):
    source, out, state, late = (f"{tmp_path}/{n}" for n in ("in", "out", "state", "late"))
    ddl = TRIP_DDL + ", trip string"
    rows = [(1, START + timedelta(minutes=m), 1.0, 7, k) for m, k in ((0, "a"), (0, "a"), (0, "b"), (1, "c"), (1, None), (40, "d"))]

    def run(part):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ddl).parquet(source)
        start_demand_stream(stream, out, state, trigger={"availableNow": True}, trip_id="trip").awaitTermination()

    run(rows[:4])
    run(rows[2:])  # b and c come again, in another batch
    written = {r.start: r.trip_count for r in spark.read.parquet(out).select("window.start", "trip_count").collect()}
    assert written == {START: 2, START + timedelta(minutes=1): 1}
    assert _late(spark, source, out, late, schema=ddl, trip_id="trip") == (0, 0)
    assert unique_trips(spark.read.schema(ddl).parquet(source), "trip").count() == 4


def test_more_partitions_are_written_by_more_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        _deliver(spark, f"{tmp_path}/in", *range(0, 600, 3))
        _run(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert 1 < len(list(Path(f"{tmp_path}/out").glob("*/*.parquet"))) <= 8
