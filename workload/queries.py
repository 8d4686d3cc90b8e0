"""Registered queries: every operator over whole given tables.

Sums of distances are exact decimals until the end, so that the result does
not depend on the order of additions.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbflow import operators as ops
from curbflow import sources
from curbflow.functions import cache_key, window_label, window_start_date
from curbflow.functions.text import UNKNOWN
from curbflow.plans import merge_increment, run_etl, run_scoring, train_demand_model
from curbflow.session import scratch_path
from curbflow.spec import DEMAND_COLS, DEMAND_KEYS, FEATURES, HOUR_ZONE_FEATURES, WINDOW_DATE, ZONE_COLS, ZONE_KEY, require_columns
from curbflow.streaming import append_late_windows, start_demand_stream
from workload import tables as t

ROUNDS = 100
# With one feature and room for a leaf per value the first tree holds the training mean of
# each value, and the later ones add nothing: SQL can repeat such a model.
WEEKDAY, WEEKDAY_DEPTH = ("day_of_week",), 6
HOUR_DEPTH = 23
# Rounds and depth that the SQL of the five-feature model repeats.
SQL_ROUNDS, SQL_DEPTH = 3, 3
SEARCH = "nation_1"
BOROUGH = "asia"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _plain(df: DataFrame) -> DataFrame:
    """``avg_distance`` as a double, once all sums are done."""
    return df.withColumn("avg_distance", F.col("avg_distance").cast("double"))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.demand_from_trips(t.trips(spark, sf_dir), t.EVENT_SPEC)


# --- trips -------------------------------------------------------------


@query
def scan_trips(spark, sf_dir):
    return sources.read_trips(spark, [f"{sf_dir}/lineitem*.parquet"], t.LINE_SPEC)


@query
def scan_unlike_types(spark, sf_dir):
    """The scan over files whose columns differ in type."""
    path = scratch_path(spark, "unlike")
    t.unlike_lines(spark, sf_dir, path)
    return sources.read_trips(spark, [f"{path}/kind*/*.parquet"], t.LINE_SPEC)


@query
def demand_unlike_types(spark, sf_dir):
    """Demand of such files."""
    path = scratch_path(spark, "unlike")
    t.unlike_lines(spark, sf_dir, path)
    return ops.demand_from_trips(sources.read_trips(spark, [f"{path}/kind*"], t.LINE_SPEC), t.LINE_SPEC)


@query
def explore_types(spark, sf_dir):
    """Names and types of a table, as its exploration returns them."""
    return sources.explore(spark, f"{sf_dir}/events.parquet", show=False)[0].select("column_name", "data_type")


@query
def explore_rows(spark, sf_dir):
    """The first rows of a table, as its exploration returns them."""
    return sources.explore(spark, f"{sf_dir}/events.parquet", order_by=["ts", "event_id"], show=False)[1]


@query
def preview_head(spark, sf_dir):
    return sources.preview(t.table(spark, sf_dir, "events"), 5, ["ts", "event_id"])


@query
def clean_trips(spark, sf_dir):
    return _with_double(ops.clean_trips(t.trips(spark, sf_dir), t.EVENT_SPEC))


@query
def trip_features(spark, sf_dir):
    clean = ops.clean_trips(t.trips(spark, sf_dir), t.EVENT_SPEC)
    return _with_double(ops.add_trip_features(clean, t.EVENT_SPEC))


def _with_double(trips: DataFrame) -> DataFrame:
    return trips.withColumn("trip_distance", F.col("trip_distance").cast("double"))


@query
def quality_report(spark, sf_dir):
    return ops.quality_report(ops.audited_demand(t.trips(spark, sf_dir), t.EVENT_SPEC))


# --- demand ------------------------------------------------------------


@query
def demand_hourly(spark, sf_dir):
    return _plain(_hourly(spark, sf_dir))


@query
def demand_lineitem(spark, sf_dir):
    trips = sources.read_trips(spark, f"{sf_dir}/lineitem.parquet", t.LINE_SPEC)
    return ops.demand_from_trips(trips, t.LINE_SPEC)


@query
def demand_audited(spark, sf_dir):
    return _plain(ops.audited_demand(t.trips(spark, sf_dir), t.EVENT_SPEC))


@query
def demand_1min(spark, sf_dir):
    windows = ops.demand_by_window(t.trips(spark, sf_dir), t.EVENT_SPEC)
    return _plain(_labelled(windows))


def _labelled(windows: DataFrame) -> DataFrame:
    return windows.withColumn("window", window_label(F.col("window")))


@query
def demand_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "demand")
    sources.write_demand(_hourly(spark, sf_dir), path)
    return _plain(sources.read_demand(spark, path))


@query
def demand_etl(spark, sf_dir):
    """The whole job from files to a written table."""
    path = scratch_path(spark, "etl")
    run_etl(spark, f"{sf_dir}/lineitem.parquet", path, t.LINE_SPEC)
    return sources.read_demand(spark, path)


@query
def demand_etl_periods(spark, sf_dir):
    """The job over two overlapping ranges of dates, in place of a table with a day's shift: equal to one run over all."""
    path, source = scratch_path(spark, "periods"), f"{sf_dir}/lineitem.parquet"
    first, last = sources.read_trips(spark, source, t.LINE_SPEC).agg(
        F.min(F.col("l_shipdate").cast("date")), F.max(F.col("l_shipdate").cast("date"))
    ).first()
    stale = ops.demand_from_trips(sources.read_trips(spark, source, t.LINE_SPEC), t.LINE_SPEC)
    sources.write_demand(stale.withColumn("date_str", F.date_add("date_str", 1)), path)
    middle = first + (last - first) / 2
    for start, end in ((middle - timedelta(days=90), last + timedelta(days=1)), (first, middle)):
        run_etl(spark, source, path, t.LINE_SPEC, first_date=start, last_date=end)
    return sources.read_demand(spark, path)


@query
def demand_period_again(spark, sf_dir):
    """Ten days of the table made again from the batch trips alone; the other days stay as they were."""
    path, everything, batch = (scratch_path(spark, name) for name in ("again", "trips", "trips-batch"))
    t.trips(spark, sf_dir).write.parquet(everything)
    t.batch_trips(spark, sf_dir).write.parquet(batch)
    run_etl(spark, everything, path, t.EVENT_SPEC)
    run_etl(spark, batch, path, t.EVENT_SPEC, first_date=date(2024, 1, 11), last_date=date(2024, 1, 20))
    return _plain(sources.read_demand(spark, path))


@query
def demand_range(spark, sf_dir):
    """A range of dates read from a written table: other months' folders are skipped."""
    path = scratch_path(spark, "range")
    run_etl(spark, f"{sf_dir}/lineitem.parquet", path, t.LINE_SPEC, audit=False)
    return sources.read_demand(spark, path, date(1996, 2, 10), date(1997, 2, 9))


@query
def demand_one_file(spark, sf_dir):
    """Demand of the events in the layout without folders."""
    path = scratch_path(spark, "one-file")
    sources.write_demand(_hourly(spark, sf_dir), path, files=1)
    return _plain(sources.read_demand(spark, path))


@query
def explore_schema(spark, sf_dir):
    """Names and types of a table, as the exploration of one file shows them."""
    fields = t.table(spark, sf_dir, "events").schema.fields
    rows = t.table(spark, sf_dir, "events").agg(*[F.count(f.name).alias(f.name) for f in fields])
    pairs = [F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("filled")) for f in fields]
    return rows.select(F.explode(F.array(*pairs)).alias("c")).select("c.*")


@query
def required_columns(spark, sf_dir):
    """Demand of the events behind the check of its columns, and which of the columns a raw table lacks."""
    demand, raw = _hourly(spark, sf_dir), t.trips(spark, sf_dir)
    require_columns(demand, DEMAND_COLS)
    lacking = []
    for column in DEMAND_COLS:
        try:
            require_columns(raw, [column])
        except ValueError:
            lacking.append(column)
    return _plain(demand).withColumn("lacking", F.lit(",".join(lacking)))


@query
def demand_stream(spark, sf_dir):
    """Structured Streaming over the events until all input is read: the windows closed by then."""
    events = spark.readStream.schema(t.table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events*.parquet")
    out = scratch_path(spark, "stream")
    start_demand_stream(
        t.as_trips(events), out, scratch_path(spark, "stream-state"), t.EVENT_SPEC,
        trigger={"availableNow": True},
    ).awaitTermination()
    return _plain(_labelled(spark.read.parquet(out).drop(WINDOW_DATE)))


@query
def demand_stream_late(spark, sf_dir):
    """A stream whose second half comes too late, and the windows found for it afterwards: together, all closed windows."""
    source, out, late, state = (scratch_path(spark, f"stream-{name}") for name in ("in", "out", "late", "state"))
    events = t.table(spark, sf_dir, "events")
    for part in (F.dayofmonth("ts") > 15, F.dayofmonth("ts") <= 15):
        events.where(part).write.mode("append").parquet(source)
        trips = t.as_trips(spark.readStream.schema(events.schema).parquet(source))
        start_demand_stream(trips, out, state, t.EVENT_SPEC, trigger={"availableNow": True}).awaitTermination()
    for _ in range(2):  # the second time there is nothing left to add
        append_late_windows(t.trips(spark, sf_dir), out, late, t.EVENT_SPEC)
    both = spark.read.parquet(out).unionByName(spark.read.parquet(late))
    return _plain(_labelled(both.drop(WINDOW_DATE)))


@query
def demand_stream_repeats(spark, sf_dir):
    """A stream in which every trip is sent twice."""
    source = scratch_path(spark, "stream-in")
    events = t.table(spark, sf_dir, "events")
    events.unionByName(events).write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    out = scratch_path(spark, "stream-out")
    start_demand_stream(
        t.as_trips(stream, "event_id"), out, scratch_path(spark, "stream-state"), t.EVENT_SPEC, trigger={"availableNow": True}, trip_id="event_id"
    ).awaitTermination()
    return _plain(_labelled(spark.read.parquet(out).drop(WINDOW_DATE)))


# --- merging batch and streaming demand --------------------------------


@query
def window_label_date(spark, sf_dir):
    windows = ops.demand_by_window(t.trips(spark, sf_dir), t.EVENT_SPEC).select("window", "pickup_hour", ZONE_KEY)
    struct_type = windows.schema["window"].dataType
    text = _labelled(windows)
    return windows.select(
        window_label(F.col("window")).alias("window"), "pickup_hour", ZONE_KEY,
        window_start_date(F.col("window"), struct_type).alias("date_from_struct"),
        window_start_date(window_label(F.col("window")), text.schema["window"].dataType).alias("date_from_text"),
    )


@query
def stream_raw_demand(spark, sf_dir):
    return _plain(ops.normalize_stream_demand(t.labelled(t.trips(spark, sf_dir))))


@query
def stream_window_rollup(spark, sf_dir):
    """A lone streaming source of one-minute windows, summed to the hour."""
    return _plain(ops.merge_demand(None, ops.demand_by_window(t.trips(spark, sf_dir), t.EVENT_SPEC)))


@query
def demand_merge(spark, sf_dir):
    """Batch demand merged with one-minute streaming demand."""
    batch = ops.demand_from_trips(t.batch_trips(spark, sf_dir), t.EVENT_SPEC)
    stream = ops.demand_by_window(t.stream_trips(spark, sf_dir), t.EVENT_SPEC)
    return _plain(ops.merge_demand(batch, _labelled(stream)))


@query
def demand_merge_raw(spark, sf_dir):
    """Batch demand merged with raw streamed trips that carry a window label."""
    batch = ops.demand_from_trips(t.batch_trips(spark, sf_dir), t.EVENT_SPEC)
    return _plain(ops.merge_demand(batch, t.labelled(t.stream_trips(spark, sf_dir))))


@query
def demand_merge_files(spark, sf_dir):
    """The merge from written tables, and with the batch table alone where there is no stream."""
    batch_path, stream_path = scratch_path(spark, "batch"), scratch_path(spark, "stream")
    sources.write_demand(ops.demand_from_trips(t.batch_trips(spark, sf_dir), t.EVENT_SPEC), batch_path)
    windows = ops.demand_by_window(t.stream_trips(spark, sf_dir), t.EVENT_SPEC)
    windows.write.parquet(stream_path)
    both = sources.load_demand(spark, batch_path, stream_path)
    alone = sources.load_demand(spark, batch_path, f"{stream_path}-absent")
    return _plain(
        both.withColumn("origin", F.lit("both")).unionByName(alone.withColumn("origin", F.lit("batch")))
    )


@query
def demand_merge_increment(spark, sf_dir):
    """The merge kept up to date while the stream's table grows, late windows of past days included."""
    batch_path, stream_path, out = (scratch_path(spark, name) for name in ("batch", "stream", "merged"))
    sources.write_demand(ops.demand_from_trips(t.batch_trips(spark, sf_dir), t.EVENT_SPEC), batch_path)
    windows = ops.demand_by_window(t.stream_trips(spark, sf_dir), t.EVENT_SPEC).withColumn(WINDOW_DATE, F.col("window.start").cast("date"))
    early = (F.dayofmonth(WINDOW_DATE) <= 15) & (F.col(ZONE_KEY) % 3 != 0)
    for part in (early, ~early):
        windows.where(part).write.mode("append").partitionBy(WINDOW_DATE).parquet(stream_path)
        merge_increment(spark, batch_path, stream_path, out)
    return _plain(sources.read_demand(spark, out))


# --- zones -------------------------------------------------------------


@query
def zone_dim(spark, sf_dir):
    return t.zones(spark, sf_dir)


@query
def zone_file(spark, sf_dir):
    """The dimension loaded from a lookup file with a header."""
    path = scratch_path(spark, "zones")
    lines = t.zone_lines(spark, sf_dir).repartition(1).sortWithinPartitions("line", "location_id")
    lines.select(
        F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"),
        F.col("zone_name").alias("Zone"), "service_zone",
    ).write.csv(path, header=True, escape='"', quoteAll=True)
    return sources.load_zones(spark, path)


@query
def zones_by_borough(spark, sf_dir):
    return ops.list_zones(t.zones(spark, sf_dir), borough=BOROUGH)


@query
def zones_search(spark, sf_dir):
    return ops.list_zones(t.zones(spark, sf_dir), search=SEARCH)


@query
def zones_borough_and_search(spark, sf_dir):
    return ops.list_zones(t.zones(spark, sf_dir), borough=BOROUGH, search=SEARCH)


@query
def zone_counts(spark, sf_dir):
    return ops.zone_counts(t.zones(spark, sf_dir), search=SEARCH)


@query
def zone_lookup_ids(spark, sf_dir):
    """Zone rows for the zone of every event."""
    return ops.lookup_zones(t.trips(spark, sf_dir), t.zones(spark, sf_dir), "zone_id")


@query
def zone_lookup_large(spark, sf_dir):
    """The same with the dimension treated as too large to broadcast."""
    found = t.zones(spark, sf_dir).filter(F.col("zone_name") != UNKNOWN)
    wanted = t.trips(spark, sf_dir).select(F.col("zone_id").alias("location_id"))
    return ops.lookup_join(wanted, found, ["location_id"], "inner", max_rows=0).select(*ZONE_COLS)


@query
def zone_enrich(spark, sf_dir):
    return _plain(ops.enrich_with_zone(_hourly(spark, sf_dir), t.zones(spark, sf_dir), ZONE_KEY))


@query
def zone_enrich_large(spark, sf_dir):
    """The same with the dimension treated as too large to broadcast."""
    zones = t.zones(spark, sf_dir).withColumnRenamed("location_id", ZONE_KEY)
    joined = ops.lookup_join(_hourly(spark, sf_dir), zones, [ZONE_KEY], max_rows=0)
    return _plain(joined.fillna(UNKNOWN, list(ZONE_COLS[1:])))


# --- features and model ------------------------------------------------


@query
def date_features(spark, sf_dir):
    return _plain(ops.add_date_features(_hourly(spark, sf_dir)))


@query
def feature_matrix(spark, sf_dir):
    return ops.feature_matrix(ops.add_date_features(_hourly(spark, sf_dir)))


@query
def holdout_split(spark, sf_dir):
    demand = _hourly(spark, sf_dir).select(*DEMAND_KEYS, "trip_count")
    return demand.withColumn("is_train", ops.is_train_row().cast("int"))


@query
def holdout_exact(spark, sf_dir):
    """The hold-out part of exactly a fifth of the rows, rounded up."""
    train, test = ops.exact_holdout(_hourly(spark, sf_dir).select(*DEMAND_KEYS, "trip_count"))
    return train.withColumn("is_train", F.lit(1)).unionByName(test.withColumn("is_train", F.lit(0)))


@query
def target_stats(spark, sf_dir):
    return ops.target_stats(_hourly(spark, sf_dir))


@query
def regression_metrics(spark, sf_dir):
    """Error of the training part's zone-hour mean on the hold-out part.

    The means come from a window over the few rows of a zone-hour (one per
    date), so demand is computed once instead of once per part.
    """
    train = ops.is_train_row()
    zone_hour = Window.partitionBy("pickup_hour", ZONE_KEY)
    scored = _hourly(spark, sf_dir).withColumn(
        "prediction", F.avg(F.when(train, F.col("trip_count"))).over(zone_hour)
    )
    metrics = ops.regression_metrics(scored.filter(~train & F.col("prediction").isNotNull()))
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


def _trained(spark: SparkSession, sf_dir: str, features=FEATURES, rounds: int = ROUNDS, **options) -> tuple[PipelineModel, DataFrame]:
    """A model of the events' own demand, and the hold-out part with its predictions."""
    train, test = ops.holdout_split(ops.add_date_features(_hourly(spark, sf_dir)))
    model = ops.fit_demand_model(train, features, rounds=rounds, **options)
    return model, model.transform(test).select(*dict.fromkeys([*DEMAND_KEYS, *FEATURES]), "trip_count", "prediction")


def _rounded(scored: DataFrame, *columns: str) -> DataFrame:
    return scored.withColumns({c: F.round(c, 6) for c in columns})


@query
def demand_model(spark, sf_dir):
    """Error on the hold-out part."""
    return ops.regression_metrics(_trained(spark, sf_dir)[1])


@query
def demand_model_features(spark, sf_dir):
    """Hold-out predictions of a few rounds over all five features, which SQL fits again."""
    scored = _trained(spark, sf_dir, rounds=SQL_ROUNDS, depth=SQL_DEPTH)[1]
    return _rounded(scored.select(*DEMAND_KEYS, "trip_count", "prediction"), "prediction")


@query
def demand_model_nodes(spark, sf_dir):
    """Whether the table of nodes, joined to the hold-out rows, predicts what the model does."""
    model, scored = _trained(spark, sf_dir, rounds=20)
    again = ops.predict_by_nodes(scored.withColumnRenamed("prediction", "own"), ops.model_nodes(model), FEATURES, depth=6)
    return again.select(*DEMAND_KEYS, "trip_count", (F.abs(F.col("own") - F.col("prediction")) < 1e-9).alias("same"))


@query
def demand_model_weekday(spark, sf_dir):
    """Hold-out predictions of a model of the weekday alone."""
    scored = _trained(spark, sf_dir, WEEKDAY, depth=WEEKDAY_DEPTH)[1]
    return _rounded(scored.select(*DEMAND_KEYS, "trip_count", "prediction"), "prediction")


@query
def demand_model_error(spark, sf_dir):
    """Error of that model on the hold-out part, as the training job reports it."""
    demand = _hourly(spark, sf_dir)
    result = train_demand_model(demand, WEEKDAY, rounds=ROUNDS, depth=WEEKDAY_DEPTH)
    row = {**result.stats.asDict(), **result.metrics.asDict()}
    frame = spark.createDataFrame([tuple(row.values())], list(row))
    return _rounded(frame, "rmse", "mae", "mean_target")


@query
def demand_model_hour_zone(spark, sf_dir):
    """The older model, which knows hour and zone only, on a target that depends on the hour."""
    demand = ops.add_date_features(_hourly(spark, sf_dir)).withColumn("level", 20 + F.abs(12 - F.col("pickup_hour")))
    train, test = ops.holdout_split(demand)
    model = ops.fit_demand_model(train, HOUR_ZONE_FEATURES, target="level", rounds=ROUNDS, depth=HOUR_DEPTH)
    return _rounded(model.transform(test), "prediction").select(*DEMAND_KEYS, "level", "prediction")


@query
def model_roundtrip(spark, sf_dir):
    """Whether a model that was saved and loaded again predicts the same for each key."""
    path = scratch_path(spark, "model")
    fresh = train_demand_model(
        _hourly(spark, sf_dir), WEEKDAY, model_path=path, rounds=ROUNDS, depth=WEEKDAY_DEPTH
    ).model
    demand = ops.add_date_features(_hourly(spark, sf_dir)).select(*DEMAND_KEYS, *FEATURES[:1], "trip_count")
    both = ops.load_model(path).transform(fresh.transform(demand).withColumnRenamed("prediction", "before").drop("features"))
    return both.select(*DEMAND_KEYS, "trip_count", (F.col("before") == F.col("prediction")).alias("same"))


@query
def model_published(spark, sf_dir):
    """Hold-out predictions of the current version, after an older one was replaced, with what is stored about it."""
    path = scratch_path(spark, "published")
    demand = _hourly(spark, sf_dir)
    train_demand_model(demand.withColumn("trip_count", F.col("trip_count") + 7), WEEKDAY, model_path=path, rounds=2, depth=WEEKDAY_DEPTH)
    train_demand_model(demand, WEEKDAY, model_path=path, rounds=2, depth=WEEKDAY_DEPTH)
    about = ops.model_versions(path)[-1]
    test = ops.holdout_split(ops.add_date_features(demand))[1]
    scored = ops.load_model(path).transform(test).select(*DEMAND_KEYS, "trip_count", "prediction")
    return _rounded(scored, "prediction").withColumns({
        "version": F.lit(about["version"]), "last_date": F.lit(about["about"]["last_date"]).cast("date"), "samples": F.lit(about["about"]["samples"]).cast("bigint"),
    })


# --- scoring -----------------------------------------------------------


@query
def score_validate(spark, sf_dir):
    return ops.validate_requests(t.requests(spark, sf_dir))


@query
def cache_lookup(spark, sf_dir):
    requests = t.requests(spark, sf_dir)
    probed = ops.probe_cache(requests, t.stored_predictions(spark, sf_dir), t.NOW)
    return probed.withColumn("key", cache_key(F.col("zone"), F.col("hour"), F.col("date")))


@query
def cache_lookup_large(spark, sf_dir):
    """The same with the stored predictions treated as too many to broadcast."""
    fresh = ops.fresh_predictions(t.stored_predictions(spark, sf_dir), t.NOW)
    probed = ops.lookup_join(t.requests(spark, sf_dir), fresh, ["zone", "hour", "date"], max_rows=0)
    source = F.when(F.col("cached").isNull(), "model_inference").otherwise("cache_redis")
    return probed.withColumn("source", source).withColumn("key", cache_key(F.col("zone"), F.col("hour"), F.col("date")))


@query
def cache_expired(spark, sf_dir):
    """The table of predictions after its old entries were dropped."""
    store = scratch_path(spark, "expiring")
    sources.append_predictions(t.stored_predictions(spark, sf_dir), store)
    sources.expire_predictions(spark, store, t.NOW)
    return sources.stored_predictions(spark, store).select("zone", "hour", "date", "prediction")


@query
def cache_batches(spark, sf_dir):
    """The table after two appends, an expiry, a third append and a second expiry: what of all three is alive."""
    store = scratch_path(spark, "batches")
    entries = t.stored_predictions(spark, sf_dir)
    sources.append_predictions(entries.where("zone % 2 = 0"), store)
    sources.append_predictions(entries.where("zone % 2 = 1 and hour < 12"), store)
    sources.expire_predictions(spark, store, t.NOW)
    sources.append_predictions(entries.where("zone % 2 = 1 and hour >= 12"), store)
    sources.expire_predictions(spark, store, t.NOW)
    return sources.stored_predictions(spark, store).select("zone", "hour", "date", "prediction")


def formula_model() -> PipelineModel:
    """A scorer whose predictions plain SQL can repeat."""
    statement = (
        "SELECT *, 20 + 15 * is_weekend + abs(12 - pickup_hour) + 0.125D * (PULocationID % 5)"
        " + day_of_week + month AS prediction FROM __THIS__"
    )
    return PipelineModel([SQLTransformer(statement=statement)])


@query
def score_requests(spark, sf_dir):
    return ops.score_requests(
        t.requests(spark, sf_dir), formula_model(), t.zones(spark, sf_dir),
        t.stored_predictions(spark, sf_dir), t.NOW, carry=["request_id"],
    )


@query
def cache_new_entries(spark, sf_dir):
    """What a scoring run adds to the stored predictions."""
    scored = ops.score_all(
        t.requests(spark, sf_dir), formula_model(), None, t.stored_predictions(spark, sf_dir), t.NOW
    )
    return ops.cache_entries(scored, t.NOW).drop("cached_at")


def _scoring_job(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Run the whole job on written predictions; paths of the responses and of the predictions."""
    out, store = scratch_path(spark, "responses"), scratch_path(spark, "predictions")
    sources.append_predictions(t.stored_predictions(spark, sf_dir), store)
    run_scoring(
        spark, t.requests(spark, sf_dir), formula_model(), t.zones(spark, sf_dir), out, t.NOW, cache_path=store
    )
    return out, store


@query
def score_job(spark, sf_dir):
    return spark.read.parquet(_scoring_job(spark, sf_dir)[0])


@query
def cache_after_scoring(spark, sf_dir):
    """The prediction table once a scoring run has added to it."""
    return sources.read_predictions(spark, _scoring_job(spark, sf_dir)[1], t.NOW).drop("cached_at")


@query
def score_requests_trees(spark, sf_dir):
    """Requests scored by boosted trees fitted on the events' own demand."""
    model, _ = _trained(spark, sf_dir, WEEKDAY, depth=WEEKDAY_DEPTH)
    return ops.score_requests(
        t.requests(spark, sf_dir), model, t.zones(spark, sf_dir),
        t.stored_predictions(spark, sf_dir), t.NOW, carry=["request_id"],
    )


