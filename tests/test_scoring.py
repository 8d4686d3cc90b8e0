"""Request checks, the prediction cache and responses."""

from datetime import datetime, timedelta

import pytest
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from curbflow.functions import cache_key
from curbflow.operators import (
    add_date_features,
    cache_entries,
    demand_from_trips,
    fit_demand_model,
    probe_cache,
    score_all,
    score_requests,
    validate_requests,
)
from curbflow.plans import run_scoring
from curbflow.sources import read_predictions
from curbflow.spec import FEATURES, HOUR_ZONE_FEATURES, RESPONSE_COLS
from test_trips_and_demand import found
from workload.tables import EVENT_SPEC, trips
from workload.tables import requests as event_requests

NOW = datetime(2025, 1, 5, 12, 0)
REQUEST_DDL = "zone int, hour int, date string"
CACHE_DDL = "zone int, hour int, date string, prediction double, cached_at timestamp"


@pytest.fixture(scope="module")
def model(spark):
    return SQLTransformer(statement="SELECT *, PULocationID + pickup_hour / 100 + 0.0078125D AS prediction FROM __THIS__")


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), REQUEST_DDL)


def cache(spark, *rows):
    return spark.createDataFrame(
        [(z, h, d, p, NOW - timedelta(seconds=age)) for z, h, d, p, age in rows], CACHE_DDL
    )


def test_reject_reasons(spark):
    good = "2025-01-05"
    cases = {
        (1, 0, good): None, (1, 23, good): None, (0, 0, good): "bad_zone", (None, 0, good): "bad_zone",
        (1, 24, good): "bad_hour", (1, -1, good): "bad_hour", (1, None, good): "bad_hour",
        (1, 0, "2025-02-30"): "bad_date", (1, 0, "20250105"): "bad_date", (1, 0, ""): "bad_date",
        (1, 0, "2025-1-5"): "bad_date", (1, 0, " 2025-01-05"): "bad_date", (1, 0, None): "bad_date",
        (0, 99, "x"): "bad_zone",
    }
    rows = validate_requests(requests(spark, *cases)).collect()
    assert {tuple(r)[:3]: r.reject_reason for r in rows} == cases


def test_entries_live_less_than_ten_minutes_and_the_newest_counts(spark):
    stored = cache(
        spark, (1, 1, "d", 5.0, 599), (2, 1, "d", 6.0, 600), (3, 1, "d", 7.0, 100), (3, 1, "d", 8.0, 50),
        (4, 1, "d", 9.0, 10), (4, 1, "d", 9.5, 10),
    )
    asked = requests(spark, *[(z, 1, "d") for z in (1, 2, 3, 4, 5)])
    got = {r.zone: (r.cached, r.source) for r in probe_cache(asked, stored, NOW).collect()}
    assert got == {
        1: (5.0, "cache_redis"), 2: (None, "model_inference"), 3: (8.0, "cache_redis"),
        4: (9.5, "cache_redis"), 5: (None, "model_inference"),
    }


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_now_may_be_a_column_and_times_may_lack_a_zone(spark, kind):
    stored = cache(spark, (1, 1, "d", 5.0, 599)).withColumn("cached_at", F.col("cached_at").cast(kind))
    asked = requests(spark, (1, 1, "d"))
    assert probe_cache(asked, stored, F.lit("2025-01-05 12:00:00")).first()["cached"] == 5.0


def test_the_date_takes_part_as_text(spark):
    stored = cache(spark, (1, 1, "2025-1-5", 5.0, 1))
    assert probe_cache(requests(spark, (1, 1, "2025-01-05")), stored, NOW).first()["cached"] is None


def test_cache_key_text(spark):
    df = requests(spark, (42, 18, "2025-01-15"))
    assert df.select(cache_key(F.col("zone"), F.col("hour"), F.col("date"))).first()[0] == "demand:42:18:2025-01-15"


def test_response_has_the_contract_columns_and_both_sources(spark, model):
    zones = spark.createDataFrame(
        [(1, "Park", "Queens", "Boro Zone")], "location_id int, zone_name string, borough string, service_zone string"
    )
    asked = requests(spark, (1, 5, "2025-01-05"), (2, 5, "2025-01-06"), (2, 5, "2025-01-06"), (0, 5, "2025-01-06"))
    stored = cache(spark, (1, 5, "2025-01-05", 3.14159, 5))
    got = score_requests(asked, model, zones, stored, NOW)
    assert tuple(got.columns) == RESPONSE_COLS
    unknown = ("Unknown",) * 3
    miss = ("model_inference", 2, *unknown, 5, "2025-01-06", 0, 1, False, 2.06)
    assert found(got) == [
        ("cache_redis", 1, "Park", "Queens", "Boro Zone", 5, "2025-01-05", 6, 1, True, 3.14159), miss, miss,
    ]


def test_entries_from_the_future_are_misses(spark, model):
    asked = requests(spark, (1, 5, "2025-01-05"))
    assert score_requests(asked, model, None, cache(spark, (1, 5, "2025-01-05", 3.0, -1)), NOW).first().source == "model_inference"
    assert score_requests(asked, model, None, cache(spark, (1, 5, "2025-01-05", 3.0, 0)), NOW).first().source == "cache_redis"


def test_new_entries_are_unrounded_one_per_missed_key(spark, model):
    asked = requests(spark, (1, 5, "2025-01-05"), (2, 5, "2025-01-06"), (2, 5, "2025-01-06"))
    scored = score_all(asked, model, None, cache(spark, (1, 5, "2025-01-05", 3.0, 5)), NOW)
    assert found(cache_entries(scored, NOW)) == [(2, 5, "2025-01-06", 2.0578125, NOW)]


def test_scoring_run_fills_and_reuses_the_table(spark, model, tmp_path):
    asked = requests(spark, (1, 5, "2025-01-05"), (2, 5, "2025-01-06"))
    out, store = f"{tmp_path}/out", f"{tmp_path}/store"

    def run(now):
        run_scoring(spark, asked, model, None, out, now, store)
        return {(r.source, r.predicted_demand) for r in spark.read.parquet(out).collect()}

    assert run(NOW) == {("model_inference", 1.06), ("model_inference", 2.06)}
    assert run(NOW + timedelta(seconds=599)) == {("cache_redis", 1.0578125), ("cache_redis", 2.0578125)}
    assert run(NOW + timedelta(seconds=600)) == {("model_inference", 1.06), ("model_inference", 2.06)}
    assert read_predictions(spark, store, NOW).count() == 4
    run_scoring(spark, asked, model, None, out, NOW)
    assert spark.read.parquet(out).count() == 2


def test_model_runs_on_misses_only(spark, model):
    """The choice of prediction and the model end up in one projection."""
    plan = score_requests(
        requests(spark, (1, 5, "2025-01-05")), model, None, cache(spark, (1, 5, "2025-01-05", 3.0, 5)), NOW
    )._jdf.queryExecution().executedPlan().toString()
    assert "coalesce(cached" in plan and "BroadcastHashJoin" in plan
    assert " AS prediction" not in plan.split("BroadcastHashJoin")[0]


def test_trees_get_the_features_of_the_request_in_their_order(spark, sf_dir):
    """Each response against the tree model called by hand, on every valid request."""
    train = add_date_features(demand_from_trips(trips(spark, sf_dir), EVENT_SPEC))
    for features in (FEATURES, HOUR_ZONE_FEATURES):
        trees = fit_demand_model(train, features, rounds=2)
        asked = event_requests(spark, sf_dir)
        rows = score_requests(asked, trees, None, None, NOW).distinct().collect()
        assert len(rows) > 100
        for row in rows:
            day = datetime.fromisoformat(row.date)
            known = {
                "day_of_week": day.weekday(), "month": day.month, "is_weekend": int(day.weekday() >= 5),
                "pickup_hour": row.hour, "PULocationID": row.zone,
            }
            by_hand = trees.stages[-1].predict(Vectors.dense([known[f] for f in features]))
            assert row.predicted_demand == pytest.approx(by_hand, abs=0.00501)
            assert (row.day_of_week, row.month, row.is_weekend) == (day.weekday(), day.month, day.weekday() >= 5)
