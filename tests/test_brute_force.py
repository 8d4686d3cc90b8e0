"""Random small tables against the same rules spelled out in plain Python."""

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curbflow.operators import audited_demand, demand_from_trips, merge_demand, normalize_stream_demand, quality_report
from test_trips_and_demand import DEMAND_DDL, TRIP_DDL

START = datetime(2024, 2, 28, 22)
SEEDS = (1, 2, 3)


def maybe(rng, value, share=0.1):
    return None if rng.random() < share else value


def random_trips(rng, n=400):
    """Distances in quarters, so that sums are exact in any order."""
    return [
        (
            maybe(rng, rng.randrange(3)), maybe(rng, START + timedelta(minutes=rng.randrange(400))),
            maybe(rng, float("nan") if rng.random() < 0.02 else rng.randrange(-4, 20) / 4), maybe(rng, rng.randrange(1, 5)),
        )
        for _ in range(n)
    ]


def random_demand(rng, n=200):
    return [
        (
            maybe(rng, START.date() + timedelta(days=rng.randrange(3))), maybe(rng, rng.randrange(3)),
            maybe(rng, rng.randrange(3)), maybe(rng, rng.randrange(9)),
            maybe(rng, float("nan") if rng.random() < 0.1 else rng.randrange(40) / 4),
        )
        for _ in range(n)
    ]


def missing(value):
    return value is None or (isinstance(value, float) and math.isnan(value))


def table(df):
    """Key to measures; NaN as text, because it differs from itself."""
    rows = df.collect()
    result = {tuple(r)[:3]: tuple("nan" if missing(v) else v for v in tuple(r)[3:]) for r in rows}
    assert len(result) == len(rows)
    return result


@pytest.mark.parametrize("seed", SEEDS)
def test_hourly_demand_and_audit(spark, seed):
    rows = random_trips(random.Random(seed))
    want, removed = defaultdict(lambda: [0, 0.0]), defaultdict(int)
    for vendor, ts, distance, zone in rows:
        if ts is None:
            removed["missing_time"] += 1
        elif distance is None or distance <= 0:
            removed["bad_distance"] += 1
        elif zone is None:
            removed["missing_zone"] += 1
        else:
            entry = want[(ts.date(), ts.hour, zone)]
            entry[0] += vendor is not None
            entry[1] += distance
    df = spark.createDataFrame(rows, TRIP_DDL).repartition(4)
    expected = {k: (n, "nan" if math.isnan(d) else d) for k, (n, d) in want.items()}
    assert table(demand_from_trips(df)) == expected
    report = quality_report(audited_demand(df)).first()
    assert {k: report[k] for k in removed} == dict(removed)
    assert report["removed_rows"] == sum(removed.values())
    assert report["demand_rows"] == len(want)
    assert report["input_rows"] == len(rows)


@pytest.mark.parametrize("seed", SEEDS)
def test_merge_sums_present_measures_of_full_keys(spark, seed):
    rng = random.Random(seed)
    sides = random_demand(rng), random_demand(rng)
    want = defaultdict(lambda: [0, 0.0])
    for *key, count, distance in sides[0] + sides[1]:
        if None not in key:
            entry = want[tuple(key)]
            entry[0] += 0 if missing(count) else count
            entry[1] += 0 if missing(distance) else distance
    batch, stream = (spark.createDataFrame(side, DEMAND_DDL).repartition(3) for side in sides)
    assert table(merge_demand(batch, stream)) == {k: tuple(v) for k, v in want.items()}


@pytest.mark.parametrize("seed", SEEDS)
def test_raw_stream_counts_distances_and_not_vendors(spark, seed):
    rows = random_trips(random.Random(seed))
    want = defaultdict(lambda: [0, 0.0])
    for _, ts, distance, zone in rows:
        if ts is not None and zone is not None:
            entry = want[(ts.date(), ts.hour, zone)]
            entry[0] += not missing(distance)
            entry[1] += 0 if missing(distance) else distance
    raw = spark.createDataFrame(rows, TRIP_DDL).select(
        F.col("tpep_pickup_datetime").cast("date").cast("string").alias("date_str"),
        F.hour("tpep_pickup_datetime").alias("pickup_hour"), "PULocationID", "trip_distance",
    )
    assert table(normalize_stream_demand(raw)) == {k: tuple(v) for k, v in want.items()}
