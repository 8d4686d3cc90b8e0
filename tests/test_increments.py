"""Merges kept up to date by files, and hold-outs of an exact size."""

import math
from datetime import date, datetime, timedelta
from glob import glob

import pytest
from pyspark.sql import functions as F

from curbflow import sources
from curbflow.operators import exact_holdout
from curbflow.plans import merge_increment
from curbflow.spec import WINDOW_DATE
from test_trips_and_demand import demand, found

DAYS = [date(2025, 1, 1) + timedelta(days=20 * i) for i in range(6)]  # January to April


def windows(spark, path, rows):
    schema = "window struct<start: timestamp, end: timestamp>, pickup_hour int, PULocationID int, trip_count long, avg_distance double"
    whole = [((datetime(d.year, d.month, d.day, h), datetime(d.year, d.month, d.day, h, 1)), h, z, n, x) for d, h, z, n, x in rows]
    frame = spark.createDataFrame(whole, schema).withColumn(WINDOW_DATE, F.col("window.start").cast("date"))
    frame.write.mode("append").partitionBy(WINDOW_DATE).parquet(path)


def full(spark, batch, stream):
    return found(sources.load_demand(spark, batch, stream))


def test_only_months_with_new_files_are_made_again(spark, tmp_path):
    batch, stream, out = (f"{tmp_path}/{n}" for n in ("batch", "stream", "out"))
    sources.write_demand(demand(spark, *[(d, 1, 1, 1, 1.0) for d in DAYS]), batch)
    assert merge_increment(spark, batch, stream, out) == [202501, 202502, 202503, 202504]
    assert found(sources.read_demand(spark, out)) == full(spark, batch, stream)
    assert merge_increment(spark, batch, stream, out) == []
    untouched = {p: open(p, "rb").read() for p in glob(f"{out}/demand_month=20250[24]/*.parquet")}
    windows(spark, stream, [(DAYS[0], 1, 1, 2, 2.0), (DAYS[3], 5, 2, 3, 3.0)])
    assert merge_increment(spark, batch, stream, out) == [202501, 202503]
    assert found(sources.read_demand(spark, out)) == full(spark, batch, stream)
    windows(spark, stream, [(DAYS[0], 1, 1, 4, 4.0)])  # late, for a day merged before
    assert merge_increment(spark, batch, stream, out) == [202501]
    assert found(sources.read_demand(spark, out)) == full(spark, batch, stream)
    assert {p: open(p, "rb").read() for p in glob(f"{out}/demand_month=20250[24]/*.parquet")} == untouched and untouched


def test_replaced_and_removed_batch_dates_reach_the_merge(spark, tmp_path):
    batch, stream, out = (f"{tmp_path}/{n}" for n in ("batch", "stream", "out"))
    sources.write_demand(demand(spark, *[(d, 1, 1, 1, 1.0) for d in DAYS]), batch)
    windows(spark, stream, [(DAYS[0], 1, 1, 2, 2.0)])
    merge_increment(spark, batch, stream, out)
    sources.replace_dates(demand(spark), batch, DAYS[3], DAYS[4])  # all of March
    sources.replace_dates(demand(spark, (DAYS[0], 9, 9, 9, 9.0)), batch, DAYS[0], DAYS[0])
    assert merge_increment(spark, batch, stream, out) == [202501, 202503]
    assert found(sources.read_demand(spark, out)) == full(spark, batch, stream)
    assert glob(f"{out}/demand_month=202503") == []


def test_a_merge_that_failed_is_made_again(spark, tmp_path, monkeypatch):
    from curbflow.plans import merging

    batch, out = f"{tmp_path}/batch", f"{tmp_path}/out"
    sources.write_demand(demand(spark, (DAYS[0], 1, 1, 1, 1.0)), batch)
    commit = merging.commit_next
    monkeypatch.setattr(merging, "commit_next", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        merge_increment(spark, batch, None, out)
    monkeypatch.setattr(merging, "commit_next", commit)
    assert merge_increment(spark, batch, None, out) == [202501]
    assert found(sources.read_demand(spark, out)) == [(DAYS[0], 1, 1, 1, 1.0)]


def test_sources_without_folders_are_merged_in_full(spark, tmp_path):
    batch, out = f"{tmp_path}/batch", f"{tmp_path}/out"
    sources.write_demand(demand(spark, *[(d, 1, 1, 1, 1.0) for d in DAYS]), batch, files=2)
    assert merge_increment(spark, batch, None, out) == [202501, 202502, 202503, 202504]
    sources.write_demand(demand(spark, (DAYS[1], 1, 1, 1, 1.0)), batch, files=1)
    merge_increment(spark, batch, None, out)
    assert found(sources.read_demand(spark, out)) == [(DAYS[1], 1, 1, 1, 1.0)]


@pytest.mark.parametrize("size,share", [(0, 0.2), (1, 0.2), (4, 0.2), (5, 0.2), (11, 0.2), (997, 0.2), (997, 0.0), (997, 1.0), (30, 0.1)])
def test_the_holdout_has_exactly_its_share(spark, size, share):
    rows = spark.range(size).select(F.lit("2025-01-01").alias("date_str"), F.lit(1).alias("pickup_hour"), F.col("id").alias("PULocationID"))
    train, test = exact_holdout(rows, test_share=share)
    held = {r.PULocationID for r in test.collect()}
    assert len(held) == math.ceil(round(share * size, 9)) and held | {r.PULocationID for r in train.collect()} == set(range(size))
    again = exact_holdout(rows.repartition(7), test_share=share)[1]
    assert {r.PULocationID for r in again.collect()} == held


def test_rows_of_one_key_stay_together(spark):
    rows = spark.createDataFrame([("2025-01-01", 1, i % 3) for i in range(30)], "date_str string, pickup_hour int, PULocationID int")
    train, test = exact_holdout(rows)
    assert test.select("PULocationID").distinct().count() == 1 and test.count() == 10 and train.count() == 20
