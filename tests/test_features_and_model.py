"""Calendar features, split, metrics and the fitted model."""

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbflow.operators import model as model_module
from curbflow.operators.model import combine_equal_rows
from curbflow.operators import (
    add_date_features,
    feature_matrix,
    fit_demand_model,
    holdout_split,
    is_train_row,
    load_model,
    model_features,
    model_nodes,
    predict_by_nodes,
    regression_metrics,
    save_model,
    target_stats,
)
from curbflow.plans import train_demand_model
from curbflow.spec import DEMAND_KEYS, FEATURES, HOUR_ZONE_FEATURES
from test_trips_and_demand import found


@pytest.fixture(scope="module")
def signal(spark):
    """Demand with a pattern: more at weekends, far from noon and in some zones."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / (24 * 20)).cast("int"))
    hour = (F.col("id") / 20 % 24).cast("int")
    zone = (F.col("id") % 20).cast("int")
    df = spark.range(60 * 24 * 20).select(day.alias("date_str"), hour.alias("pickup_hour"), zone.alias("PULocationID"))
    count = 20 + F.when(F.weekday("date_str") >= 5, 15).otherwise(0) + F.abs(12 - F.col("pickup_hour")) + 3 * (zone_of() % 5)
    return df.withColumn("trip_count", count.cast("bigint"))


def zone_of():
    return F.col("PULocationID")


def test_weekdays_count_from_monday_and_text_dates_parse(spark):
    df = spark.createDataFrame(
        [("2025-01-05",), ("2025-01-06 23:00:00",), ("2025-02-30",), (None,)], "date_str string"
    )
    assert found(add_date_features(df)) == sorted([
        (date(2025, 1, 5), 6, 1, 1), (date(2025, 1, 6), 0, 1, 0), (None, None, None, 0), (None, None, None, 0),
    ], key=str)


def test_date_features_accept_timestamps(spark):
    df = spark.createDataFrame([(datetime(2025, 3, 1, 12),)], "date_str timestamp_ntz")
    assert found(add_date_features(df)) == [(date(2025, 3, 1), 5, 3, 1)]


def test_feature_order_is_fixed_and_missing_columns_are_named(signal):
    matrix = feature_matrix(add_date_features(signal))
    assert matrix.columns == [*FEATURES, "trip_count"]
    with pytest.raises(ValueError, match="day_of_week"):
        feature_matrix(signal)


def test_split_is_stable_and_complete(signal):
    train, test = holdout_split(signal)
    assert train.count() + test.count() == signal.count()
    assert 0.78 < train.count() / signal.count() < 0.82
    moved = signal.repartition(5, "PULocationID").filter(is_train_row())
    assert moved.exceptAll(train).isEmpty() and train.exceptAll(moved).isEmpty()
    other = signal.filter(is_train_row(seed=7))
    assert not other.exceptAll(train).isEmpty()


def test_target_stats(spark):
    df = spark.createDataFrame([(1,), (5,), (6,)], "trip_count bigint")
    assert tuple(target_stats(df).first()) == (3, 1, 6, 4.0)


def test_metrics(spark):
    df = spark.createDataFrame([(1, 4.0), (5, 1.0)], "trip_count bigint, prediction double")
    row = regression_metrics(df).first()
    assert row["rmse"] == pytest.approx(12.5 ** 0.5) and row["mae"] == 3.5


@pytest.fixture(scope="module")
def trained(signal, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('model')}/m"
    return train_demand_model(signal, model_path=path, rounds=5), path


def test_model_beats_the_mean_on_demand_with_a_pattern(signal, trained):
    train, test = holdout_split(signal)
    mean = train.agg(F.avg("trip_count")).first()[0]
    naive = regression_metrics(test.withColumn("prediction", F.lit(mean))).first()["rmse"]
    assert trained[0].metrics["rmse"] < naive / 4
    assert trained[0].stats["samples"] == signal.count()


def test_merging_equal_rows_leaves_the_trees_as_they_are(signal, monkeypatch):
    """Noise on the target, so that rows with equal features differ."""
    noise = (F.xxhash64("date_str", "pickup_hour", "PULocationID") % 7).cast("bigint")
    rows = add_date_features(signal).withColumn("trip_count", F.col("trip_count") + noise)
    merged = fit_demand_model(rows, rounds=3)
    assert combine_equal_rows(rows, FEATURES).count() < rows.count() / 3
    monkeypatch.setattr(model_module, "combine_equal_rows", lambda df, features, target: df.select(
        *features, F.col(target).cast("double").alias(target), F.lit(1.0).alias("weight")
    ))
    plain = fit_demand_model(rows, rounds=3)
    pairs = merged.transform(rows).select(*DEMAND_KEYS, F.col("prediction").alias("p")).join(
        plain.transform(rows), list(DEMAND_KEYS)
    )
    assert pairs.filter(F.abs(F.col("p") - F.col("prediction")) > 1e-9).isEmpty()


def test_rows_without_a_date_do_not_stop_training(spark, signal):
    undated = signal.limit(5).withColumn("date_str", F.lit(None).cast("date"))
    result = train_demand_model(signal.unionByName(undated), rounds=1)
    assert result.stats["samples"] == signal.count() + 5
    assert result.metrics["rmse"] > 0


def test_same_seed_gives_the_same_metrics(signal, trained):
    again = train_demand_model(signal, rounds=5)
    assert again.metrics["rmse"] == pytest.approx(trained[0].metrics["rmse"], rel=1e-9)


def test_saved_model_predicts_the_same_and_knows_its_features(signal, trained):
    result, path = trained
    loaded = load_model(path)
    save_model(loaded, path)
    assert model_features(loaded) == list(FEATURES)
    rows = add_date_features(signal)
    pairs = loaded.transform(rows).select(*DEMAND_KEYS, F.col("prediction").alias("p")).join(
        result.model.transform(rows), list(DEMAND_KEYS)
    )
    assert pairs.filter(F.col("p") != F.col("prediction")).isEmpty()


def test_older_model_uses_hour_and_zone_only(signal):
    model = fit_demand_model(holdout_split(signal)[0], HOUR_ZONE_FEATURES, rounds=2)
    assert model_features(model) == ["pickup_hour", "PULocationID"]
    assert "prediction" in model.transform(signal).columns


def test_the_node_table_predicts_what_the_model_does(signal, trained):
    model = trained[0].model
    nodes = model_nodes(model)
    assert nodes.select("tree").distinct().count() == 5
    assert nodes.where("left is null and (feature is not null or threshold is not null)").isEmpty()
    rows = add_date_features(signal).unionByName(add_date_features(signal.limit(3)).withColumn("month", F.lit(None).cast("int")))
    pairs = predict_by_nodes(rows, nodes, FEATURES, depth=6)
    assert pairs.where("month is null and prediction is null").count() == 3
    own = model.transform(rows.dropna()).select(*DEMAND_KEYS, F.col("prediction").alias("p"))
    both = own.join(pairs.dropna(), list(DEMAND_KEYS))
    assert both.count() >= signal.count() and both.where(F.abs(F.col("p") - F.col("prediction")) > 1e-9).isEmpty()


def test_the_first_cut_is_the_best_of_all_cuts(signal):
    """The splits of a fit against a plain search over every cut of every feature, level by level."""
    rows = combine_equal_rows(add_date_features(signal).withColumn("trip_count", F.col("trip_count") + F.xxhash64("pickup_hour", "month") % 5), FEATURES)
    table = rows.toPandas()
    model = fit_demand_model(add_date_features(signal).withColumn("trip_count", F.col("trip_count") + F.xxhash64("pickup_hour", "month") % 5), rounds=1, depth=2)
    nodes = {r.node: r for r in model_nodes(model).collect()}

    def best(part):
        def spread(p):
            mean = np.average(p["trip_count"], weights=p["weight"])
            return float((p["weight"] * (p["trip_count"] - mean) ** 2).sum())

        found = []
        for feature in FEATURES:
            values = sorted(table[feature].unique())
            for low, high in zip(values, values[1:]):
                cut = (low + high) / 2
                left, right = part[part[feature] <= cut], part[part[feature] > cut]
                if len(left) and len(right):
                    found.append((spread(part) - spread(left) - spread(right), feature, cut))
        return max(found)[0], spread(part)

    def check(node, part):
        own = nodes[node]
        assert own.value == pytest.approx(np.average(part["trip_count"], weights=part["weight"]))
        if own.left is None:
            return
        left, right = part[part[own.feature] <= own.threshold], part[part[own.feature] > own.threshold]
        mean = lambda p: np.average(p["trip_count"], weights=p["weight"])
        fall = sum(float((p["weight"] * (p["trip_count"] - mean(p)) ** 2).sum()) for p in (left, right))
        gain, whole = best(part)
        assert whole - fall == pytest.approx(gain)
        check(own.left, left)
        check(own.right, right)

    check(0, table)


def test_fit_rows_take_tasks_by_their_number_not_the_shuffle(spark):
    rows = spark.createDataFrame([(h % 7, h % 24, float(h)) for h in range(500)], "day_of_week int, pickup_hour int, trip_count double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        held = model_module.fit_rows(rows, ["day_of_week", "pickup_hour"], "trip_count")
        try:
            assert held.rdd.getNumPartitions() == 1
            merged = combine_equal_rows(rows, ["day_of_week", "pickup_hour"], "trip_count")
            assert sorted(held.collect()) == sorted(merged.collect())
        finally:
            held.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
