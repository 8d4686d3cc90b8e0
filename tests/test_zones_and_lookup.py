"""Zone rules, and the lookup join on both sides of its size bound."""

import pytest
from pyspark.sql import functions as F

from curbflow.operators import enrich_with_zone, list_zones, lookup_join, lookup_zones, zone_counts, zone_dimension
from curbflow.operators.lookup import fits_broadcast, hot_keys
from test_trips_and_demand import found

DDL = "location_id int, zone_name string, borough string, service_zone string"


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(
        [(3, "100% Park", "Queens", "Boro Zone"), (1, "Park_Lane", "Manhattan", "Yellow Zone"),
         (2, "Parkway", "QUEENS", "Boro Zone"), (9, "Unknown", "Unknown", "Unknown")], DDL,
    )


def ids(df):
    return [r.location_id for r in df.collect()]


def test_listing_is_ordered_and_ignores_empty_tests(zones):
    assert ids(list_zones(zones)) == ids(list_zones(zones, "", "")) == [1, 2, 3, 9]


def test_borough_is_equal_without_case(zones):
    assert ids(list_zones(zones, borough="queens")) == [2, 3]
    assert ids(list_zones(zones, borough="queen")) == []


def test_search_is_a_literal_substring_without_case(zones):
    assert ids(list_zones(zones, search="PARK")) == [1, 2, 3]
    assert ids(list_zones(zones, search="%")) == [3]
    assert ids(list_zones(zones, search="k_l")) == [1]
    assert ids(list_zones(zones, "QUEENS", "0%")) == [3]


def test_counts(spark, zones):
    assert tuple(zone_counts(zones, "queens", "park").first()) == (2, 4, True)
    assert tuple(zone_counts(spark.createDataFrame([], DDL)).first()) == (0, 0, False)


def test_zones_named_unknown_are_not_found_by_id(spark, zones):
    wanted = spark.createDataFrame([(9,), (2,), (44,), (2,), (None,)], "location_id int")
    assert ids(lookup_zones(wanted, zones)) == [2, 2]


def test_dimension_fills_text_and_the_last_row_of_an_id_wins(spark):
    raw = spark.createDataFrame(
        [(1, "A", "n/a", None, 1), (1, "B", "", "x", 2), (None, "C", "c", "c", 3)], DDL + ", line int"
    )
    assert found(zone_dimension(raw, "line")) == [(1, "B", "Unknown", "x")]
    assert found(zone_dimension(raw.limit(1))) == [(1, "A", "Unknown", "Unknown")]


def test_enrichment_without_a_match_or_a_dimension_is_unknown(spark, zones):
    rows = spark.createDataFrame([(1, 2), (2, 5), (3, None)], "n int, PULocationID int")
    unknown = ("Unknown",) * 3
    assert found(enrich_with_zone(rows, zones, "PULocationID")) == [
        (1, 2, "Parkway", "QUEENS", "Boro Zone"), (2, 5, *unknown), (3, None, *unknown),
    ]
    assert found(enrich_with_zone(rows, None, "PULocationID"))[0] == (1, 2, *unknown)


def test_size_check_counts_rows_and_text(spark):
    assert fits_broadcast(spark.range(10), max_rows=10)
    assert not fits_broadcast(spark.range(11), max_rows=10)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert not fits_broadcast(wide, max_rows=10, max_bytes=5000)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a tenth have no key, some keys have no match."""
    n = F.col("id")
    return spark.range(30_000).select(
        n.alias("row"),
        F.when(n % 3 == 0, 7).when(n % 10 == 1, None).otherwise((n % 1201).cast("int")).alias("k"),
        F.when(n % 5 != 0, "a").alias("j"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(1100).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("j"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_large_lookup_equals_the_plain_join(skewed, dim, how, keys):
    facts = skewed if len(keys) == 2 else skewed.drop("j")
    side = dim if len(keys) == 2 else dim.drop("j")
    want = facts.join(side, keys, how)
    got = lookup_join(facts, side, keys, how, max_rows=50)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_keys_are_those_above_the_share(skewed):
    (hot,) = hot_keys(skewed, ["k"], 0.01).collect()
    assert hot.k == 7 and hot.share == pytest.approx(1 / 3, abs=0.01)
    assert hot_keys(skewed, ["k"], 0.5).isEmpty()


def test_hot_and_missing_keys_are_spread_over_tasks(spark, skewed, dim):
    """Even where the rows of a key are copies of each other."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        copies = skewed.select("k").repartition(16)
        joined = lookup_join(copies, dim.drop("j"), ["k"], max_rows=50)
        placed = joined.select("k", F.spark_partition_id().alias("task")).distinct().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    tasks = {k: sum(r.k == k for r in placed) for k in (7, 8, None)}
    assert tasks[8] == 1 and tasks[7] > 1 and tasks[None] > 3


@pytest.mark.parametrize("kind", ["empty", "no key", "map", "map and no key"])
def test_large_lookup_of_odd_facts_equals_the_small_one(spark, skewed, dim, kind):
    facts = skewed.drop("j")
    if kind == "empty":
        facts = facts.where("k = -1")
    if "no key" in kind:
        facts = facts.withColumn("k", F.lit(None).cast("int"))
    if "map" in kind:
        facts = facts.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    small, large = (lookup_join(facts, dim.drop("j"), ["k"], max_rows=n) for n in (10_000, 0))
    assert small.columns == large.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert hot_keys(facts.where("k is null"), ["k"], 0.1).isEmpty()


def test_nested_sides_are_measured_and_others_refused(spark):
    wide = spark.range(100).select("id", F.array_repeat(F.lit(1), 1000).alias("a"))
    assert fits_broadcast(wide) and not fits_broadcast(wide, max_bytes=100_000)
    assert not fits_broadcast(spark.range(1).select(F.parse_json(F.lit("{}")).alias("v")))


def test_known_hot_keys_spare_the_count(skewed, dim):
    hot = hot_keys(skewed, ["k"], 0.01)
    got = lookup_join(skewed, dim.drop("j"), ["k"], max_rows=50, hot=hot)
    assert got.count() == skewed.count()


def test_large_lookup_reads_the_facts_once(skewed, dim):
    plan = lookup_join(skewed, dim.drop("j"), ["k"], max_rows=50)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 30000") == 1


def test_small_lookup_does_not_shuffle_the_facts(skewed, dim):
    plan = lookup_join(skewed, dim, ["k", "j"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_other_join_types_are_refused(skewed, dim):
    with pytest.raises(ValueError):
        lookup_join(skewed, dim, ["k"], "full")
