"""Physical plans of the hot queries, the shared folder, and the command line."""

import json
from datetime import datetime

import pytest

from curbflow import session
from curbflow.__main__ import main
from curbflow.sources import read_demand
from test_trips_and_demand import SUNDAY, trips
from workload.queries import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_demand_scan_is_pruned_and_filtered_and_shuffles_once(spark, sf_dir):
    plan = plan_of(QUERIES["demand_lineitem"](spark, sf_dir))
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    for pushed in ("IsNotNull(l_shipdate)", "GreaterThan(l_quantity,0.0)", "IsNotNull(l_suppkey)"):
        assert pushed in plan
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_merge_adds_one_shuffle_to_those_of_its_sources(spark, sf_dir):
    assert plan_of(QUERIES["demand_merge"](spark, sf_dir)).count("Exchange") == 3
    assert plan_of(QUERIES["demand_merge_raw"](spark, sf_dir)).count("Exchange") == 2


@pytest.mark.parametrize("name", ["clean_trips", "trip_features", "score_validate"])
def test_row_by_row_queries_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["score_requests", "zone_enrich"])
def test_small_sides_are_broadcast(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_query_uses_python_workers_or_cross_joins(spark, sf_dir):
    for name in ("demand_merge", "score_requests", "zone_enrich", "stream_raw_demand", "regression_metrics"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert not any(word in plan for word in ("Python", "Arrow", "Cartesian", "NestedLoop"))


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder


class FakeSession:
    """The parts of a session that decide where shared files go."""

    def __init__(self, master, **settings):
        self.sparkContext, self.conf = FakeContext(master), settings


def test_shared_folder_follows_the_setting():
    cluster = FakeSession("spark://host:7077", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.scratch_path(cluster, "x").startswith("hdfs:///shared/x-")
    assert session.scratch_path(cluster, "x") != session.scratch_path(cluster, "x")
    session.ensure_checkpoint_dir(cluster)
    assert cluster.sparkContext.folder == "hdfs:///shared/"


def test_a_context_with_a_checkpoint_folder_keeps_it():
    cluster = FakeSession("spark://host:7077")
    cluster.sparkContext.setCheckpointDir("hdfs:///given")
    session.ensure_checkpoint_dir(cluster)
    assert session.shared_dir(cluster) == "hdfs:///given"


@pytest.mark.parametrize("master", ["local[2]", "spark://host:7077"])
def test_without_a_setting_there_is_no_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession(master))


def test_times_are_the_sessions(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        there = spark.sql("SELECT cast(current_timestamp() AS timestamp_ntz) AS now").first().now
        assert abs((session.session_now(spark) - there).total_seconds()) < 60
        assert session.session_time(spark, "2025-01-05T10:00:00+00:00") == datetime(2025, 1, 5, 19)
        assert session.session_time(spark, "2025-01-05T10:00:00") == datetime(2025, 1, 5, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_long_zone_listing_is_printed_whole(spark, tmp_path, capsys):
    lines = "\n".join(f"{i},Queens,Zone {i},Boro Zone" for i in range(1500))
    (tmp_path / "long.csv").write_text(f"LocationID,Borough,Zone,service_zone\n{lines}\n")
    main(["zones", "--file", f"{tmp_path}/long.csv"], spark)
    out = capsys.readouterr().out.splitlines()
    assert sum("Zone " in line and "Queens" in line for line in out) == 1500


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    rows = [(1, SUNDAY.replace(day=d, hour=h), 1.0, z) for d in range(1, 8) for h in range(24) for z in (1, 2)]
    trips(spark, *rows).write.parquet(f"{tmp_path}/raw")
    main(["etl", "--input", f"{tmp_path}/raw", "--output", f"{tmp_path}/demand"], spark)
    assert "'input_rows': 336" in capsys.readouterr().out
    assert read_demand(spark, f"{tmp_path}/demand").count() == 336
    main(["stream", "--input", f"{tmp_path}/raw", "--output", f"{tmp_path}/minutes", "--checkpoint",
          f"{tmp_path}/state", "--once"], spark)
    assert spark.read.parquet(f"{tmp_path}/minutes").count() == 334
    main(["train", "--batch", f"{tmp_path}/demand", "--model", f"{tmp_path}/model", "--rounds", "2"], spark)
    assert "'rmse': 0.0" in capsys.readouterr().out
    spark.createDataFrame([(1, 5, "2025-01-05")], "zone int, hour int, date string").write.parquet(f"{tmp_path}/ask")
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n1,Queens,Park,Boro Zone\n")
    main(["score", "--requests", f"{tmp_path}/ask", "--model", f"{tmp_path}/model", "--output", f"{tmp_path}/out",
          "--zones", f"{tmp_path}/zones.csv", "--cache", f"{tmp_path}/cache"], spark)
    answer = spark.read.parquet(f"{tmp_path}/out").first()
    assert (answer.zone_name, answer.predicted_demand, answer.source) == ("Park", 1.0, "model_inference")
    capsys.readouterr()
    single = ["predict", "--zone", "2", "--date", "2025-01-05", "--model", f"{tmp_path}/model",
              "--cache", f"{tmp_path}/cache", "--zones", f"{tmp_path}/zones.csv"]
    for source in ("model_inference", "cache_redis"):
        main([*single, "--hour", "5", "--now", "2025-01-05T10:00:00"], spark)
        assert json.loads(capsys.readouterr().out) == {
            "source": source, "zone": 2, "zone_name": "Unknown", "borough": "Unknown", "service_zone": "Unknown",
            "hour": 5, "date": "2025-01-05", "day_of_week": 6, "month": 1, "is_weekend": True, "predicted_demand": 1.0,
        }
    with pytest.raises(ValueError, match="bad_hour"):
        main([*single, "--hour", "24"], spark)
    main(["zones", "--file", f"{tmp_path}/zones.csv", "--search", "PAR"], spark)
    main(["zones", "--file", f"{tmp_path}/zones.csv", "--id", "1", "2"], spark)
    main(["explore", "--input", f"{tmp_path}/demand"], spark)
    assert capsys.readouterr().out.count("Park") == 2
    with pytest.raises(SystemExit):
        main([], spark)
