"""Files in, files out."""

from datetime import date, datetime, timedelta
from concurrent.futures import ThreadPoolExecutor
from glob import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from curbflow import sources
from curbflow.sources import commits, predictions
from curbflow.plans import run_etl
from curbflow.spec import DEMAND_COLS
from test_trips_and_demand import SUNDAY, demand, found, trips

DAY = date(2025, 1, 5)
ZONE_CSV = '''LocationID,Borough,Zone,service_zone
1,EWR,Newark Airport,EWR
2,Queens,Jamaica Bay,Boro Zone
3,N/A,"Comma, ""quoted""",
,Queens,No id,Boro Zone
264,Unknown,NV,N/A
2,Bronx,Second line,null
7.0,Queens, Spaced ,None
'''


def test_read_trips_takes_globs_and_several_paths_and_prunes_columns(spark, tmp_path):
    for i in (1, 2):
        trips(spark, (i, SUNDAY, 1.0, 7)).withColumn("unused", F.lit("x")).write.parquet(f"{tmp_path}/y/part{i}.parquet")
    assert sources.read_trips(spark, f"{tmp_path}/y/*.parquet").count() == 2
    both = sources.read_trips(spark, [f"{tmp_path}/y/part1.parquet", f"{tmp_path}/y/part2.parquet"])
    assert both.count() == 2
    assert "unused" not in both.columns


def test_preview_is_ordered(spark):
    df = spark.range(100)
    assert [r.id for r in sources.preview(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert sources.preview(df).count() == 5


def test_explore_prints_schema_and_rows(spark, tmp_path, capsys):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    sources.explore(spark, f"{tmp_path}/t")
    out = capsys.readouterr().out
    assert "id: long" in out and "|2" in out


def test_demand_round_trip_by_date_and_in_one_file(spark, tmp_path):
    rows = [(DAY, h, z, 1, 0.5) for h in range(24) for z in range(50)] + [(None, 1, 1, 1, 1.0)]
    df = demand(spark, *rows).repartition(8)
    for files in (None, 1):
        path = f"{tmp_path}/d{files}"
        sources.write_demand(df, path, files)
        sources.write_demand(df, path, files)
        back = sources.read_demand(spark, path)
        assert back.columns == list(DEMAND_COLS)
        assert back.dtypes == df.dtypes
        assert found(back) == sorted(rows, key=str)
    assert len(glob(f"{tmp_path}/d1/*.parquet")) == 1
    assert sorted(p.rsplit("/", 1)[1] for p in glob(f"{tmp_path}/dNone/demand_month=*")) == [
        "demand_month=202501", "demand_month=__HIVE_DEFAULT_PARTITION__",
    ]


def test_equal_arguments_give_an_equal_layout(spark, tmp_path):
    df = demand(spark, *[(DAY, h, z, 1, 0.5) for h in range(24) for z in range(10)])
    for size in (24, 240):
        sources.write_demand(df.limit(size), f"{tmp_path}/n{size}", files=3)
        assert len(glob(f"{tmp_path}/n{size}/*.parquet")) == 3
    sources.write_demand(df, f"{tmp_path}/d", files=3)
    assert len(glob(f"{tmp_path}/d/*.parquet")) == 3
    assert sources.read_demand(spark, f"{tmp_path}/d").count() == 240


def test_month_folders_prune(spark, tmp_path):
    later = date(2025, 2, 6)
    sources.write_demand(demand(spark, (DAY, 1, 1, 1, 1.0), (later, 1, 1, 1, 1.0)), f"{tmp_path}/d")
    for one in (sources.read_demand(spark, f"{tmp_path}/d", DAY, DAY), sources.load_demand(spark, f"{tmp_path}/d", None, DAY, DAY)):
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(demand_month" in plan and "GreaterThanOrEqual(date_str" in plan
        assert [r.date_str for r in one.collect()] == [DAY] and len(one.inputFiles()) == 2
    assert sources.read_demand(spark, f"{tmp_path}/d", DAY).count() == 2
    assert sources.read_demand(spark, f"{tmp_path}/d", None, DAY).count() == 1


def test_dates_within_a_file_are_sorted_and_small_months_share_tasks(spark, tmp_path):
    rows = [(DAY + timedelta(days=d), h, z, 1, 0.5) for d in range(700) for h in (3, 9) for z in (1, 2)]
    sources.write_demand(demand(spark, *rows).repartition(8), f"{tmp_path}/d")
    files = glob(f"{tmp_path}/d/*/*.parquet")
    assert len(files) == len(glob(f"{tmp_path}/d/demand_month=*")) == 24
    for file in files[:3]:
        dates = [r[0] for r in spark.read.parquet(file).select("date_str").collect()]
        assert dates == sorted(dates)


def test_only_the_dates_of_a_run_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/d"
    days = [date(2025, 1, 30) + timedelta(days=d) for d in range(40)]  # 30 January to 10 March
    old = [(d, 1, 1, 1, 1.0) for d in days]
    first, last = date(2025, 1, 31), date(2025, 3, 2)
    new = [(d, 2, 2, 5, 2.0) for d in days if first <= d <= last and d.day % 2]
    sources.replace_dates(demand(spark, *old), path, days[0], days[-1])
    sources.write_demand(demand(spark, *old), path)
    untouched = glob(f"{path}/demand_month=202503/*.parquet")
    sources.replace_dates(demand(spark, *new), path, first, last)
    assert found(sources.read_demand(spark, path)) == sorted([r for r in old if not first <= r[0] <= last] + new, key=str)
    sources.replace_dates(demand(spark, (days[1], 7, 7, 7, 7.0)), path, date(2025, 1, 31), date(2025, 2, 28))
    assert {r.date_str for r in sources.read_demand(spark, path, date(2025, 1, 1), date(2025, 2, 28)).collect()} == {days[0], days[1]}
    assert glob(f"{path}/demand_month=202502") == []  # nothing is left of it
    sources.replace_dates(demand(spark), path, date(2025, 1, 1), date(2025, 12, 31))
    assert glob(f"{path}/demand_month=*") == [] and untouched


def test_months_outside_the_range_are_not_touched(spark, tmp_path):
    path = f"{tmp_path}/d"
    sources.write_demand(demand(spark, (DAY, 1, 1, 1, 1.0), (date(2025, 2, 5), 1, 1, 1, 1.0)), path)
    before = {p: open(p, "rb").read() for p in glob(f"{path}/demand_month=202502/*.parquet")}
    sources.replace_dates(demand(spark, (DAY, 2, 1, 1, 1.0)), path, DAY, DAY)
    assert {p: open(p, "rb").read() for p in glob(f"{path}/demand_month=202502/*.parquet")} == before


def test_rows_outside_the_range_and_other_layouts_are_refused(spark, tmp_path):
    for day in (date(2025, 2, 5), None):
        with pytest.raises(Exception, match="demand outside"):
            sources.replace_dates(demand(spark, (day, 1, 1, 1, 1.0)), f"{tmp_path}/d", DAY, DAY)
    with pytest.raises(ValueError, match="no dates"):
        sources.replace_dates(demand(spark), f"{tmp_path}/d", DAY, DAY - timedelta(days=1))
    sources.write_demand(demand(spark, (DAY, 1, 1, 1, 1.0)), f"{tmp_path}/f", files=1)
    with pytest.raises(ValueError, match="by months"):
        sources.replace_dates(demand(spark, (DAY, 1, 1, 1, 1.0)), f"{tmp_path}/f", DAY, DAY)


def test_the_job_reads_and_replaces_a_range(spark, tmp_path):
    monday = SUNDAY + timedelta(days=1)
    trips(spark, (1, SUNDAY, 1.5, 7), (1, monday, 2.5, 7), (1, monday, -1.0, 7)).write.parquet(f"{tmp_path}/in")
    trips(spark, (1, SUNDAY, 9.0, 8), (1, monday, 4.0, 8)).write.parquet(f"{tmp_path}/late")
    run_etl(spark, f"{tmp_path}/in", f"{tmp_path}/d")
    report = run_etl(spark, f"{tmp_path}/late", f"{tmp_path}/d", first_date=monday.date(), last_date=monday.date())
    assert (report["input_rows"], report["demand_rows"]) == (1, 1)
    assert found(sources.read_demand(spark, f"{tmp_path}/d")) == [(DAY, 16, 7, 1, 1.5), (monday.date(), 16, 8, 1, 4.0)]
    run_etl(spark, f"{tmp_path}/late", f"{tmp_path}/d", audit=False, first_date=DAY, last_date=DAY)
    assert found(sources.read_demand(spark, f"{tmp_path}/d"))[0] == (DAY, 16, 8, 1, 9.0)
    with pytest.raises(ValueError, match="first and its last"):
        run_etl(spark, f"{tmp_path}/in", f"{tmp_path}/d", first_date=DAY)
    with pytest.raises(ValueError, match="without folders"):
        run_etl(spark, f"{tmp_path}/in", f"{tmp_path}/d", files=1, first_date=DAY, last_date=DAY)


def test_optional_source_is_none_when_absent_or_empty_but_other_errors_are_raised(spark, tmp_path):
    assert sources.read_optional(spark, None) is None
    assert sources.read_optional(spark, f"{tmp_path}/nowhere") is None
    (tmp_path / "hollow").mkdir()
    assert sources.read_optional(spark, f"{tmp_path}/hollow") is None
    demand(spark).write.parquet(f"{tmp_path}/rowless")
    assert sources.read_optional(spark, f"{tmp_path}/rowless") is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("this is no parquet file")
    with pytest.raises(Exception) as caught:
        sources.read_optional(spark, f"{tmp_path}/broken")
    assert not isinstance(caught.value, AnalysisException) or caught.value.getCondition() not in (
        "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA",
    )


def test_load_demand_with_either_source_missing(spark, tmp_path):
    batch, raw = f"{tmp_path}/batch", f"{tmp_path}/raw"
    demand(spark, (DAY, 16, 7, 2, 1.5)).write.parquet(batch)
    schema = "date_str string, pickup_hour int, PULocationID int, trip_distance double"
    spark.createDataFrame([("2025-01-05", 16, 7, 1.0)], schema).write.parquet(raw)
    assert found(sources.load_demand(spark, batch, raw)) == [(DAY, 16, 7, 3, 2.5)]
    assert found(sources.load_demand(spark, batch, None)) == [(DAY, 16, 7, 2, 1.5)]
    assert found(sources.load_demand(spark, f"{tmp_path}/none", raw)) == [(DAY, 16, 7, 1, 1.0)]
    with pytest.raises(ValueError):
        sources.load_demand(spark, f"{tmp_path}/none", None)


def test_raw_stream_without_a_full_key_counts_as_empty(spark, tmp_path):
    schema = "date_str string, pickup_hour int, PULocationID int, trip_distance double"
    spark.createDataFrame([(None, 16, 7, 1.0)], schema).write.parquet(f"{tmp_path}/raw")
    demand(spark, (DAY, 1, 1, 1, 1.0), (DAY, 1, 1, 1, 1.0)).write.parquet(f"{tmp_path}/batch")
    assert sources.load_demand(spark, f"{tmp_path}/batch", f"{tmp_path}/raw").count() == 2


def test_zone_file_rules(spark, tmp_path):
    (tmp_path / "zones.csv").write_text(ZONE_CSV)
    path = f"{tmp_path}/zones.csv"
    assert found(sources.load_zones(spark, path)) == sorted([
        (1, "Newark Airport", "EWR", "EWR"), (2, "Second line", "Bronx", "Unknown"),
        (3, "Comma, \"quoted\"", "Unknown", "Unknown"), (264, "NV", "Unknown", "Unknown"),
        (7, " Spaced ", "Queens", "Unknown"),
    ], key=str)
    assert sources.count_missing_ids(sources.read_zone_csv(spark, path)).first()[0] == 1


def test_an_absent_zone_file_is_an_error_unless_optional(spark, tmp_path):
    assert sources.load_zones(spark, f"{tmp_path}/none.csv", optional=True) is None
    with pytest.raises(AnalysisException):
        sources.load_zones(spark, f"{tmp_path}/none.csv")


def test_zone_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "z.csv").write_text("Zone,service_zone,LocationID,Borough\nMidtown,Yellow Zone,5,Manhattan\n")
    assert found(sources.load_zones(spark, f"{tmp_path}/z.csv")) == [(5, "Midtown", "Manhattan", "Yellow Zone")]


def test_predictions_are_read_by_day(spark, tmp_path):
    now = datetime(2025, 1, 5, 0, 5)
    rows = [(1, 2, "2025-01-05", 1.5, datetime(2025, 1, d, 23, 59)) for d in (3, 4)]
    entries = spark.createDataFrame(rows, "zone int, hour int, date string, prediction double, cached_at timestamp")
    assert sources.read_predictions(spark, f"{tmp_path}/c", now) is None
    sources.append_predictions(entries, f"{tmp_path}/c")
    sources.append_predictions(entries, f"{tmp_path}/c")
    assert sources.read_predictions(spark, f"{tmp_path}/c", now).count() == 2


def test_expired_predictions_go_and_the_rest_is_compacted(spark, tmp_path):
    now = datetime(2025, 1, 5, 0, 5)
    times = [now - timedelta(seconds=s) for s in (599, 600, 5, 90_000)] + [now + timedelta(seconds=5)]
    rows = [(i, 2, "2025-01-05", float(i), at) for i, at in enumerate(times)]
    entries = spark.createDataFrame(rows, "zone int, hour int, date string, prediction double, cached_at timestamp")
    sources.expire_predictions(spark, f"{tmp_path}/c", now)
    for _ in range(2):
        sources.append_predictions(entries, f"{tmp_path}/c")
    sources.expire_predictions(spark, f"{tmp_path}/c", now)
    alive = lambda: sorted(r.zone for r in sources.stored_predictions(spark, f"{tmp_path}/c").collect())
    assert alive() == [0, 0, 2, 2, 4, 4]
    sources.expire_predictions(spark, f"{tmp_path}/c", now)
    assert alive() == [0, 0, 2, 2, 4, 4] and len(glob(f"{tmp_path}/c/data/*")) == 2  # the batch before stays for its readers
    sources.expire_predictions(spark, f"{tmp_path}/c", now + timedelta(days=2))
    assert alive() == [] and sources.read_predictions(spark, f"{tmp_path}/c", now).count() == 0


def test_appends_while_the_table_expires_are_kept_and_readers_are_not_disturbed(spark, tmp_path, monkeypatch):
    now, path = datetime(2025, 1, 5, 0, 5), f"file://{tmp_path}/c"
    batch = lambda zone, age: spark.createDataFrame(
        [(zone, 2, "2025-01-05", 1.0, now - timedelta(seconds=age))], "zone int, hour int, date string, prediction double, cached_at timestamp"
    )
    sources.append_predictions(batch(1, 5), path)
    sources.append_predictions(batch(2, 5000), path)
    pinned = sources.stored_predictions(spark, path)
    write = predictions._write_batch

    def append_too(rows, where):
        monkeypatch.setattr(predictions, "_write_batch", write)
        sources.append_predictions(batch(3, 1), path)
        return write(rows, where)

    monkeypatch.setattr(predictions, "_write_batch", append_too)
    sources.expire_predictions(spark, path, now)
    assert sorted(r.zone for r in sources.stored_predictions(spark, path).collect()) == [1, 3]
    assert sorted(r.zone for r in pinned.collect()) == [1, 2]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda z: sources.append_predictions(batch(z, 1), path), range(10, 18)))
    assert sorted(r.zone for r in sources.stored_predictions(spark, path).collect()) == [1, 3, *range(10, 18)]

    def expire_too(rows, where):
        monkeypatch.setattr(predictions, "_write_batch", write)
        sources.expire_predictions(spark, path, now)
        return write(rows, where)

    monkeypatch.setattr(predictions, "_write_batch", expire_too)
    with pytest.raises(RuntimeError, match="another job"):
        sources.expire_predictions(spark, path, now)
    assert sources.stored_predictions(spark, path).count() == 10


def test_zone_file_with_quotes_line_breaks_and_repeats(spark, tmp_path):
    (tmp_path / "z.csv").write_text(
        'LocationID,Borough,Zone,service_zone\n1,Queens,Old,Boro Zone\n,Queens,Nameless,Boro Zone\n'
        '1,Queens,"Park ""A"",\nnorth",Yellow Zone\n2,Bronx,Hill,Boro Zone\n'
    )
    assert found(sources.load_zones(spark, f"{tmp_path}/z.csv")) == [
        (1, 'Park "A",\nnorth', "Queens", "Yellow Zone"), (2, "Hill", "Bronx", "Boro Zone"),
    ]


def test_etl_audits_and_writes(spark, tmp_path):
    trips(spark, (1, SUNDAY, 1.5, 7), (1, SUNDAY, -1.5, 7)).write.parquet(f"{tmp_path}/in")
    report = run_etl(spark, f"{tmp_path}/in", f"{tmp_path}/a")
    assert (report["input_rows"], report["removed_rows"], report["demand_rows"]) == (2, 1, 1)
    assert run_etl(spark, [f"{tmp_path}/in"], f"{tmp_path}/b", audit=False, files=1) is None
    want = [(DAY, 16, 7, 1, 1.5)]
    assert found(sources.read_demand(spark, f"{tmp_path}/a")) == want
    assert found(sources.read_demand(spark, f"{tmp_path}/b")) == want
