"""Times the headline queries and prints one JSON line.

Each query runs in full (its result goes to a sink that discards it): once
to warm up, then three times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curbflow import operators as ops  # noqa: E402
from workload import queries as work  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


def demand_model_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five-feature fit at 5 rounds, beside the full one at 100."""
    train, test = ops.holdout_split(ops.add_date_features(work._hourly(spark, sf_dir)))
    return ops.regression_metrics(ops.fit_demand_model(train, rounds=5).transform(test))


TIMED = {**QUERIES, "demand_model_5": demand_model_5}

HEADLINE = (
    "scan_trips", "clean_trips", "trip_features", "quality_report", "demand_hourly", "demand_lineitem",
    "demand_1min", "demand_merge", "demand_merge_raw", "demand_roundtrip", "demand_etl", "zone_enrich",
    "date_features", "holdout_split", "regression_metrics", "score_validate", "cache_lookup", "score_requests", "score_job",
    "demand_stream",
)
MODEL = ("demand_model_5", "demand_model", "score_requests_trees")


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("curbflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED", tempfile.mkdtemp(prefix="bench-")))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(spark: SparkSession, name: str, sf_dir: str, repeats: int) -> float:
    times = []
    for _ in range(repeats + 1):
        start = time.perf_counter()
        run(TIMED[name](spark, sf_dir))
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count())))
    times = {name: seconds(spark, name, sf_dir, 3) for name in HEADLINE}
    times |= {name: seconds(spark, name, sf_dir, 1) for name in MODEL}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
