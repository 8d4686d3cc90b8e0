"""Raw trips to a written demand table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from curbflow.operators.clean import audited_demand, picked_up_between, quality_report
from curbflow.operators.demand import demand_from_trips
from curbflow.sources.demand import replace_dates, write_demand
from curbflow.sources.trips import read_trips
from curbflow.spec import DemandSpec


def run_etl(
    spark: SparkSession,
    paths: str | Sequence[str],
    out_path: str,
    spec: DemandSpec = DemandSpec(),
    audit: bool = True,
    files: int | None = None,
    first_date: date | None = None,
    last_date: date | None = None,
) -> Row | None:
    """Read, clean, aggregate and write; return the audit counts.

    With ``first_date`` and ``last_date`` only the trips picked up in that range are read, and only
    its dates of the table at ``out_path`` are replaced (see ``replace_dates``), so a month can be run again by itself.
    Trips without a pickup time belong to no range: they are counted by a run over everything only.

    The trips are scanned once. With ``audit`` the aggregate, which is of
    the size of the demand table, is kept by the executors (on disk where
    memory is short) until both the table and the counts are made from it; a lost
    part is computed again. Without it the cleaning rules reach the Parquet
    scan as pushed filters. ``files`` is explained at ``write_demand``.
    """
    if (first_date is None) != (last_date is None):
        raise ValueError("a range of dates needs its first and its last")
    if first_date is not None and files is not None:
        raise ValueError("dates can't be replaced in a layout without folders")
    trips = read_trips(spark, paths, spec)
    if first_date is not None:
        trips = picked_up_between(trips, first_date, last_date, spec)

    def write(demand: DataFrame) -> None:
        if first_date is None:
            write_demand(demand, out_path, files)
        else:
            replace_dates(demand, out_path, first_date, last_date)

    if not audit:
        write(demand_from_trips(trips, spec))
        return None
    audited = audited_demand(trips, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write(audited.filter(F.col("reject_reason").isNull()))
        return quality_report(audited).first()
    finally:
        audited.unpersist()
