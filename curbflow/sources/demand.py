"""Reading and writing demand tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.operators.merge import is_aggregated, merge_demand, stream_rows
from curbflow.session import delete_path, list_names
from curbflow.spec import DEMAND_COLS, DEMAND_KEYS, WINDOW_DATE, require_columns

_log = logging.getLogger(__name__)

# Spark's error conditions for a path that is absent or holds no files.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


MONTH = "demand_month"


def month_of(day: Column) -> Column:
    """The folder of a date: year and month as one whole number, 202501 for January 2025."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def read_demand(spark: SparkSession, path: str, first_date: date | None = None, last_date: date | None = None) -> DataFrame:
    """A demand table as :func:`write_demand` leaves it, or the dates from ``first_date`` to ``last_date`` of it.

    Of a range only the folders of its months are read, and in these the row groups that hold its dates.
    """
    demand = spark.read.parquet(path)
    require_columns(demand, DEMAND_COLS)
    return _of_dates(demand, DEMAND_KEYS[0], first_date, last_date).select(*DEMAND_COLS)


def read_optional(spark: SparkSession, path: str | None) -> DataFrame | None:
    """A Parquet table, or ``None`` where there is none or it has no rows.

    Only "no such path" and "no files" are taken as absence; every other
    failure is raised. Runs a job that stops at the first row.
    """
    if path is None:
        return None
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            _log.warning("nothing to read at %s", path)
            return None
        raise
    if df.isEmpty():
        _log.warning("no rows at %s", path)
        return None
    return df


def _of_dates(table: DataFrame | None, column: str, first: date | None, last: date | None) -> DataFrame | None:
    """Rows whose date lies in the range; of the date or month folders only those within it are read."""
    if table is None or column not in table.columns:
        return table
    for bound, within in ((first, Column.__ge__), (last, Column.__le__)):
        if bound is not None:
            table = table.filter(within(F.col(column), F.lit(bound)))
            if MONTH in table.columns:
                table = table.filter(within(F.col(MONTH), F.lit(bound.year * 100 + bound.month)))
    return table


def load_demand(
    spark: SparkSession, batch_path: str | None, stream_path: str | None,
    first_date: date | None = None, last_date: date | None = None,
) -> DataFrame:
    """Demand merged from a batch table and a streaming job's output, either of which may be absent.

    ``first_date`` and ``last_date`` (inclusive) restrict both sources. The
    folders per date that the writers make let a scan skip the others.
    """
    stream = _of_dates(read_optional(spark, stream_path), WINDOW_DATE, first_date, last_date)
    if stream is not None and not is_aggregated(stream):
        rows = stream_rows(stream)
        # Raw trips none of which has a full key aggregate to nothing.
        if rows is None or rows.dropna(subset=list(DEMAND_KEYS)).isEmpty():
            _log.warning("skipping the streaming source: it has columns %s", stream.columns)
            stream = None
    batch = _of_dates(read_optional(spark, batch_path), DEMAND_KEYS[0], first_date, last_date)
    return _of_dates(merge_demand(batch, stream), DEMAND_KEYS[0], first_date, last_date)


def _by_month(rows: DataFrame) -> DataFrame:
    """Demand rows with their month, rebalanced by it at run time and sorted by date within a task."""
    dated = rows.withColumn(MONTH, month_of(F.col("date_str")))
    return dated.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, *DEMAND_KEYS)


def write_demand(demand: DataFrame, path: str, files: int | None = None) -> None:
    """Write a demand table, replacing what is at ``path``.

    By default there is a folder per month whose files are sorted by date, so that readers of some
    dates skip other months and, by the statistics of the row groups, most of the other dates. Spark
    rebalances the rows at run time, which splits a large month and packs small ones. ``files`` leaves out the
    folders and writes that many files of about equal size: equal arguments give an
    equal layout, and how much a task may hold is the caller's choice.
    """
    require_columns(demand, DEMAND_COLS)
    rows = demand.select(*DEMAND_COLS)
    if files is None:
        _by_month(rows).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    else:
        rows.repartition(files).write.mode("overwrite").parquet(path)


def replace_dates(demand: DataFrame, path: str, first_date: date, last_date: date) -> None:
    """Make ``demand`` the content of the dates from ``first_date`` to ``last_date``; all other dates stay.

    A date of the range without rows in ``demand`` is cleared. Rows of ``demand`` outside the
    range are an error in the caller's range and are refused. The months of the range are written anew, with the rows
    of their other dates, by dynamic partition overwrite: a folder is swapped when all files of the run are
    written, and months outside the range aren't read or touched. A month of which nothing is
    left is removed. An absent table is created. Two runs must not replace dates of the same month at once.
    """
    if first_date > last_date:
        raise ValueError(f"no dates from {first_date} to {last_date}")
    require_columns(demand, DEMAND_COLS)
    spark = demand.sparkSession
    day = F.col("date_str")
    outside = F.coalesce(~day.between(F.lit(first_date), F.lit(last_date)), F.lit(True))
    rows = demand.select(*DEMAND_COLS)
    refused = F.raise_error(F.concat(F.lit(f"demand outside {first_date} to {last_date}: "), F.coalesce(day.cast("string"), F.lit("no date"))))
    rows = rows.withColumn("date_str", F.when(outside, refused.cast("date")).otherwise(day))
    months = _months(first_date, last_date)
    table = read_optional(spark, path)
    if table is not None:
        require_columns(table, DEMAND_COLS)
        if MONTH not in table.columns:
            raise ValueError(f"{path} isn't laid out by months, so its dates can't be replaced")
        inside = F.col(MONTH).between(months[0], months[-1])
        others = table.filter(inside & ~day.between(F.lit(first_date), F.lit(last_date)))
        rows = rows.unionByName(others.select(*DEMAND_COLS))
    replace_months(spark, rows, path, months)


def replace_months(spark: SparkSession, rows: DataFrame | None, path: str, months: Sequence[int]) -> None:
    """Make ``rows``, which must lie in ``months``, the content of these months' folders; a month without rows goes."""
    folders = [f"{path.rstrip('/')}/{MONTH}={m}" for m in months]
    before = {folder: list_names(spark, folder) for folder in folders}
    if rows is not None:
        _by_month(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    for folder, names in before.items():  # a folder the run did not swap holds nothing that counts
        if names and list_names(spark, folder) == names:
            delete_path(spark, folder)
    spark.catalog.refreshByPath(path)


def _months(first: date, last: date) -> list[int]:
    whole = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [m // 12 * 100 + m % 12 + 1 for m in whole]
