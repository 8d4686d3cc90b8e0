"""Keeping a merged demand table up to date without reading all history again."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.operators.merge import merge_demand
from curbflow.session import scratch_path
from curbflow.sources.commits import commit_next, latest
from curbflow.sources.demand import MONTH, month_of, read_optional, replace_months
from curbflow.spec import DEMAND_KEYS, WINDOW_DATE

_FOLDERS = re.compile(rf"/(?:{MONTH}=(\d{{4}})(\d\d)|(?:{WINDOW_DATE}|{DEMAND_KEYS[0]})=(\d{{4}})-(\d\d)-\d\d)/")


def _files(table: DataFrame | None) -> list[str]:
    """The files a table counts: of a stream's output those that its own log lists."""
    return [] if table is None else sorted(table.inputFiles())


def _month(file: str) -> int | None:
    """The month of the folder a file lies in, or ``None`` for a file without such a folder."""
    found = _FOLDERS.search(file)
    return None if found is None else int("".join(g for g in found.groups() if g))


def _of_months(table: DataFrame | None, months: list[int]) -> DataFrame | None:
    """Rows of some months, by the folders of a month or a date, so that others are not read."""
    if table is None:
        return None
    if MONTH in table.columns:
        return table.filter(F.col(MONTH).isin(months))
    day = next((c for c in (WINDOW_DATE, DEMAND_KEYS[0]) if c in table.columns), None)
    if day is None:
        return table
    ranges = [F.col(day).between(F.lit(date(m // 100, m % 100, 1)), F.last_day(F.lit(date(m // 100, m % 100, 1)))) for m in months]
    return table.filter(reduce(Column.__or__, ranges))


def merge_increment(spark: SparkSession, batch_path: str | None, stream_path: str | None, out_path: str) -> list[int]:
    """Bring the merged table at ``out_path`` up to date; returns the months (202501 for January 2025) made anew.

    The files of both sources are compared with those of the last run, which a commit beside the table remembers. Only
    months with a file that came or went since are read, merged and replaced; late windows count for the month of their own date. The
    result equals a full merge at any time. A source whose files lie in no month or date folder makes every change
    a full merge. Run again after a failure, it does the same work again.
    """
    batch, stream = read_optional(spark, batch_path), read_optional(spark, stream_path)
    now = {"batch": _files(batch), "stream": _files(stream)}
    before = latest(spark, out_path)
    seen = _remembered(spark, before[1]["files"]) if before else {"batch": [], "stream": []}
    changed = {f for side in now for f in set(now[side]) ^ set(seen[side])}
    if not changed:
        return []
    known = {f: _month(f) for side in now for f in {*now[side], *seen[side]}}
    if None in known.values():
        months = _all_months(batch, stream, read_optional(spark, out_path))
    else:
        months = sorted({known[f] for f in changed})
    parts = [_of_months(table, months) for table in (batch, stream)]
    if parts[0] is None and parts[1] is None:
        rows = None
    else:
        rows = merge_demand(*parts)
        if None in known.values():
            rows = rows.where(month_of(F.col("date_str")).isin(months))
    replace_months(spark, rows, out_path, months)
    path = f"{out_path.rstrip('/')}/_merged/{scratch_path(spark, 'files').rsplit('/', 1)[1]}"
    listed = [(side, f) for side in now for f in now[side]]
    spark.createDataFrame(listed, "side string, file string").coalesce(1).write.parquet(path)
    commit_next(spark, out_path, lambda old: {"files": path})
    return months


def _remembered(spark: SparkSession, path: str) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {"batch": [], "stream": []}
    for side, file in spark.read.schema("side string, file string").parquet(path).toLocalIterator():
        found[side].append(file)
    return found


def _all_months(*tables: DataFrame | None) -> list[int]:
    """Every month that any of the tables has rows of."""
    months: set[int] = set()
    for table in tables:
        if table is not None:
            rows = merge_demand(table, None) if "date_str" in table.columns and "window" not in table.columns else merge_demand(None, table)
            months |= {r[0] for r in rows.select(month_of(F.col("date_str"))).distinct().collect() if r[0] is not None}
    return sorted(months)
