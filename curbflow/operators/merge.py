"""Bringing streaming demand into shape and merging it with batch demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.functions.calendar import to_calendar_date, window_start_date
from curbflow.operators.demand import number_or_null, rollup_demand
from curbflow.spec import DEMAND_COLS, DEMAND_KEYS, require_columns


def _has(df: DataFrame, columns) -> bool:
    return all(c in df.columns for c in columns)


def _dated(df: DataFrame) -> DataFrame:
    """``date_str`` as a DATE; a window column takes precedence over it."""
    if "window" in df.columns:
        return df.withColumn("date_str", window_start_date(F.col("window"), df.schema["window"].dataType))
    if "date_str" in df.columns:
        return df.withColumn("date_str", to_calendar_date(F.col("date_str"), df.schema["date_str"].dataType))
    return df


def is_aggregated(stream: DataFrame) -> bool:
    """Whether a streaming table already carries both measures."""
    return _has(stream, ("trip_count", "avg_distance"))


def stream_rows(stream: DataFrame) -> DataFrame | None:
    """The five demand columns of a streaming table, not yet summed per key.

    Raw trips become rows that stand for one trip each (0 where the distance
    is missing). ``None`` when the columns fit neither shape.
    """
    rows = _dated(stream)
    if not is_aggregated(rows):
        if not _has(rows, (*DEMAND_KEYS, "trip_distance")):
            return None
        distance = number_or_null(rows, "trip_distance")
        rows = rows.withColumns({
            "trip_count": distance.isNotNull().cast("bigint"),
            "avg_distance": distance,
        })
    return rows.select(*DEMAND_COLS) if _has(rows, DEMAND_COLS) else None


def normalize_stream_demand(stream: DataFrame) -> DataFrame | None:
    """A streaming table as demand per date x hour x zone.

    Tables with one row per trip or per window are summed to the hour;
    tables of the demand grain pass as they are; ``None`` means the table
    lacks columns and is to be skipped.
    """
    rows = stream_rows(stream)
    if rows is None or (is_aggregated(stream) and "window" not in stream.columns):
        return rows
    return rollup_demand(rows)


def merge_demand(batch: DataFrame | None, stream: DataFrame | None) -> DataFrame:
    """Batch and streaming demand summed per key.

    ``None`` stands for a source that is missing, empty or unusable. Overlap
    is added up, not removed. All rows meet in a single aggregate, so a raw
    or windowed stream needs no aggregate of its own. A lone source keeps
    its rows; see :func:`normalize_stream_demand` for a lone stream.
    """
    rows = None if stream is None else stream_rows(stream)
    if batch is None and rows is None:
        raise ValueError("neither the batch nor the streaming source has data")
    if batch is None:
        return normalize_stream_demand(stream)
    if rows is None:
        return _batch_rows(batch)
    return rollup_demand(_batch_rows(batch).unionByName(rows, allowMissingColumns=True))


def _batch_rows(batch: DataFrame) -> DataFrame:
    """The demand columns a batch table has; a measure it lacks becomes NULL in the union."""
    require_columns(batch, DEMAND_KEYS)
    return _dated(batch.select(*[c for c in DEMAND_COLS if c in batch.columns]))
