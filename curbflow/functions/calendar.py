"""Calendar expressions. All of them are built-in JVM expressions.

Sessions run with ANSI casts, so text is parsed with ``try_cast``: text
that is no date gives NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the documented form of a request date.
REQUEST_DATE_PATTERN = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def to_calendar_date(col: Column, dtype: T.DataType) -> Column:
    """DATE from a date, timestamp or text column."""
    if isinstance(dtype, T.StringType):
        return col.try_cast("timestamp_ntz").cast("date")
    return col.cast("date")


def day_of_week(date: Column) -> Column:
    """0 = Monday ... 6 = Sunday (the trip features use 1 = Sunday instead)."""
    return F.weekday(date)


def is_weekend(date: Column) -> Column:
    """1 on Saturday and Sunday, else 0; a NULL date counts as 0."""
    return F.coalesce(F.weekday(date) >= 5, F.lit(False)).cast("int")


def window_start_date(window: Column, dtype: T.DataType) -> Column:
    """Date a window begins on.

    Accepts the text form ``[2023-07-09 08:00:00, 2023-07-09 08:15:00)`` and
    the struct that Spark's own ``window()`` writes.
    """
    if isinstance(dtype, T.StructType):
        return window["start"].cast("date")
    start = F.btrim(F.substring_index(window, ",", 1), F.lit("["))
    return start.try_cast("timestamp_ntz").cast("date")


def window_label(window: Column) -> Column:
    """Text form of a ``window()`` struct, half-open like the struct itself."""
    form = "yyyy-MM-dd HH:mm:ss"
    return F.concat(
        F.lit("["), F.date_format(window["start"], form),
        F.lit(", "), F.date_format(window["end"], form), F.lit(")"),
    )


def request_date(text: Column) -> Column:
    """DATE for text in the documented YYYY-MM-DD form, NULL for all else."""
    return F.when(text.rlike(REQUEST_DATE_PATTERN), text.try_cast("date"))
