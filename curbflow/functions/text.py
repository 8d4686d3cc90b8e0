"""Text expressions for the zone dimension and the prediction cache."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# The cell texts that the public pandas CSV reader takes as missing.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def known_text(col: Column) -> Column:
    """The text itself, or ``Unknown`` where it is NULL or a missing-value mark."""
    return F.when(col.isNull() | col.isin(*MISSING_TEXT), F.lit(UNKNOWN)).otherwise(col)


def same_text(col: Column, text: str) -> Column:
    """Equality without regard to case."""
    return F.lower(col) == F.lower(F.lit(text))


def contains_text(col: Column, text: str) -> Column:
    """Literal substring without regard to case: ``%`` and ``_`` are plain characters."""
    return F.contains(F.lower(col), F.lower(F.lit(text)))


def cache_key(zone: Column, hour: Column, date: Column) -> Column:
    """Text key ``demand:<zone>:<hour>:<date>`` of one prediction."""
    return F.concat_ws(":", F.lit("demand"), zone, hour, date)
