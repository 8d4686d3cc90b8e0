"""The zone dimension: loading rules, listing, lookup and enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions.text import UNKNOWN, contains_text, known_text, same_text
from curbflow.operators.lookup import lookup_join
from curbflow.spec import ZONE_COLS, require_columns

_TEXT_COLS = ZONE_COLS[1:]


def zone_dimension(zones: DataFrame, order_col: str | None = None) -> DataFrame:
    """One cleaned row per ``location_id``.

    Missing text becomes ``Unknown`` and rows without an id are dropped.
    Where an id occurs more than once the row with the greatest
    ``order_col`` wins; without an order the one whose texts sort last.
    """
    require_columns(zones, ZONE_COLS)
    named = zones.filter(F.col("location_id").isNotNull()).withColumns(
        {c: known_text(F.col(c)) for c in _TEXT_COLS}
    )
    texts = F.struct(*_TEXT_COLS)
    last = named.groupBy("location_id").agg(F.max_by(texts, texts if order_col is None else F.col(order_col)).alias("last"))
    return last.select("location_id", *[F.col(f"last.{c}").alias(c) for c in _TEXT_COLS])


def _wanted(borough: str | None, search: str | None) -> Column:
    test = F.lit(True)
    if borough:
        test = test & same_text(F.col("borough"), borough)
    if search:
        test = test & contains_text(F.col("zone_name"), search)
    return test


def list_zones(zones: DataFrame, borough: str | None = None, search: str | None = None) -> DataFrame:
    """Zones by id, optionally of one borough and with a text in their name.

    Both tests ignore case; an empty argument is no test.
    """
    return zones.filter(_wanted(borough, search)).select(*ZONE_COLS).orderBy("location_id")


def zone_counts(zones: DataFrame, borough: str | None = None, search: str | None = None) -> DataFrame:
    """One row: zones matched by the tests, zones loaded, and whether any is loaded."""
    loaded = F.count(F.lit(1))
    return zones.agg(
        F.count_if(_wanted(borough, search)).alias("total"),
        loaded.alias("total_zones"),
        (loaded > 0).alias("zones_loaded"),
    )


def lookup_zones(ids: DataFrame, zones: DataFrame, id_col: str = "location_id") -> DataFrame:
    """Zone rows for a table of ids; unknown ids and zones named ``Unknown`` are not found."""
    found = zones.filter(F.col("zone_name") != UNKNOWN)
    wanted = ids.select(F.col(id_col).try_cast("int").alias("location_id"))
    return lookup_join(wanted, found, ["location_id"], "inner").select(*ZONE_COLS)


def enrich_with_zone(rows: DataFrame, zones: DataFrame | None, zone_col: str) -> DataFrame:
    """Attach name, borough and service zone; ``Unknown`` where the zone is not listed.

    ``zones`` holds one row per id (see :func:`zone_dimension`); ``None``
    means there is no dimension. Measures the dimension (see ``lookup_join``).
    """
    if zones is None:
        return rows.withColumns({c: F.lit(UNKNOWN) for c in _TEXT_COLS})
    dim = zones.select(F.col("location_id").alias(zone_col), *_TEXT_COLS)
    joined = lookup_join(rows, dim, [zone_col])
    return joined.select(
        *rows.columns, *[F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in _TEXT_COLS]
    )
