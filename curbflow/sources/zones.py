"""Reading the zone lookup file."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.operators.zones import zone_dimension
from curbflow.sources.demand import ABSENT

_log = logging.getLogger(__name__)


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw zone rows of a CSV with the header LocationID, Borough, Zone, service_zone.

    Columns are found by name; quoted values may hold line breaks, for which
    each file is read by one task (a zone list is small). ``row_order``
    follows the rows of the files.
    """
    lines = spark.read.csv(
        path, header=True, inferSchema=False, escape='"', multiLine=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return lines.select(
        F.col("LocationID").try_cast("double").try_cast("int").alias("location_id"),
        F.col("Zone").alias("zone_name"),
        F.col("Borough").alias("borough"),
        "service_zone",
        F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("row_order"),
    )


def load_zones(spark: SparkSession, path: str, optional: bool = False) -> DataFrame | None:
    """The zone dimension of a lookup file; the last line of an id wins.

    With ``optional`` an absent file gives ``None``, with which every zone
    is ``Unknown``.
    """
    try:
        lines = read_zone_csv(spark, path)
    except AnalysisException as error:
        if optional and error.getCondition() in ABSENT:
            _log.warning("no zone file at %s: zones will be Unknown", path)
            return None
        raise
    return zone_dimension(lines, "row_order")


def count_missing_ids(raw_zones: DataFrame) -> DataFrame:
    """One row: how many zone rows carry no usable id and are left out."""
    return raw_zones.agg(F.count_if(F.col("location_id").isNull()).alias("missing_ids"))
