"""Calendar features, the train/test split and target statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions.calendar import day_of_week, is_weekend, to_calendar_date
from curbflow.spec import DEMAND_KEYS, FEATURES, TARGET, require_columns


def add_date_features(demand: DataFrame) -> DataFrame:
    """Add ``day_of_week`` (0 = Monday), ``month`` and ``is_weekend``; ``date_str`` becomes a DATE."""
    require_columns(demand, ["date_str"])
    date = to_calendar_date(F.col("date_str"), demand.schema["date_str"].dataType)
    return demand.withColumns({
        "date_str": date,
        "day_of_week": day_of_week(date),
        "month": F.month(date),
        "is_weekend": is_weekend(date),
    })


def feature_matrix(
    featured: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET
) -> DataFrame:
    """The feature columns in their fixed order, then the target."""
    require_columns(featured, [*features, target])
    return featured.select(*features, target)


def is_train_row(keys: Sequence[str] = DEMAND_KEYS, train_percent: int = 80, seed: int = 42) -> Column:
    """Whether a row belongs to the training part, decided by a hash of its key.

    The same key falls on the same side in every run and under every
    partitioning, which a random draw per row does not give.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k) for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100 < train_percent


def _place(keys: Sequence[str], seed: int) -> Column:
    """A row's place on a line of 2^60 points, by a hash of its key."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k) for k in keys]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


_STEP_BITS = 15


def exact_holdout(
    rows: DataFrame, keys: Sequence[str] = DEMAND_KEYS, test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training part and a hold-out part of exactly ceil(``test_share`` x rows) rows.

    The hold-out rows are those with the greatest places on a hashed line. Where it starts is an order statistic, found without
    a sort: counts of 2^15 equal stretches tell the stretch it lies in, which is cut again, four jobs at
    most. Rows with equal keys share a place and a side, so the size is exact where keys are unique; the part is the
    same in every run and under every partitioning.
    """
    place = _place(keys, seed)
    total = rows.count()
    wanted = math.ceil(round(test_share * total, 9))
    if not wanted:
        return rows, rows.limit(0)
    low, above, bits = 0, 0, 60
    while bits:
        bits -= _STEP_BITS
        inside = rows.where((place >= low) & (place < low + (1 << (bits + _STEP_BITS))))
        counts = dict(inside.groupBy(F.shiftright(place - F.lit(low), bits).alias("stretch")).count().collect())
        for stretch in sorted(counts, reverse=True):
            if above + counts[stretch] >= wanted:
                low += stretch << bits
                break
            above += counts[stretch]
    return rows.where(place < low), rows.where(place >= low)


def holdout_split(
    rows: DataFrame, keys: Sequence[str] = DEMAND_KEYS, train_percent: int = 80, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training part and hold-out part. No shuffle and no job."""
    train = is_train_row(keys, train_percent, seed)
    return rows.filter(train), rows.filter(~train)


def target_stats(rows: DataFrame, target: str = TARGET) -> DataFrame:
    """One row: sample count and the target's least, greatest and mean value."""
    return rows.agg(
        F.count(F.lit(1)).alias("samples"),
        F.min(target).alias("min_target"),
        F.max(target).alias("max_target"),
        F.avg(target).alias("mean_target"),
    )
