"""Joining facts to a table that is unique per key, whatever its size or skew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
_SALT, _SALTS = "_salt", "_salts"


def _holds(dtype: T.DataType, kinds: tuple) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds(f.dataType, kinds) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return _holds(dtype.elementType, kinds)
    if isinstance(dtype, T.MapType):
        return T.MapType in kinds or _holds(dtype.keyType, kinds) or _holds(dtype.valueType, kinds)
    return isinstance(dtype, kinds)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` against both bounds (runs a job: one count, added up per task).

    Arrays, maps and structs count by the length of their JSON text. Types
    that can't be measured do not fit.
    """
    if any(_holds(f.dataType, (T.UserDefinedType, T.VariantType)) for f in df.schema):
        return False
    width = F.lit(16 * len(df.columns))
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(F.struct(column.alias("v")))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        width = width + F.coalesce(F.octet_length(column), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    sized_by: DataFrame | None = None,
    max_rows: int = BROADCAST_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left or inner equi-join of ``facts`` to ``dim``, which holds one row per key.

    A ``dim`` measured to be small is broadcast, so ``facts`` is not
    shuffled at all. Beyond the bound both sides are shuffled by key and
    salt. The salt is 0 except for hot keys, whose facts are more than an
    even share of one shuffle partition: a key with a third of the facts is
    spread over a third as many salts as there are partitions, and its
    ``dim`` row is repeated for each. There can be no more hot keys than
    partitions, and no more than twice as many repeated rows. Facts with a
    NULL key match nothing and are spread too, so that they do not meet in
    one task.

    ``sized_by`` is a cheaper frame with at least as many rows as ``dim`` to
    measure in its place. Runs a count of it, and a count of the facts per key
    where ``dim`` is large, unless the caller brings ``hot``, a result of
    ``hot_keys`` for these facts. The salt is taken from columns that can be
    hashed, which maps can't.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    keys = list(keys)
    if fits_broadcast(dim if sized_by is None else sized_by, max_rows):
        return facts.join(F.broadcast(dim), keys, how)

    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = (hot_keys(facts, keys, 1 / partitions) if hot is None else hot).select(
        *keys, F.ceil(F.col("share") * partitions).cast("int").alias(_SALTS)
    )
    spread_dim = dim.join(F.broadcast(hot), keys, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1))
    )
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salts = F.when(no_key, partitions).otherwise(F.coalesce(_SALTS, F.lit(1)))
    # A function of the row and of its partition: the same again when a task
    # is repeated, yet different for copies of a row in other partitions.
    hashable = [F.col(f"`{f.name}`") for f in facts.schema if not _holds(f.dataType, (T.MapType, T.VariantType))]
    own_salt = F.pmod(F.xxhash64(F.spark_partition_id(), *hashable), salts).cast("int")
    spread_facts = facts.join(F.broadcast(hot), keys, "left").withColumn(
        _SALT, F.when(salts > 1, own_salt).otherwise(0)
    )
    return spread_facts.drop(_SALTS).join(spread_dim.drop(_SALTS), [*keys, _SALT], how).drop(_SALT)


def hot_keys(facts: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys held by more than ``share`` of the rows, with their ``share``.

    There are at most ``1 / share`` of them; no rows or none with a key give
    none. Runs one job: the total is a grouping set beside the keys, so both
    come from the same aggregate.
    """
    keys = list(keys)
    whole = F.grouping_id() > 0
    counts = facts.select(*keys).groupingSets([keys, []], *keys).agg(
        F.count(F.lit(1)).alias("_rows"), whole.alias("_whole")
    )
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    top = counts.where(F.col("_whole") | keyed).orderBy(F.desc("_whole"), F.desc("_rows")).limit(int(1 / share) + 2).collect()
    total = sum(row["_rows"] for row in top if row["_whole"])
    hot = [
        (*[row[k] for k in keys], row["_rows"] / total)
        for row in top if not row["_whole"] and row["_rows"] > total * share
    ]
    schema = T.StructType([*[facts.schema[k] for k in keys], T.StructField("share", T.DoubleType())])
    return facts.sparkSession.createDataFrame(hot, schema)
