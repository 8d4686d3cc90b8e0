"""Reading and looking at raw trips."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.spec import DemandSpec, require_columns

# Fixed value: Spark's error condition for files whose column types differ.
UNLIKE = "CANNOT_MERGE_SCHEMAS"

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BROKEN = (T.FloatType, T.DoubleType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_SMALL = (T.ByteType, T.ShortType, T.IntegerType)


def list_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The files that a Parquet read of ``paths`` (files, folders, globs) would take, by name; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path")
    return sorted(row[0] for row in files.collect())


def merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The schema of all files together, from their footers, or ``None`` if a column's types differ."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except Py4JJavaError as error:
        if UNLIKE in str(error.java_exception.getMessage()):
            return None
        raise


def schema_groups(spark: SparkSession, files: Sequence[str], columns: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files by the types of ``columns``: (these columns' schema, files).

    Footers are read by Spark, in parallel. A run of files (by name) whose types differ is halved until each part
    agrees, so a type that changed a few times over the years costs a few small jobs for each change.
    """
    found: dict[tuple, tuple[T.StructType, list[str]]] = {}
    pending = [list(files)]
    while pending:
        part = pending.pop()
        schema = merged_schema(spark, part)
        if schema is None and len(part) > 1:
            pending += [part[len(part) // 2 :], part[: len(part) // 2]]
            continue
        if schema is None:
            raise ValueError(f"can't read the schema of {part[0]}")
        own = {f.name.lower(): f for f in schema}
        lacking = [c for c in columns if c.lower() not in own]
        if lacking:
            raise ValueError(f"missing columns {lacking} in {part[0]}" + (f" and {len(part) - 1} others" if len(part) > 1 else ""))
        fields = [T.StructField(c, own[c.lower()].dataType) for c in columns]
        key = tuple(f.dataType.simpleString() for f in fields)
        found.setdefault(key, (T.StructType(fields), []))[1].extend(part)
    return list(found.values())


def common_type(types: Sequence[T.DataType]) -> T.DataType | None:
    """The narrowest type that holds all of ``types``; ``None`` where there is none.

    Whole numbers meet in the widest of them, decimals in one with all their digits, whole and broken numbers in DOUBLE,
    times with and without a zone in TIMESTAMP (read in the session's zone).
    """
    kinds = list(dict.fromkeys(types))
    if len(kinds) == 1:
        return kinds[0]
    if all(isinstance(k, _WHOLE) for k in kinds):
        return max(kinds, key=lambda k: _WHOLE.index(type(k)))
    if all(isinstance(k, (*_WHOLE, T.DecimalType)) for k in kinds):
        scale = max(getattr(k, "scale", 0) for k in kinds)
        whole = max(k.precision - k.scale if isinstance(k, T.DecimalType) else _DIGITS[type(k)] for k in kinds)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if all(isinstance(k, (*_WHOLE, *_BROKEN, T.DecimalType)) for k in kinds):
        return T.DoubleType()
    if all(isinstance(k, (T.TimestampType, T.TimestampNTZType)) for k in kinds):
        return T.TimestampType()
    return None


def reads_as(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether Spark's Parquet scan itself turns ``stored`` into ``wanted``."""
    return (
        stored == wanted
        or isinstance(stored, _SMALL) and isinstance(wanted, (T.IntegerType, T.LongType, T.DoubleType))
        or isinstance(stored, T.FloatType) and isinstance(wanted, T.DoubleType)
    )


def read_trips(spark: SparkSession, paths: str | Sequence[str], spec: DemandSpec = DemandSpec()) -> DataFrame:
    """Trips from Parquet files, folders or globs: the four columns the pipeline needs.

    Files may store a column under different types, as monthly files of different years do. All
    files whose types Spark's scan widens by itself are one scan, with four columns and pushed filters; the others are
    one scan for each set of types, cast behind it to the common type. A column without a common type is
    an error that names it. Columns that aren't needed may differ in any way.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = merged_schema(spark, paths)
    if schema is not None:
        trips = spark.read.schema(schema).parquet(*paths)
        spec.check(trips)
        return trips.select(*spec.columns)
    groups = schema_groups(spark, list_files(spark, paths), spec.columns)
    wide = []
    for column in spec.columns:
        types = [schema[column].dataType for schema, _ in groups]
        kind = common_type(types)
        if kind is None:
            raise ValueError(f"column {column} has types without a common one: {sorted({t.simpleString() for t in types})}")
        wide.append(T.StructField(column, kind))
    wanted = T.StructType(wide)
    direct: list[str] = []
    scans: list[DataFrame] = []
    for schema, files in groups:
        if all(reads_as(schema[f.name].dataType, f.dataType) for f in wanted):
            direct += files
        else:
            kept = [f if reads_as(schema[f.name].dataType, f.dataType) else schema[f.name] for f in wanted]
            own = spark.read.schema(T.StructType(kept)).parquet(*sorted(files))
            scans.append(own.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted]))
    if direct:
        scans.insert(0, spark.read.schema(wanted).parquet(*sorted(direct)))
    return reduce(DataFrame.unionByName, scans)


def preview(df: DataFrame, rows: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first rows; with ``order_by`` the same ones in every run."""
    return (df.orderBy(*[F.col(c) for c in order_by]) if order_by else df).limit(rows)


def table_schema(spark: SparkSession, path: str) -> DataFrame:
    """(position, column_name, data_type, nullable) of a Parquet table, from the footers alone: no row is read."""
    fields = spark.read.parquet(path).schema
    return spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(fields)],
        "position int, column_name string, data_type string, nullable boolean",
    )


def explore(
    spark: SparkSession, path: str, rows: int = 5, order_by: Sequence[str] | None = None, show: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(schema, first rows) of a Parquet table, printed unless ``show`` is off; see :func:`table_schema` and :func:`preview`.

    Without ``order_by`` the rows come from the first file that has any, and no more of it is read than they need.
    """
    table = spark.read.parquet(path)
    if order_by is not None:
        require_columns(table, order_by)
    schema, first = table_schema(spark, path), preview(table, rows, order_by)
    if show:
        table.printSchema()
        first.show(rows, truncate=False)
    return schema, first
