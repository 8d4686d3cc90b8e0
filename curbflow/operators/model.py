"""The demand model: MLlib gradient-boosted trees behind a feature assembler."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.operators.lookup import lookup_join
from curbflow.session import delete_path, ensure_checkpoint_dir, scratch_path
from curbflow.spec import FEATURES, TARGET, require_columns

_WEIGHT = "weight"
# Merged rows a task of the fit holds; every round passes over all of them once per tree level.
_ROWS_PER_TASK = 100_000


def fit_demand_model(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    rounds: int = 100,
    depth: int = 6,
    learning_rate: float = 0.3,
    bins: int = 256,
    seed: int = 42,
    tasks: int | None = None,
) -> PipelineModel:
    """Fit squared-error boosted trees on plain numeric features.

    Rows with equal features are first merged into one row with their mean
    target and their number as weight. Split gains and leaf values under
    squared error depend on the rows only through these, so the trees are
    those of the full table, while the rows that every tree level passes
    over are bounded by the feature combinations (weekday x month x hour x
    zone), however many dates there are. Rows without a target or a feature
    take no part.

    Each round depends on the one before, so every tenth is checkpointed in
    the shared folder: a lost executor then costs ten rounds at most.
    The merged rows are dealt into one task per ``_ROWS_PER_TASK`` of them,
    not the shuffle's partitions, which every round would otherwise pass
    over; ``tasks`` fixes their number instead.
    """
    require_columns(train, [*features, target])
    ensure_checkpoint_dir(train.sparkSession)
    combined = fit_rows(train, features, target, tasks)
    try:
        assembler = VectorAssembler(inputCols=list(features), outputCol="features")
        trees = GBTRegressor(
            featuresCol="features", labelCol=target, predictionCol="prediction", weightCol=_WEIGHT,
            lossType="squared", maxIter=rounds, maxDepth=depth, stepSize=learning_rate, maxBins=bins,
            seed=seed, checkpointInterval=10,
        )
        return Pipeline(stages=[assembler, trees]).fit(combined)
    finally:
        combined.unpersist()


def fit_rows(train: DataFrame, features: Sequence[str], target: str = TARGET, tasks: int | None = None) -> DataFrame:
    """The merged rows a fit reads, persisted in ``tasks`` partitions, or as many as their number asks for."""
    combined = combine_equal_rows(train, features, target)
    if tasks is None:
        tasks = max(1, -(-combined.count() // _ROWS_PER_TASK))
    return combined.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)


def combine_equal_rows(rows: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """One row per combination of features: mean target and number of rows."""
    return (
        rows.dropna(subset=[*features, target])
        .groupBy(*features)
        .agg(F.avg(target).alias(target), F.count(F.lit(1)).cast("double").alias(_WEIGHT))
    )


def regression_metrics(scored: DataFrame, target: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """One row with root mean squared error and mean absolute error, from one aggregate."""
    error = F.col(target) - F.col(prediction)
    return scored.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def model_nodes(model: PipelineModel) -> DataFrame:
    """The trees as a table: (tree, weight, node, left, right, feature, threshold, value), one row per node.

    A leaf has no children and predicts ``value``; another node sends rows whose ``feature`` is at most ``threshold`` to
    ``left``. The table comes from the model's own saved form, written to the shared folder, and is bounded by the number of rounds
    and the depth, not by the data.
    """
    trees = model.stages[-1]
    spark = SparkSession.active()
    path = scratch_path(spark, "model-nodes")
    trees.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata")
    number, _, weight = weights.columns
    node = F.col("nodeData")
    names = F.array(*[F.lit(name) for name in model_features(model)])
    inner = node["leftChild"] >= 0
    return spark.read.parquet(f"{path}/data").withColumnRenamed("treeID", "tree").join(
        F.broadcast(weights.select(F.col(number).cast("int").alias("tree"), F.col(weight).cast("double").alias("weight"))), "tree"
    ).select(
        "tree", "weight", node["id"].alias("node"), F.when(inner, node["leftChild"]).alias("left"), F.when(inner, node["rightChild"]).alias("right"),
        F.when(inner, F.get(names, node["split"]["featureIndex"])).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"), node["prediction"].alias("value"),
    )


def predict_by_nodes(rows: DataFrame, nodes: DataFrame, features: Sequence[str], depth: int) -> DataFrame:
    """``rows`` with the ``prediction`` of the trees in ``nodes``, by joins alone: no model object is needed.

    Each combination of features walks down all trees at once, a level a join with the broadcast nodes; rows then look
    their combination up. Rows that lack a feature get no prediction.
    """
    require_columns(rows, features)
    held = stage_nodes(nodes)
    trees = [row[0] for row in held.select("tree").distinct().collect()]
    place = rows.select(*features).dropna().distinct().withColumn("tree", F.explode(F.lit(trees))).withColumn("at", F.lit(0))
    at_node = F.broadcast(held.withColumnRenamed("node", "at"))
    own = F.coalesce(*[F.when(F.col("feature") == name, F.col(name).cast("double")) for name in features])
    down = F.when(F.col("left").isNull(), F.col("at")).when(own <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
    for _ in range(depth):
        place = place.join(at_node, ["tree", "at"]).select(*features, "tree", down.alias("at"))
    ends = place.join(at_node, ["tree", "at"])
    totals = ends.groupBy(*features).agg(F.sum(F.col("weight") * F.col("value")).alias("prediction"))
    return lookup_join(rows, totals, list(features))


def stage_nodes(nodes: DataFrame) -> DataFrame:
    """The node table as plain rows: its size is bounded by the model, and every level reads it."""
    return nodes.sparkSession.createDataFrame(nodes.collect(), nodes.schema)


def model_features(model: PipelineModel) -> list[str]:
    """Ordered input columns, as stored in the model's assembler stage."""
    return list(model.stages[0].getInputCols())


def save_model(model: PipelineModel, path: str, about: dict | None = None, keep: int = 2) -> int:
    """Save a model as the next version under ``path`` and return the version's number.

    The files are written to a folder of their own; a numbered commit then makes it the current version, so a
    reader gets the version before or this one, whole, at any time. ``about`` (metrics, dates, anything JSON can
    hold) is stored with it. Files of versions before the last ``keep`` are deleted.
    """
    from curbflow.sources.commits import commit_next, numbers, prune, read_commit

    spark = SparkSession.active()
    folder = f"versions/{uuid.uuid4().hex}"
    model.write().save(f"{path.rstrip('/')}/{folder}")
    content = {"model": folder, "features": model_features(model), "about": about or {}}
    number, _ = commit_next(spark, path, lambda old: content)
    for past in numbers(spark, path)[:-keep]:
        delete_path(spark, f"{path.rstrip('/')}/{read_commit(spark, path, past)['model']}")
    prune(spark, path, keep)
    return number


def model_versions(path: str) -> list[dict]:
    """The versions on disk, oldest first: number, features and what was stored about each."""
    from curbflow.sources.commits import numbers, read_commit

    spark = SparkSession.active()
    return [{"version": n, **read_commit(spark, path, n)} for n in numbers(spark, path)]


def load_model(path: str, version: int | None = None) -> PipelineModel:
    """The current version of a saved model, or the one with the given number."""
    from curbflow.sources.commits import latest, read_commit

    spark = SparkSession.active()
    found = latest(spark, path) if version is None else (version, read_commit(spark, path, version))
    if found is None:
        raise ValueError(f"no model at {path}")
    return PipelineModel.load(f"{path.rstrip('/')}/{found[1]['model']}")
