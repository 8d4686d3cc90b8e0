"""Demand tables to a fitted, measured and saved model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from curbflow.operators.features import add_date_features, holdout_split, target_stats
from curbflow.operators.model import fit_demand_model, regression_metrics, save_model
from curbflow.spec import DEMAND_KEYS, FEATURES, TARGET


@dataclass(frozen=True)
class TrainingResult:
    model: PipelineModel
    stats: Row
    metrics: Row


def train_demand_model(
    demand: DataFrame,
    features: Sequence[str] = FEATURES,
    model_path: str | None = None,
    rounds: int = 100,
    seed: int = 42,
    **fit_options,
) -> TrainingResult:
    """Add features, split 80/20, fit, measure on the hold-out and save as the next version of ``model_path``.

    Target statistics, hold-out errors and the dates of the demand are stored with the version.

    The feature table is read by several passes and is therefore kept in
    memory, or on disk beyond that, until the model is measured. Rows that
    lack a feature (no date, say) count in the statistics only.
    """
    columns = dict.fromkeys([*DEMAND_KEYS, *features, TARGET])
    featured = add_date_features(demand).select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = target_stats(featured).first()
        dates = featured.agg(F.min("date_str").cast("string").alias("first_date"), F.max("date_str").cast("string").alias("last_date")).first()
        train, test = holdout_split(featured, seed=seed)
        model = fit_demand_model(train, features, rounds=rounds, seed=seed, **fit_options)
        scorable = test.dropna(subset=[*features, TARGET])
        metrics = regression_metrics(model.transform(scorable)).first()
    finally:
        featured.unpersist()
    if model_path is not None:
        about = {"rounds": rounds, "seed": seed, **{k: v for row in (stats, metrics, dates) for k, v in row.asDict().items()}}
        save_model(model, model_path, about)
    return TrainingResult(model, stats, metrics)
