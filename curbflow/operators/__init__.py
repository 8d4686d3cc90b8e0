from curbflow.operators.clean import REJECT_REASONS, audited_demand, clean_trips, picked_up_between, quality_report
from curbflow.operators.demand import (
    add_trip_features,
    demand_by_window,
    demand_from_trips,
    hourly_demand,
    rollup_demand,
)
from curbflow.operators.features import (
    add_date_features,
    exact_holdout,
    feature_matrix,
    holdout_split,
    is_train_row,
    target_stats,
)
from curbflow.operators.lookup import lookup_join
from curbflow.operators.merge import merge_demand, normalize_stream_demand
from curbflow.operators.model import (
    fit_demand_model,
    load_model,
    model_features,
    model_nodes,
    model_versions,
    predict_by_nodes,
    regression_metrics,
    save_model,
)
from curbflow.operators.score import (
    cache_entries,
    fresh_predictions,
    probe_cache,
    score_all,
    score_requests,
    to_response,
    validate_requests,
)
from curbflow.operators.zones import enrich_with_zone, list_zones, lookup_zones, zone_counts, zone_dimension

__all__ = [
    "REJECT_REASONS", "add_date_features", "add_trip_features", "audited_demand", "cache_entries",
    "clean_trips", "demand_by_window", "demand_from_trips", "enrich_with_zone", "exact_holdout", "feature_matrix",
    "fit_demand_model", "fresh_predictions", "holdout_split", "hourly_demand", "is_train_row",
    "list_zones", "load_model", "lookup_join", "lookup_zones", "merge_demand", "model_features", "model_nodes", "model_versions",
    "normalize_stream_demand", "picked_up_between", "predict_by_nodes", "probe_cache", "quality_report", "regression_metrics", "rollup_demand",
    "save_model", "score_all", "score_requests", "target_stats", "to_response", "validate_requests",
    "zone_counts", "zone_dimension",
]
