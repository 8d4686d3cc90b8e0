from curbflow.sources.demand import load_demand, read_demand, read_optional, replace_dates, write_demand
from curbflow.sources.predictions import append_predictions, expire_predictions, read_predictions, stored_predictions
from curbflow.sources.trips import explore, preview, read_trips, table_schema
from curbflow.sources.zones import count_missing_ids, load_zones, read_zone_csv

__all__ = [
    "append_predictions", "count_missing_ids", "expire_predictions", "explore", "load_demand", "load_zones", "preview",
    "read_demand", "read_optional", "read_predictions", "read_trips", "read_zone_csv", "replace_dates", "stored_predictions", "table_schema", "write_demand",
]
