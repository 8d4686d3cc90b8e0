from curbflow.streaming.demand import append_late_windows, late_windows, start_demand_stream, unique_trips

__all__ = ["append_late_windows", "late_windows", "start_demand_stream", "unique_trips"]
