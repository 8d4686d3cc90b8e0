"""curbflow: trip demand by date, hour and zone, computed with Spark DataFrames.

Every operator takes DataFrames and returns DataFrames; the ones that need
to run a Spark job while the plan is being built say so in their docstring.
"""

from curbflow.spec import DEMAND_COLS, DEMAND_KEYS, FEATURES, DemandSpec

__all__ = ["DEMAND_COLS", "DEMAND_KEYS", "FEATURES", "DemandSpec"]
