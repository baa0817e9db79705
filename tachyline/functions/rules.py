"""Quality rules as SQL predicates, with SQL's three-valued logic kept on purpose.

A comparison with NULL is NULL, so a row whose only defect is a missing throttle
or coolant value is neither valid nor invalid but undetermined.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Columns that must be present, and inclusive physical ranges.
REQUIRED = ["simulation_id", "step", "engine_rpm", "speed_kmh"]
RANGES = {
    "engine_rpm": (0, 10000),
    "speed_kmh": (0, 500),
    "throttle": (0, 1.1),
    "coolant_temp_c": (-50, 250),
}


def flags() -> dict[str, Column]:
    """One flag per rule; no logical rule exists, its flag keeps its place in the table."""
    missing = [f"{name} IS NULL" for name in REQUIRED]
    outside = [f"{name} < {low} OR {name} > {high}" for name, (low, high) in RANGES.items()]
    return {
        "is_null_violation": F.expr(" OR ".join(missing)),
        "is_range_violation": F.expr(" OR ".join(outside)),
        "is_logical_violation": F.lit(False),
    }
