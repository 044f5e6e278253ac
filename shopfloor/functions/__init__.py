"""Column expressions; every one stays inside Spark's generated code."""

from shopfloor.functions.columns import (
    capability_grade,
    epoch_micros,
    exact_sum,
    guarded_round,
    hash_bucket,
    spec_flag,
)
from shopfloor.functions.control_constants import CONTROL_CONSTANTS, ControlConstants

__all__ = [
    "CONTROL_CONSTANTS",
    "ControlConstants",
    "capability_grade",
    "epoch_micros",
    "exact_sum",
    "guarded_round",
    "hash_bucket",
    "spec_flag",
]
