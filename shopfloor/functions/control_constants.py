"""Shewhart chart factors for subgroups of n."""

from __future__ import annotations

from typing import NamedTuple


class ControlConstants(NamedTuple):
    a2: float
    d3: float
    d4: float
    d2: float


# The published factors for X-bar and R charts, per subgroup size.
CONTROL_CONSTANTS: dict[int, ControlConstants] = {
    2: ControlConstants(a2=1.880, d3=0.0, d4=3.267, d2=1.128),
    3: ControlConstants(a2=1.023, d3=0.0, d4=2.574, d2=1.693),
    4: ControlConstants(a2=0.729, d3=0.0, d4=2.282, d2=2.059),
    5: ControlConstants(a2=0.577, d3=0.0, d4=2.114, d2=2.326),
    6: ControlConstants(a2=0.483, d3=0.0, d4=2.004, d2=2.534),
    7: ControlConstants(a2=0.419, d3=0.076, d4=1.924, d2=2.704),
    8: ControlConstants(a2=0.373, d3=0.136, d4=1.864, d2=2.847),
    9: ControlConstants(a2=0.337, d3=0.184, d4=1.816, d2=2.970),
    10: ControlConstants(a2=0.308, d3=0.223, d4=1.777, d2=3.078),
}
