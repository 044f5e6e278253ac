"""Declared schemas of the shop-floor tables.

Reading with a declared schema saves the pass that inference costs, and keeps types
stable from one delivery to the next.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
TIMESTAMP, DATE = T.TimestampType(), T.DateType()


def _struct(*columns: tuple[str, T.DataType], nullable: bool = True) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind in columns])


MACHINES = _struct(
    ("machine_id", STRING),
    ("line_id", STRING),
    ("machine_type", STRING),
    ("install_date", DATE),
)
SENSOR_READINGS = _struct(
    ("machine_id", STRING),
    ("line_id", STRING),
    ("reading_ts", TIMESTAMP),
    ("temperature_c", DOUBLE),
    ("vibration_mm_s", DOUBLE),
    ("pressure_psi", DOUBLE),
    ("latent_wear", DOUBLE),
    ("will_fail_within_6h", INT),
)
QUALITY_MEASUREMENTS = _struct(
    ("machine_id", STRING),
    ("line_id", STRING),
    ("measured_ts", TIMESTAMP),
    ("part_dimension_mm", DOUBLE),
    ("in_spec", INT),
)
DOWNTIME_EVENTS = _struct(
    ("machine_id", STRING),
    ("line_id", STRING),
    ("downtime_start_ts", TIMESTAMP),
    ("downtime_hours", DOUBLE),
    ("reason", STRING),
)
SHIFT_LOG = _struct(
    ("line_id", STRING),
    ("shift_date", DATE),
    ("shift", STRING),
    ("planned_production_hours", DOUBLE),
)

RAW_TABLES: dict[str, T.StructType] = {
    "machines": MACHINES,
    "sensor_readings": SENSOR_READINGS,
    "quality_measurements": QUALITY_MEASUREMENTS,
    "downtime_events": DOWNTIME_EVENTS,
    "shift_log": SHIFT_LOG,
}

# Staging projections of the warehouse.
STG_MACHINE_DAILY_OEE = _struct(
    ("machine_id", STRING),
    ("line_id", STRING),
    ("production_date", DATE),
    ("units_measured", INT),
    ("units_in_spec", INT),
    ("quality_rate", DOUBLE),
    ("downtime_hours", DOUBLE),
    ("planned_hours", DOUBLE),
    ("availability", DOUBLE),
)
STG_DOWNTIME_EVENTS = DOWNTIME_EVENTS


@dataclass(frozen=True)
class ServingTable:
    """A published table: exact types, key, text lengths and renamed columns."""

    schema: T.StructType
    key: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)


SERVED_MACHINE_DAILY_OEE = ServingTable(
    schema=_struct(
        ("machine_id", STRING),
        ("line_id", STRING),
        ("production_date", DATE),
        ("units_measured", INT),
        ("units_in_spec", INT),
        ("quality_rate", T.DecimalType(6, 4)),
        ("downtime_hours", T.DecimalType(6, 2)),
        ("planned_hours", T.DecimalType(6, 2)),
        ("availability", T.DecimalType(6, 4)),
        nullable=False,
    ),
    key=("machine_id", "production_date"),
    max_length={"machine_id": 8, "line_id": 8},
)
SERVED_CONTROL_CHART = ServingTable(
    schema=_struct(
        ("line_id", STRING),
        ("subgroup_start_ts", TIMESTAMP),
        ("xbar", T.DecimalType(8, 4)),
        ("range_val", T.DecimalType(8, 4)),
        ("ucl_xbar", T.DecimalType(8, 4)),
        ("lcl_xbar", T.DecimalType(8, 4)),
        ("centerline_xbar", T.DecimalType(8, 4)),
        ("out_of_control", T.BooleanType()),
        nullable=False,
    ),
    max_length={"line_id": 8},
    renames={"range": "range_val"},
)
SERVED_CAPABILITY = ServingTable(
    schema=_struct(
        ("line_id", STRING),
        ("n_subgroups", INT),
        ("cpk", T.DecimalType(6, 3)),
        ("out_of_control_subgroups", INT),
        ("out_of_control_pct", T.DecimalType(6, 4)),
        nullable=False,
    ),
    key=("line_id",),
    max_length={"line_id": 8},
)
