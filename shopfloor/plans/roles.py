"""The provided tables in the roles of shop-floor tables.

An event type stands for a production line, a user for a machine, an ``error`` event for a failure
or a stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.functions import spec_flag
from shopfloor.sources.readers import read_parquet

TARGET, TOLERANCE = 50.0, 30.0


def in_spec() -> Column:
    return spec_flag(F.col("value"), TARGET, TOLERANCE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("line_id"),
        "event_id",
        F.col("ts").alias("measured_ts"),
        F.col("value").alias("part_dimension_mm"),
    )


def stops_as_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stops as the raw table of downtime events."""
    rows = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return rows.select(
        F.concat(F.lit("M"), F.col("user_id")).alias("machine_id"),
        F.concat(F.lit("L"), F.col("user_id") % 5).alias("line_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("downtime_start_ts"),
        (F.col("value") / 100).alias("downtime_hours"),
        F.lit("Equipment Failure").alias("reason"),
    )
