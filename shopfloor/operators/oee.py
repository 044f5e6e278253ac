"""Daily quality, daily downtime, availability and OEE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions import exact_sum, guarded_round

PLANNED_HOURS = 24.0


def quality_daily(
    quality: DataFrame,
    machine: str = "machine_id",
    line: str = "line_id",
    date: str = "measured_date",
    in_spec: str = "in_spec",
) -> DataFrame:
    """Units measured, units in spec and their ratio per machine, line and day."""
    rate = F.col("units_in_spec") / F.col("units_measured")
    return (
        quality.groupBy(machine, line, F.col(date).alias("production_date"))
        .agg(
            F.count("*").alias("units_measured"),
            F.sum(in_spec).alias("units_in_spec"),
        )
        .withColumn("quality_rate", guarded_round(rate, 4))
    )


def downtime_daily(
    downtime: DataFrame,
    machine: str = "machine_id",
    line: str = "line_id",
    date: str = "downtime_date",
    hours: str = "downtime_hours",
) -> DataFrame:
    """Hours lost per machine, line and day; an event counts on the day it starts.

    Summed as decimals of six digits, so the order of addition does not matter.
    """
    return downtime.groupBy(machine, line, F.col(date).alias("production_date")).agg(
        exact_sum(hours).alias("downtime_hours")
    )


def availability(downtime_hours: Column, planned_hours: Column) -> Column:
    """Share of the planned hours that was not lost; may be negative."""
    return guarded_round((planned_hours - downtime_hours) / planned_hours, 4)


def machine_daily_oee(
    daily_quality: DataFrame,
    daily_downtime: DataFrame,
    machine: str = "machine_id",
    line: str = "line_id",
    planned_hours: float = PLANNED_HOURS,
    spine: str = "quality",
) -> DataFrame:
    """The gold fact: one row per machine-day that has quality rows.

    Days with downtime but without quality rows do not appear unless ``spine="full"``,
    which gives them no units and an unknown quality rate; units that are unknown for
    another reason stay NULL. Both inputs are grouped on
    the join key, so the join reuses their partitioning.
    """
    how = {"quality": "left", "full": "full"}[spine]
    filled = {"downtime_hours": 0.0}
    if spine == "full":
        daily_quality = daily_quality.withColumn("__measured", F.lit(True))
    absent = F.col("__measured").isNull() if spine == "full" else F.lit(False)
    units = ("units_measured", "units_in_spec")
    return (
        daily_quality.join(daily_downtime, [machine, line, "production_date"], how)
        .withColumns({c: F.when(absent, F.lit(0)).otherwise(F.col(c)) for c in units})
        .drop("__measured")
        .fillna(filled)
        .withColumn("planned_hours", F.lit(float(planned_hours)))
        .withColumn(
            "availability", availability(F.col("downtime_hours"), F.col("planned_hours"))
        )
    )


def line_summary(machine_days: DataFrame, line: str = "line_id") -> DataFrame:
    """Mean availability and quality rate per line."""
    return (
        machine_days.groupBy(line)
        .agg(
            guarded_round(F.avg("availability"), 4).alias("avg_availability"),
            guarded_round(F.avg("quality_rate"), 4).alias("avg_quality_rate"),
        )
        .orderBy(line)
    )


def line_oee(machine_days: DataFrame, line: str = "line_id") -> DataFrame:
    """Line-day OEE: product of the machines' mean availability and mean quality."""
    oee = F.avg("availability") * F.avg("quality_rate")
    return (
        machine_days.groupBy(line, "production_date")
        .agg(
            guarded_round(F.avg("availability"), 4).alias("availability"),
            guarded_round(F.avg("quality_rate"), 4).alias("quality_rate"),
            guarded_round(oee, 4).alias("oee"),
        )
        .select(
            line,
            "production_date",
            "availability",
            "quality_rate",
            F.lit(1.0).cast("decimal(2,1)").alias("performance_assumed"),
            "oee",
        )
    )


def line_oee_with_rate(
    machine_days: DataFrame, target_rates: DataFrame, line: str = "line_id"
) -> DataFrame:
    """Line-day OEE with a performance term.

    ``target_rates`` has (line, ``target_units_per_hour``). Performance is the units
    made per running hour over the target; 1.0 where there is no target. The line-days
    are aggregated before the join, so it runs over few rows.
    """
    line_days = machine_days.groupBy(line, "production_date").agg(
        F.avg("availability").alias("__availability"),
        F.avg("quality_rate").alias("__quality"),
        F.sum("units_measured").alias("__units"),
        F.sum(F.col("planned_hours") - F.col("downtime_hours")).alias("__hours"),
    )
    target_units = F.col("__hours") * F.col("target_units_per_hour")
    performance = F.coalesce(F.try_divide(F.col("__units"), target_units), F.lit(1.0))
    oee = F.col("__availability") * F.col("__quality") * F.col("__performance")
    return (
        line_days.join(target_rates, line, "left")
        .withColumn("__performance", performance)
        .select(
            line,
            "production_date",
            guarded_round(F.col("__availability"), 4).alias("availability"),
            guarded_round(F.col("__quality"), 4).alias("quality_rate"),
            guarded_round(F.col("__performance"), 4).alias("performance"),
            guarded_round(oee, 4).alias("oee"),
        )
    )
