"""Statistical process control: subgroups, control limits, charts, capability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions import CONTROL_CONSTANTS, guarded_round
from shopfloor.operators.joins import join_on
from shopfloor.operators.ordered import with_sequence
from shopfloor.scratch import materialize

SUBGROUP_SIZE = 5
USL = 50.30
LSL = 49.70


def place(
    measurements: DataFrame,
    line: str = "line_id",
    ts: str = "measured_ts",
    tie_break: Sequence[str] = ("machine_id",),
    value: str = "part_dimension_mm",
    pieces: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Each measurement's 0-based ``place`` within its line, in time order.

    ``tie_break`` decides between equal timestamps, and the value between rows that tie
    on that too, so the places of the values never depend on the arrangement of the
    rows. To cut a hot line anywhere, ``ts`` and ``tie_break`` have to identify a
    measurement (see :mod:`shopfloor.operators.ordered`). Measurements without a value
    are left out. Only line, time and value are kept unless ``keep`` says otherwise.
    """
    return with_sequence(
        measurements.where(F.col(value).isNotNull()),
        key=[line],
        order=list(dict.fromkeys([ts, *tie_break, value])),
        keep=[line, ts, value] if keep is None else keep,
        name="place",
        pieces=pieces,
    )


def group_placed(
    placed: DataFrame,
    line: str = "line_id",
    ts: str = "measured_ts",
    value: str = "part_dimension_mm",
    size: int = SUBGROUP_SIZE,
) -> DataFrame:
    """Full groups of ``size`` consecutive places; a partial one gives no row."""
    index = F.floor(F.col("place") / size).cast("bigint")
    return (
        placed.groupBy(line, index.alias("subgroup_index"))
        .agg(
            F.count("*").alias("__n"),
            F.min(ts).alias("subgroup_start_ts"),
            F.avg(value).alias("xbar"),
            (F.max(value) - F.min(value)).alias("range"),
        )
        .where(F.col("__n") == size)
        .drop("__n")
    )


def subgroups(
    measurements: DataFrame,
    line: str = "line_id",
    ts: str = "measured_ts",
    tie_break: Sequence[str] = ("machine_id",),
    value: str = "part_dimension_mm",
    size: int = SUBGROUP_SIZE,
    pieces: int | None = None,
) -> DataFrame:
    """Consecutive groups of ``size`` measurements per line, in time order.

    One row per full subgroup: ``line, subgroup_index, subgroup_start_ts, xbar,
    range``. A line's trailing partial subgroup is dropped, so a line with fewer than
    ``size`` rows gives no row. See :func:`place` for the order and ``tie_break``.
    The result is written once, because limits and charts both read it.
    """
    placed = place(measurements, line, ts, tie_break, value, pieces)
    return materialize(group_placed(placed, line, ts, value, size), "subgroups")


def control_limits(
    groups: DataFrame, line: str = "line_id", size: int = SUBGROUP_SIZE
) -> DataFrame:
    """One row per line: grand mean, mean range and the limits of both charts.

    Written once, so Spark knows the size of this side when it joins it to subgroups.
    """
    factors = CONTROL_CONSTANTS[size]
    centre, spread = F.col("xbar_bar"), F.col("r_bar")
    limits = (
        groups.groupBy(line)
        .agg(
            F.count("*").alias("n_subgroups"),
            F.avg("xbar").alias("xbar_bar"),
            F.avg("range").alias("r_bar"),
        )
        .withColumns(
            {
                "ucl_xbar": centre + factors.a2 * spread,
                "lcl_xbar": centre - factors.a2 * spread,
                "ucl_r": factors.d4 * spread,
                "lcl_r": factors.d3 * spread,
            }
        )
    )
    return materialize(limits, "limits")


def capability(
    limits: DataFrame, usl: float = USL, lsl: float = LSL, size: int = SUBGROUP_SIZE
) -> DataFrame:
    """``limits`` plus ``sigma_hat, cpu, cpl, cpk``; a line without spread gets NULLs."""
    three_sigma = 3 * F.col("sigma_hat")
    return (
        limits.withColumn("sigma_hat", F.col("r_bar") / CONTROL_CONSTANTS[size].d2)
        .withColumns(
            {
                "cpu": F.try_divide(F.lit(usl) - F.col("xbar_bar"), three_sigma),
                "cpl": F.try_divide(F.col("xbar_bar") - F.lit(lsl), three_sigma),
            }
        )
        .withColumn("cpk", F.least("cpu", "cpl"))
    )


def outside(value: Column, lower: Column, upper: Column) -> Column:
    """1 where the value lies strictly outside its limits.

    Without spread the limits collapse onto the mean; such a line has no signal, and
    the comparison would only test rounding noise.
    """
    beyond = (value > upper) | (value < lower)
    return F.when(F.col("r_bar") > 0, beyond.cast("int")).otherwise(F.lit(0))


def with_limits(groups: DataFrame, limits: DataFrame, line: str = "line_id") -> DataFrame:
    """Each subgroup with its line's limits, which may be those of an earlier period."""
    return join_on(groups, limits.drop("n_subgroups"), [line])


def control_chart(
    groups: DataFrame,
    limits: DataFrame | None = None,
    line: str = "line_id",
    size: int = SUBGROUP_SIZE,
    keep_index: bool = False,
) -> DataFrame:
    """X-bar chart: one row per subgroup, flagged first and rounded afterwards."""
    if limits is None:
        limits = control_limits(groups, line, size)
    index = ["subgroup_index"] if keep_index else []
    return with_limits(groups, limits, line).select(
        line,
        *index,
        "subgroup_start_ts",
        guarded_round(F.col("xbar"), 4).alias("xbar"),
        guarded_round(F.col("range"), 4).alias("range"),
        guarded_round(F.col("ucl_xbar"), 4).alias("ucl_xbar"),
        guarded_round(F.col("lcl_xbar"), 4).alias("lcl_xbar"),
        guarded_round(F.col("xbar_bar"), 4).alias("centerline_xbar"),
        outside(F.col("xbar"), F.col("lcl_xbar"), F.col("ucl_xbar")).alias(
            "out_of_control"
        ),
    )


def range_chart(
    groups: DataFrame,
    limits: DataFrame | None = None,
    line: str = "line_id",
    size: int = SUBGROUP_SIZE,
) -> DataFrame:
    """R chart: one row per subgroup, its range against the range limits."""
    if limits is None:
        limits = control_limits(groups, line, size)
    return with_limits(groups, limits, line).select(
        line,
        "subgroup_start_ts",
        guarded_round(F.col("range"), 4).alias("range"),
        guarded_round(F.col("ucl_r"), 4).alias("ucl_r"),
        guarded_round(F.col("lcl_r"), 4).alias("lcl_r"),
        guarded_round(F.col("r_bar"), 4).alias("centerline_r"),
        outside(F.col("range"), F.col("lcl_r"), F.col("ucl_r")).alias("out_of_control"),
    )


def capability_report(
    groups: DataFrame,
    limits: DataFrame | None = None,
    line: str = "line_id",
    usl: float = USL,
    lsl: float = LSL,
    size: int = SUBGROUP_SIZE,
) -> DataFrame:
    """One row per line: spread, Cpk, and how many subgroups are out of control."""
    if limits is None:
        limits = control_limits(groups, line, size)
    flag = outside(F.col("xbar"), F.col("lcl_xbar"), F.col("ucl_xbar"))
    # A line's limits are the same on each of its subgroups, so any copy will do.
    summary = (
        with_limits(groups, limits, line)
        .groupBy(line)
        .agg(
            F.count("*").alias("n_subgroups"),
            F.max("xbar_bar").alias("xbar_bar"),
            F.max("r_bar").alias("r_bar"),
            F.sum(flag).alias("out_of_control_subgroups"),
        )
    )
    share = F.col("out_of_control_subgroups") / F.col("n_subgroups")
    return capability(summary, usl, lsl, size).select(
        line,
        "n_subgroups",
        guarded_round(F.col("xbar_bar"), 4).alias("xbar_bar"),
        guarded_round(F.col("r_bar"), 4).alias("r_bar"),
        guarded_round(F.col("sigma_hat"), 4).alias("sigma_hat"),
        guarded_round(F.col("cpk"), 3).alias("cpk"),
        "out_of_control_subgroups",
        guarded_round(share, 4).alias("out_of_control_pct"),
    )


def first_subgroups(chart: DataFrame, n: int = 80) -> DataFrame:
    """The first ``n`` points of every line's chart; needs ``subgroup_index``."""
    return chart.where(F.col("subgroup_index") < n)
