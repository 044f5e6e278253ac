"""Labels that look ahead to a machine's next failure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions import epoch_micros, guarded_round
from shopfloor.operators.joins import join_on
from shopfloor.operators.ordered import PIECE, POSITION, lay_out
from shopfloor.scratch import materialize

HORIZON_HOURS = 6
MICROS_PER_HOUR = 3_600_000_000
FAILURE_REASONS = ("Equipment Failure", "Unplanned Maintenance")

AT = "__at"
SLOT = "__slot"


def failure_events(
    downtime: DataFrame,
    reason: str = "reason",
    failure_reasons: Sequence[str] = FAILURE_REASONS,
) -> DataFrame:
    """The downtime events that are machine failures."""
    return downtime.where(F.col(reason).isin(*failure_reasons))


def _slot(at: Column, horizon: int) -> Column:
    """Start of the slot of one horizon that holds ``at``, both in microseconds."""
    return at - F.pmod(at, F.lit(horizon))


def _failure_slots(failures: DataFrame, machine: str, ts: str, horizon: int) -> DataFrame:
    """Per machine and slot of one horizon: bounds of its failures and of the next slot's.

    A failure of an unknown machine is nobody's failure.

    A failure at most one horizon ahead lies in the reading's own slot or the next one,
    so each slot's first and last failure, and the next slot's first, decide the label.
    """
    at = epoch_micros(F.col(ts))
    per_slot = (
        failures.where(F.col(ts).isNotNull() & F.col(machine).isNotNull())
        .groupBy(machine, _slot(at, horizon).alias(SLOT))
        .agg(F.min(at).alias("__first"), F.max(at).alias("__last"))
    )
    own_and_previous = F.explode(F.array(F.lit(0), F.lit(horizon)))
    return (
        per_slot.select("*", own_and_previous.alias("__back"))
        .groupBy(machine, (F.col(SLOT) - F.col("__back")).alias(SLOT))
        .agg(
            F.min(F.when(F.col("__back") == 0, F.col("__first"))).alias("__first"),
            F.min(F.when(F.col("__back") == 0, F.col("__last"))).alias("__last"),
            F.min(F.when(F.col("__back") > 0, F.col("__first"))).alias("__upcoming"),
        )
    )


def _with_slots(
    readings: DataFrame,
    failures: DataFrame,
    machine: str,
    ts: str,
    failure_ts: str,
    horizon: int,
) -> DataFrame:
    slots = materialize(
        _failure_slots(failures, machine, failure_ts, horizon), "failure-slots"
    )
    at = epoch_micros(F.col(ts))
    timed = readings.withColumn(AT, at).withColumn(SLOT, _slot(at, horizon))
    return join_on(timed, slots, [machine, SLOT], "left")


def failure_horizon_label(
    readings: DataFrame,
    failures: DataFrame,
    machine: str = "machine_id",
    ts: str = "reading_ts",
    failure_ts: str = "downtime_start_ts",
    horizon_hours: float = HORIZON_HOURS,
    label: str = "will_fail_within_6h",
) -> DataFrame:
    """``readings`` plus 1 where a failure of the machine lies in [t, t + horizon].

    The failures shrink to one row per machine and slot before they meet the readings:
    while that table is small the readings are not shuffled at all, and beyond that
    the join spreads each machine over its slots.
    """
    horizon = int(horizon_hours * MICROS_PER_HOUR)
    slotted = _with_slots(readings, failures, machine, ts, failure_ts, horizon)
    ahead = (F.col(AT) <= F.col("__last")) | (
        F.col("__upcoming") <= F.col(AT) + F.lit(horizon)
    )
    flag = F.coalesce(ahead, F.lit(False)).cast("int")
    return slotted.select(*readings.columns, flag.alias(label))


def next_failure(
    readings: DataFrame,
    failures: DataFrame,
    machine: str = "machine_id",
    ts: str = "reading_ts",
    failure_ts: str = "downtime_start_ts",
    horizon_hours: float = HORIZON_HOURS,
    how: str = "inner",
) -> DataFrame:
    """Each reading with its machine's next failure, at most one horizon ahead.

    Adds ``next_failure_ts`` and ``hours_to_failure``. ``how="inner"`` keeps readings
    that have such a failure, ``how="left"`` keeps all. Unknown machines have none.

    Readings and failures share one timeline per machine and slot of one horizon. The
    first failure of a slot also stands at the end of the slot before, so the nearest
    failure ahead within a slot's timeline is the answer: one shuffle, in which a
    machine is spread over its slots.
    """
    horizon = int(horizon_hours * MICROS_PER_HOUR)
    at = epoch_micros(F.col(ts))
    timed = readings.withColumn(AT, at).withColumn(SLOT, _slot(at, horizon))
    failed = epoch_micros(F.col(failure_ts))
    known = failures.where(F.col(failure_ts).isNotNull() & F.col(machine).isNotNull())
    marks = known.select(machine, failed.alias("__mark"), _slot(failed, horizon).alias(SLOT))
    ahead = marks.groupBy(machine, SLOT).agg(F.min("__mark").alias("__mark")).select(
        machine, "__mark", (F.col(SLOT) - F.lit(horizon)).alias(SLOT)
    )
    marked = marks.distinct().unionByName(ahead).withColumn(AT, F.col("__mark"))
    timeline = timed.withColumn("__is_mark", F.lit(0)).unionByName(
        marked.withColumn("__is_mark", F.lit(1)), allowMissingColumns=True
    )
    # Descending, so the frame grows and each row is visited once.
    upcoming = (
        Window.partitionBy(machine, SLOT)
        .orderBy(F.col(AT).desc(), F.col("__is_mark").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    nearest = F.min("__mark").over(upcoming)
    found = (
        timeline.withColumn("__next", nearest)
        .where(F.col("__is_mark") == 0)
        .withColumn("__next", F.when(F.col("__next") <= F.col(AT) + F.lit(horizon), F.col("__next")))
    )
    return _with_next(found, readings, ts, how)


def next_failure_in_pieces(
    readings: DataFrame,
    failures: DataFrame,
    machine: str = "machine_id",
    ts: str = "reading_ts",
    failure_ts: str = "downtime_start_ts",
    horizon_hours: float = HORIZON_HOURS,
    how: str = "inner",
    tie_break: Sequence[str] = (),
    pieces: int | None = None,
) -> DataFrame:
    """:func:`next_failure` for machines with more rows in one horizon than a task should sort.

    The timeline of readings and failures is range-partitioned on (machine, time, ``tie_break``)
    and written, so a hot machine is cut anywhere, also within a horizon. Each piece carries
    its failures backward to its own readings; what is left looks at the first failure of the
    machine's later pieces, a suffix minimum over one row per (machine, piece). ``tie_break``
    tells readings of one machine and time apart; rows that tie on all of it stay in one piece.
    """
    horizon = int(horizon_hours * MICROS_PER_HOUR)
    timed = readings.withColumn(AT, epoch_micros(F.col(ts))).withColumn("__is_mark", F.lit(0))
    marks = (
        failures.where(F.col(failure_ts).isNotNull() & F.col(machine).isNotNull())
        .select(machine, epoch_micros(F.col(failure_ts)).alias(AT))
        .distinct()
        .select(machine, AT, F.col(AT).alias("__mark"), F.lit(1).alias("__is_mark"))
    )
    timeline = timed.unionByName(marks, allowMissingColumns=True)
    # A failure stands behind the readings of its own time, for which it is the next one.
    order = [AT, "__is_mark", *tie_break]
    keep = [*dict.fromkeys([*readings.columns, machine]), AT, "__mark", "__is_mark"]
    rows = lay_out(timeline, [machine], order, keep, "failure-timeline", pieces)
    # One row per machine and written piece.
    firsts = rows.groupBy(machine, PIECE).agg(F.min("__mark").alias("__first"))
    later = Window.partitionBy(machine).orderBy(F.col(PIECE).desc())
    carried = materialize(
        firsts.select(
            machine,
            PIECE,
            F.min("__first").over(later.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"),
        ),
        "failure-carry",
    )
    # Descending, so the frame grows and each row is visited once.
    within = (
        Window.partitionBy(machine, PIECE)
        .orderBy(F.col(POSITION).desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    nearest = rows.withColumn("__here", F.min("__mark").over(within)).where("__is_mark = 0")
    upcoming = F.coalesce("__here", "__carry")
    found = join_on(nearest, carried, [machine, PIECE], "left").withColumn(
        "__next", F.when(upcoming <= F.col(AT) + F.lit(horizon), upcoming)
    )
    return _with_next(found, readings, ts, how)


def _with_next(found: DataFrame, readings: DataFrame, ts: str, how: str) -> DataFrame:
    """``readings`` with the time in ``__next`` and the hours until then."""
    if how == "inner":
        found = found.where(F.col("__next").isNotNull())
    hours = (F.col("__next") - F.col(AT)) / F.lit(MICROS_PER_HOUR)
    stamp = F.timestamp_micros("__next").cast(readings.schema[ts].dataType)
    return found.select(
        *readings.columns,
        stamp.alias("next_failure_ts"),
        guarded_round(hours, 6).alias("hours_to_failure"),
    )
