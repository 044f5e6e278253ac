"""Downtime by reason, as a Pareto table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions import exact_sum, guarded_round
from shopfloor.operators.ordered import with_running_total
from shopfloor.scratch import materialize


def downtime_pareto(
    downtime: DataFrame, reason: str = "reason", hours: str = "downtime_hours"
) -> DataFrame:
    """Events, hours and share of all hours per reason, largest first.

    Shares are taken of the sum of the rounded totals. The totals are written once,
    so the events are scanned once and the grand total is a subquery over them.
    """
    by_reason = materialize(
        downtime.groupBy(reason).agg(
            F.count("*").alias("event_count"),
            guarded_round(exact_sum(hours), 2).alias("total_downtime_hours"),
        ),
        "downtime-by-reason",
    )
    return with_share(by_reason, reason)


def with_share(by_reason: DataFrame, reason: str = "reason") -> DataFrame:
    """Totals per reason plus their share of all, largest first; read twice."""
    grand_total = by_reason.agg(F.sum("total_downtime_hours")).scalar()
    share = F.try_divide(F.col("total_downtime_hours"), grand_total)
    return by_reason.withColumn("pct_of_total_downtime", guarded_round(share, 4)).orderBy(
        F.desc("total_downtime_hours"), reason
    )


def with_cumulative(
    pareto: DataFrame, reason: str = "reason", pieces: int | None = None
) -> DataFrame:
    """``pareto`` plus the running percentage down the list, largest first."""
    ranked = pareto.withColumn("__rank_key", -F.col("total_downtime_hours"))
    total = with_running_total(
        ranked,
        ["__rank_key", reason],
        "pct_of_total_downtime",
        "__running",
        pieces,
    )
    return (
        total.withColumn("cumulative_pct", guarded_round(F.col("__running") * 100, 2))
        .drop("__rank_key", "__running")
        .orderBy(F.desc("total_downtime_hours"), reason)
    )
