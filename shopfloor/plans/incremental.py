"""The layers by increments: a delivery rebuilds the days it touches and no others.

A delivery has a number. Its raw rows land under (day, delivery), so a repeated delivery replaces
itself, and the days it holds are the days to rebuild. For these alone

* silver is recomputed from all deliveries' raw rows of the day (copies share their time, hence
  their day, so deduplication stays within a day),
* the machine-day fact and the line mart are recomputed from the silver rows of the day,
* the stops are totalled by reason and day, from which the Pareto mart is summed.

Every layer is stored by day and replaced by dynamic overwrite: folders of other days are neither
read nor written. A delivery
that was interrupted anywhere is repeated under its number; each step depends on what lies in the
layer before, not on what the step itself has left behind.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions import guarded_round
from shopfloor.operators import oee, pareto, silver
from shopfloor.plans.medallion import together
from shopfloor.scratch import materialize
from shopfloor.sources.writers import write_by_date

Tables = dict[str, DataFrame]

BATCH = "delivery"
DAY = "production_date"


@dataclass(frozen=True)
class Fact:
    """A raw fact table: its time, its day, its key if copies go, and what orders arrivals."""

    name: str
    ts: str
    date: str
    key: tuple[str, ...] = ()
    arrival: tuple[str, ...] = ()


def land(raw: DataFrame, target: str, fact: Fact, batch: int) -> tuple[DataFrame, DataFrame]:
    """Store a delivery's rows by (day, delivery); returns the raw table and the touched days.

    Rows without a time go to ``rejects``, under their delivery.
    """
    timed = materialize(
        silver.typed(raw, fact.ts, fact.date).withColumn(BATCH, F.lit(batch)), "delivery"
    )
    good, rest = silver.split_valid(timed, F.col(fact.date).isNotNull())
    _replace(rest.drop(fact.date), f"{target}/rejects/{fact.name}", [BATCH])
    bronze = _replace(good, f"{target}/bronze/{fact.name}", [fact.date, BATCH])
    touched = good.groupBy(F.col(fact.date).alias("day")).agg(F.count("*").alias("n_rows"))
    return bronze, touched.select(
        F.lit(fact.name).alias("table_name"), "day", F.lit(batch).alias(BATCH), "n_rows"
    )


def _replace(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Overwrite the folders that ``df`` has rows for; returns a scan of the table."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def of_days(rows: DataFrame, column: str, days: Iterable[date]) -> DataFrame:
    """The rows of some days of a table stored by day; folders of other days are not opened."""
    return rows.where(F.col(column).isin(sorted(days)))


def rebuild_silver(
    bronze: DataFrame, target: str, fact: Fact, days: Iterable[date]
) -> DataFrame:
    """The fact's silver rows of ``days``, from all deliveries; the first copy of a key stays."""
    rows = of_days(bronze, fact.date, days)
    if fact.key:
        rows = silver.deduplicate(rows, fact.key, [BATCH, *fact.arrival])
    clean = rows.drop(BATCH, *fact.arrival)
    return write_by_date(clean, f"{target}/silver/{fact.name}", fact.date, replace_all=False)


def reason_days(stops: DataFrame, date: str, reason: str, hours: str) -> DataFrame:
    """Stops and hours, as exact decimals, per day and reason: any span can be summed from them."""
    return stops.groupBy(F.col(date).alias(DAY), reason).agg(
        F.count("*").alias("event_count"),
        F.sum(F.col(hours).cast("decimal(28,6)")).alias("hours"),
    )


def run_increment(
    quality_raw: DataFrame,
    downtime_raw: DataFrame,
    target: str,
    batch: int,
    quality: Fact,
    downtime: Fact,
    planned_hours: float = oee.PLANNED_HOURS,
    in_spec: str = "in_spec",
    hours: str = "downtime_hours",
    reason: str = "reason",
) -> Tables:
    """Take one delivery in; returns the layers, and its part of the manifest."""
    landed = together(
        {
            "quality": partial(land, quality_raw, target, quality, batch),
            "stops": partial(land, downtime_raw, target, downtime, batch),
        }
    )
    (measured_raw, measured_days), (stopped_raw, stopped_days) = landed["quality"], landed["stops"]
    manifest = materialize(measured_days.unionByName(stopped_days), "touched-days")
    # One row per table and day of the delivery: a calendar bounds them.
    touched = manifest.select("table_name", "day").collect()
    days, own = set(), {quality.name: set(), downtime.name: set()}
    for row in touched:
        days.add(row["day"])
        own[row["table_name"]].add(row["day"])
    clean = together(
        {
            "quality": partial(rebuild_silver, measured_raw, target, quality, own[quality.name]),
            "stops": partial(rebuild_silver, stopped_raw, target, downtime, own[downtime.name]),
        }
    )
    measured, stopped = clean["quality"], clean["stops"]

    def rebuild_gold() -> DataFrame:
        lost = of_days(stopped, downtime.date, days)
        facts = oee.machine_daily_oee(
            oee.quality_daily(
                of_days(measured, quality.date, days), date=quality.date, in_spec=in_spec
            ),
            oee.downtime_daily(lost, date=downtime.date, hours=hours),
            planned_hours=planned_hours,
        )
        return write_by_date(facts, f"{target}/gold/fct_machine_daily_oee", DAY, replace_all=False)

    def rebuild_totals() -> DataFrame:
        stops = of_days(stopped, downtime.date, own[downtime.name])
        by_reason = reason_days(stops, downtime.date, reason, hours)
        return write_by_date(by_reason, f"{target}/gold/downtime_by_reason", DAY, replace_all=False)

    facts = together({"gold": rebuild_gold, "totals": rebuild_totals})
    gold, totals = facts["gold"], facts["totals"]
    line_days = oee.line_oee(of_days(gold, DAY, days))
    mart = write_by_date(line_days, f"{target}/marts/fct_line_oee", DAY, replace_all=False)
    return {
        "fct_machine_daily_oee": gold,
        "fct_line_oee": mart,
        "downtime_by_reason": totals,
        "manifest": _replace(manifest, f"{target}/manifest", [BATCH]),
    }


def pareto_of_days(totals: DataFrame, reason: str = "reason") -> DataFrame:
    """The downtime Pareto over all days, from the totals by day and reason."""
    by_reason = materialize(
        totals.groupBy(reason).agg(
            F.sum("event_count").alias("event_count"),
            guarded_round(F.sum("hours").cast("double"), 2).alias("total_downtime_hours"),
        ),
        "downtime-by-reason",
    )
    return pareto.with_share(by_reason, reason)
