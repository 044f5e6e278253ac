"""Results must not depend on row order or on the number of partitions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopfloor.operators import evaluation, labels, oee, pareto, silver

START = datetime(2026, 7, 1)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(11)
    rows = []
    for i in range(800):
        # A third of the rows belong to one machine.
        machine = "M0" if i % 3 == 0 else f"M{rng.randrange(1, 9)}"
        line = f"LINE-{int(machine[1]) % 3}"
        ts = START + timedelta(minutes=rng.randrange(0, 60 * 24 * 4))
        rows.append((i, machine, line, ts, round(rng.uniform(0, 4), 2), rng.random() < 0.2))
    return spark.createDataFrame(
        rows,
        "id int, machine_id string, line_id string, ts timestamp, hours double, stopped boolean",
    )


def machine_days(df):
    made = df.where("not stopped").select(
        "machine_id",
        "line_id",
        F.to_date("ts").alias("measured_date"),
        (F.col("hours") < 2).cast("int").alias("in_spec"),
    )
    stops = df.where("stopped").select(
        "machine_id",
        "line_id",
        F.to_date("ts").alias("downtime_date"),
        F.col("hours").alias("downtime_hours"),
    )
    return oee.machine_daily_oee(oee.quality_daily(made), oee.downtime_daily(stops))


CASES = {
    "line_oee": lambda df: oee.line_oee(machine_days(df)),
    "machine_daily_oee": machine_days,
    "pareto": lambda df: pareto.with_cumulative(
        pareto.downtime_pareto(df, "machine_id", "hours"), "machine_id"
    ),
    "auc": lambda df: evaluation.roc_auc(
        df.select(F.col("stopped").cast("int").alias("label"), F.col("hours").alias("score"))
    ),
    "label": lambda df: labels.failure_horizon_label(
        df, df.where("stopped").select("machine_id", F.col("ts").alias("downtime_start_ts")), ts="ts"
    ),
    "dedup": lambda df: silver.deduplicate(df, ["machine_id", "line_id"], ["ts", "id"]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_invariance(events, name):
    results = [
        sorted(map(str, CASES[name](shuffled).collect()))
        for shuffled in (
            events.coalesce(1),
            events.orderBy(F.rand(1)).repartition(8),
            events.orderBy(F.rand(2)).repartition(32, "machine_id"),
        )
    ]
    assert results[0]
    assert results[0] == results[1] == results[2]
