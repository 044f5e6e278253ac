from datetime import date

import pytest
from pyspark.sql import functions as F

from shopfloor.functions import guarded_round, spec_flag
from shopfloor.operators import oee, pareto

D = date(2026, 7, 1)


@pytest.fixture
def daily(spark):
    quality = spark.createDataFrame(
        [("M1", "LINE-A", D, f) for f in (1, 1, 1, 0)]
        + [("M2", "LINE-A", D, 1), ("M2", "LINE-A", D, 1)],
        "machine_id string, line_id string, measured_date date, in_spec int",
    )
    downtime = spark.createDataFrame(
        [("M1", "LINE-A", D, 1.5), ("M1", "LINE-A", D, 0.5), ("M3", "LINE-B", D, 2.0)],
        "machine_id string, line_id string, downtime_date date, downtime_hours double",
    )
    return oee.quality_daily(quality), oee.downtime_daily(downtime)


@pytest.fixture
def days(daily):
    return oee.machine_daily_oee(*daily)


def test_full_spine_keeps_days_with_downtime_only(daily):
    found = {r.machine_id: r for r in oee.machine_daily_oee(*daily, spine="full").collect()}
    assert set(found) == {"M1", "M2", "M3"}
    m3 = found["M3"]
    assert (m3.units_measured, m3.quality_rate, m3.availability) == (0, None, 0.9167)


def test_machine_days(days):
    found = {r.machine_id: r for r in days.collect()}
    assert set(found) == {"M1", "M2"}
    m1, m2 = found["M1"], found["M2"]
    assert (m1.units_measured, m1.units_in_spec, m1.quality_rate) == (4, 3, 0.75)
    assert (m1.downtime_hours, m1.planned_hours, m1.availability) == (2.0, 24.0, 0.9167)
    assert (m2.quality_rate, m2.downtime_hours, m2.availability) == (1.0, 0.0, 1.0)


def test_line_oee(days):
    row = oee.line_oee(days).collect()
    assert len(row) == 1
    assert (row[0].availability, row[0].quality_rate, row[0].oee) == (0.9584, 0.875, 0.8386)
    assert str(row[0].performance_assumed) == "1.0"
    summary = oee.line_summary(days).first()
    assert (summary.avg_availability, summary.avg_quality_rate) == (0.9584, 0.875)


def test_line_oee_with_rate(spark, days):
    # 6 units in 46 running hours, against a target of 0.2 per hour.
    rates = spark.createDataFrame(
        [("LINE-A", 0.2)], "line_id string, target_units_per_hour double"
    )
    row = oee.line_oee_with_rate(days, rates).first()
    assert row.performance == pytest.approx(6 / (46 * 0.2), abs=1e-4)
    no_target = oee.line_oee_with_rate(days, rates.where("false")).first()
    assert (no_target.performance, no_target.oee) == (1.0, 0.8386)


def test_availability_may_be_negative(spark):
    row = spark.range(1).select(oee.availability(F.lit(30.0), F.lit(24.0))).first()
    assert row[0] == -0.25


# Published totals: reason, events, hours, share, cumulative share.
PARETO = [
    ("Equipment Failure", 17, 34.80, 0.2279, 22.79),
    ("Unplanned Maintenance", 19, 34.24, 0.2242, 45.21),
    ("Quality Hold", 22, 24.70, 0.1617, 61.38),
    ("Material Shortage", 20, 22.27, 0.1458, 75.96),
    ("Operator Break", 16, 19.41, 0.1271, 88.67),
    ("Changeover", 13, 17.30, 0.1133, 100.0),
]


@pytest.mark.parametrize("pieces", [7, None])
def test_pareto(spark, pieces):
    events = []
    for reason, n, hours, _, _ in PARETO:
        events += [(reason, 0.5)] * (n - 1) + [(reason, round(hours - 0.5 * (n - 1), 2))]
    df = spark.createDataFrame(events, "reason string, downtime_hours double")
    table = pareto.downtime_pareto(df)
    assert [tuple(r) for r in table.collect()] == [row[:4] for row in PARETO]
    running = pareto.with_cumulative(table, pieces=pieces).collect()
    assert [r.cumulative_pct for r in running] == pytest.approx(
        [row[4] for row in PARETO], abs=0.011
    )
    assert [r.reason for r in running] == [row[0] for row in PARETO]


def test_pareto_without_hours(spark):
    df = spark.createDataFrame([("a", 0.0)], "reason string, downtime_hours double")
    assert pareto.downtime_pareto(df).first().pct_of_total_downtime is None


def test_spec_flag_includes_both_ends(spark):
    df = spark.createDataFrame([(49.5,), (50.5,), (50.51,), (None,)], "v double")
    flags = [r[0] for r in df.select(spec_flag(F.col("v"), 50.0, 0.5)).collect()]
    assert flags == [1, 1, 0, None]


def test_guarded_round_lifts_ties(spark):
    df = spark.createDataFrame([(0.95835,), (-0.95835,), (0.0,)], "v double")
    assert [r[0] for r in df.select(guarded_round(F.col("v"), 4)).collect()] == [
        0.9584,
        -0.9584,
        0.0,
    ]


def test_pareto_does_not_depend_on_partitions(spark):
    hours = F.round(F.pmod(F.hash("id"), 10**9) / 100 + 1e7, 2)
    stops = spark.range(200_000).select((F.col("id") % 3).cast("string").alias("reason"), hours.alias("downtime_hours"))
    found = [
        sorted(map(tuple, pareto.downtime_pareto(stops.repartition(n)).collect())) for n in (1, 3, 8)
    ]
    assert found[0] == found[1] == found[2]


def test_unknown_units_stay_unknown(spark):
    day = "date'2026-07-01'"
    quality = spark.sql(f"select 'M1' machine_id, 'A' line_id, {day} measured_date, cast(null as int) in_spec")
    stops = spark.sql(f"select 'M2' machine_id, 'A' line_id, {day} downtime_date, 2.0D downtime_hours")
    for spine, machines in (("quality", 1), ("full", 2)):
        days = oee.machine_daily_oee(oee.quality_daily(quality), oee.downtime_daily(stops), spine=spine)
        rows = {r.machine_id: r for r in days.collect()}
        assert len(rows) == machines
        assert rows["M1"].units_in_spec is None and rows["M1"].quality_rate is None
        assert rows["M1"].downtime_hours == 0
    assert (rows["M2"].units_measured, rows["M2"].units_in_spec) == (0, 0)
