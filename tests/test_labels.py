import random
from bisect import bisect_left
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopfloor.operators import labels
from shopfloor.operators.ordered import PIECE

T0 = datetime(2026, 7, 10, 9, 40)


def minutes(n):
    return T0 + timedelta(minutes=n)


def test_horizon_is_inclusive_at_both_ends(spark):
    readings = spark.createDataFrame(
        [("M1", minutes(m)) for m in (-370, -360, 0, 10)] + [("M2", T0)],
        "machine_id string, reading_ts timestamp",
    )
    downtime = spark.createDataFrame(
        [("M1", T0, "Equipment Failure"), ("M2", T0, "Changeover")],
        "machine_id string, downtime_start_ts timestamp, reason string",
    )
    found = labels.failure_horizon_label(readings, labels.failure_events(downtime))
    flags = {(r.machine_id, r.reading_ts): r.will_fail_within_6h for r in found.collect()}
    assert flags == {
        ("M1", minutes(-370)): 0,
        ("M1", minutes(-360)): 1,
        ("M1", minutes(0)): 1,
        ("M1", minutes(10)): 0,
        ("M2", T0): 0,
    }


@pytest.fixture(scope="module")
def dense(spark):
    """Failures both sparse and many per slot, on the slot borders and off them."""
    rng = random.Random(7)
    readings = [
        (i, rng.choice(["M1", "M1", "M2", None]), minutes(rng.randrange(0, 9000)))
        for i in range(600)
    ]
    failures = [("M1", minutes(rng.randrange(0, 9000))) for _ in range(90)]
    failures += [("M2", minutes(m)) for m in (80, 440, 441, 800, 5000, 5000)]
    return (
        readings,
        failures,
        spark.createDataFrame(
            readings, "id int, machine_id string, reading_ts timestamp"
        ),
        spark.createDataFrame(
            failures, "machine_id string, downtime_start_ts timestamp"
        ),
    )


def expected_next(readings, failures):
    out = {}
    for i, machine, ts in readings:
        times = sorted(f for m, f in failures if m == machine)
        at = bisect_left(times, ts)
        ahead = times[at] if at < len(times) else None
        within = ahead is not None and ahead <= ts + timedelta(hours=6)
        out[i] = ahead if within else None
    return out


def test_label_against_brute_force(dense):
    readings, failures, df, marks = dense
    found = labels.failure_horizon_label(df, marks).collect()
    expected = expected_next(readings, failures)
    assert {r.id: r.will_fail_within_6h for r in found} == {
        i: int(ts is not None) for i, ts in expected.items()
    }


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("pieces", [None, 1, 3, 40])
def test_next_failure_against_brute_force(dense, how, pieces):
    readings, failures, df, marks = dense
    if pieces is None:
        found = labels.next_failure(df, marks, how=how).collect()
    else:
        found = labels.next_failure_in_pieces(
            df, marks, how=how, tie_break=["id"], pieces=pieces
        ).collect()
    expected = expected_next(readings, failures)
    if how == "inner":
        expected = {i: ts for i, ts in expected.items() if ts is not None}
    assert {r.id: r.next_failure_ts for r in found} == expected
    assert len(found) == len(expected)
    for r in found:
        if r.next_failure_ts is not None:
            hours = (r.next_failure_ts - r.reading_ts).total_seconds() / 3600
            assert r.hours_to_failure == pytest.approx(hours, abs=1e-6)


def test_no_failures(dense):
    _, _, df, marks = dense
    none = marks.where("false")
    assert labels.failure_horizon_label(df, none).where("will_fail_within_6h = 1").count() == 0
    assert labels.next_failure(df, none).count() == 0
    assert labels.next_failure_in_pieces(df, none).count() == 0
    assert labels.next_failure_in_pieces(df, none, how="left").count() == 600


def test_unknown_machines_do_not_match(spark):
    df = spark.sql("select 1 id, cast(null as string) machine_id, timestamp'2026-07-01 00:00:00' reading_ts")
    marks = spark.sql("select cast(null as string) machine_id, timestamp'2026-07-01 01:00:00' downtime_start_ts")
    assert labels.failure_horizon_label(df, marks).first().will_fail_within_6h == 0
    assert labels.next_failure(df, marks, how="left").first().next_failure_ts is None
    assert labels.next_failure_in_pieces(df, marks, how="left").first().next_failure_ts is None


def test_a_hot_machine_is_cut_within_one_horizon(spark, monkeypatch):
    """A third of all rows belong to one machine and one hour; no task gets them all."""
    written = []
    plain = labels.lay_out
    monkeypatch.setattr(labels, "lay_out", lambda *a: written.append(plain(*a)) or written[-1])
    hot = spark.range(4000).select(
        F.col("id"), F.lit("HOT").alias("machine_id"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id") % 3600)).alias("reading_ts")
    )
    rest = spark.range(4000, 12000).select(
        F.col("id"),
        F.concat(F.lit("M"), F.col("id") % 50).alias("machine_id"),
        (F.lit(T0) + F.make_dt_interval(mins=F.col("id") % 977)).alias("reading_ts"),
    )
    readings = hot.union(rest)
    marks = spark.createDataFrame([("HOT", minutes(70)), ("M1", minutes(500))], "machine_id string, downtime_start_ts timestamp")
    found = labels.next_failure_in_pieces(readings, marks, tie_break=["id"], pieces=12)
    assert found.where("machine_id = 'HOT'").count() == 4000
    assert found.where("machine_id = 'HOT'").select("next_failure_ts").distinct().count() == 1
    same = labels.next_failure(readings, marks)
    assert found.exceptAll(same).isEmpty() and same.exceptAll(found).isEmpty()
    pieces = written[0].where("machine_id = 'HOT'").groupBy(PIECE).count().collect()
    assert len(pieces) >= 3 and max(r["count"] for r in pieces) < 2000
