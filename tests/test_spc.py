from datetime import datetime, timedelta
from statistics import mean

import pytest
from pyspark.sql import functions as F

from shopfloor.functions import capability_grade
from shopfloor.operators import spc
from shopfloor.operators.ordered import PIECE, lay_out

START = datetime(2026, 7, 1)
SCHEMA = "line_id string, machine_id string, measured_ts timestamp, part_dimension_mm double"
F1 = [50.0, 50.1, 49.9, 50.2, 49.8, 50.5, 50.4, 50.6, 50.5, 50.5, 50.0]


def line_rows(line, values, machine="M1", step=10):
    return [
        (line, machine, START + timedelta(minutes=step * i), v)
        for i, v in enumerate(values)
    ]


@pytest.fixture(params=[7, None], ids=["pieces", "default"])
def plan(request):
    return request.param


def test_hand_computed_chart(spark, plan):
    df = spark.createDataFrame(line_rows("L", F1), SCHEMA)
    groups = spc.subgroups(df, pieces=plan)
    found = groups.orderBy("subgroup_index").collect()
    assert [r.xbar for r in found] == pytest.approx([50.0, 50.5])
    assert [r.range for r in found] == pytest.approx([0.4, 0.2])
    assert [r.subgroup_start_ts for r in found] == [START, START + timedelta(minutes=50)]

    chart = spc.control_chart(groups).collect()
    assert {(r.ucl_xbar, r.lcl_xbar, r.centerline_xbar) for r in chart} == {
        (50.4231, 50.0769, 50.25)
    }
    assert [r.out_of_control for r in chart] == [1, 1]
    ranges = spc.range_chart(groups).collect()
    assert {(r.ucl_r, r.lcl_r) for r in ranges} == {(0.6342, 0.0)}
    assert [r.out_of_control for r in ranges] == [0, 0]

    limits = spc.capability(spc.control_limits(groups)).first()
    assert (limits.cpu, limits.cpl) == pytest.approx((0.129, 1.421), abs=5e-4)
    report = spc.capability_report(groups).first()
    assert (report.n_subgroups, report.cpk, report.sigma_hat) == (2, 0.129, 0.129)
    assert (report.out_of_control_subgroups, report.out_of_control_pct) == (2, 1.0)


def test_short_and_constant_lines(spark, plan):
    rows = line_rows("short", [50.0] * 4) + line_rows("flat", [50.1] * 15)
    groups = spc.subgroups(spark.createDataFrame(rows, SCHEMA), pieces=plan)
    report = spc.capability_report(groups).collect()
    assert [(r.line_id, r.n_subgroups, r.cpk) for r in report] == [("flat", 3, None)]
    assert {r.out_of_control for r in spc.control_chart(groups).collect()} == {0}


def test_no_rows(spark, plan):
    groups = spc.subgroups(spark.createDataFrame([], SCHEMA), pieces=plan)
    assert spc.control_chart(groups).count() == 0


def tied_rows():
    rows = []
    for step in range(70):
        for machine in ("M1", "M2", "M3"):
            ts = START + timedelta(minutes=10 * step)
            value = 50 + ((step * 7 + int(machine[1]) * 13) % 11) / 10
            rows.append(("LINE-A" if step % 3 else "LINE-B", machine, ts, value))
    return rows


def brute_force(rows, size=5):
    out = {}
    for line in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == line), key=lambda r: (r[2], r[1]))
        for i in range(len(ordered) // size):
            values = [r[3] for r in ordered[i * size : (i + 1) * size]]
            out[line, i] = (ordered[i * size][2], mean(values), max(values) - min(values))
    return out


@pytest.mark.parametrize("partitions", [1, 8, 32])
def test_ties_and_partitioning_do_not_matter(spark, plan, partitions):
    rows = tied_rows()
    df = spark.createDataFrame(rows, SCHEMA).orderBy(F.rand(partitions))
    found = spc.subgroups(df.repartition(partitions), pieces=plan).collect()
    expected = brute_force(rows)
    assert {(r.line_id, r.subgroup_index) for r in found} == set(expected)
    for r in found:
        start, xbar, spread = expected[r.line_id, r.subgroup_index]
        assert r.subgroup_start_ts == start
        assert (r.xbar, r.range) == pytest.approx((xbar, spread))


def test_incomplete_tie_break_is_still_deterministic(spark, plan):
    rows = [("L", "M1", START, float(v)) for v in range(40)]
    results = []
    for seed in (1, 2):
        df = spark.createDataFrame(rows, SCHEMA).orderBy(F.rand(seed)).repartition(5)
        found = spc.subgroups(df, pieces=plan).orderBy("subgroup_index")
        results.append([(r.xbar, r.range) for r in found.collect()])
    assert results[0] == results[1] == [(5.0 * i + 2, 4.0) for i in range(8)]


def test_null_line_is_a_line_and_null_value_is_skipped(spark, plan):
    rows = line_rows(None, [50.0, None, 50.1, 50.2, 50.3, 50.4])
    groups = spc.subgroups(spark.createDataFrame(rows, SCHEMA), pieces=plan)
    assert [r.xbar for r in groups.collect()] == pytest.approx([50.2])
    assert spc.control_chart(groups).count() == 1


def test_hot_line_spreads_over_pieces(spark):
    """A line with most of the rows ends up in several pieces of the layout."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("line"), "id"
    )
    laid = lay_out(df, ["line"], ["id"], ["line", "id"], "test", 8)
    pieces = laid.where("line = 'hot'").groupBy(PIECE).count().collect()
    assert len(pieces) >= 6
    assert max(p["count"] for p in pieces) < 1000


def test_frozen_limits(spark):
    df = spark.createDataFrame(line_rows("L", F1), SCHEMA)
    frozen = spark.createDataFrame(
        [("L", 50.0, 0.3, 50.2, 49.8, 0.6, 0.0)],
        "line_id string, xbar_bar double, r_bar double, ucl_xbar double, "
        "lcl_xbar double, ucl_r double, lcl_r double",
    )
    chart = spc.control_chart(spc.subgroups(df), frozen).orderBy("subgroup_start_ts")
    assert [r.out_of_control for r in chart.collect()] == [0, 1]


@pytest.mark.parametrize(
    ("xbar_bar", "r_bar", "cpk", "flagged", "share"),
    [
        (50.2944, 0.2622, 0.017, 262, 0.2695),
        (50.2909, 0.3338, 0.021, 65, 0.0669),
        (50.2877, 0.3347, 0.029, 82, 0.0844),
        (50.2919, 0.3075, 0.020, 139, 0.1430),
    ],
)
def test_published_capability(spark, xbar_bar, r_bar, cpk, flagged, share):
    """Cpk from a published mean and range, which are rounded to four digits."""
    limits = spark.createDataFrame([(xbar_bar, r_bar)], "xbar_bar double, r_bar double")
    assert spc.capability(limits).first().cpk == pytest.approx(cpk, abs=1e-3)
    assert round(flagged / 972, 4) == share


def test_first_subgroups(spark):
    df = spark.createDataFrame(line_rows("L", [50 + i / 100 for i in range(50)]), SCHEMA)
    chart = spc.control_chart(spc.subgroups(df), keep_index=True)
    assert spc.first_subgroups(chart, 4).count() == 4


def test_grades(spark):
    df = spark.createDataFrame([(0.99,), (1.0,), (1.33,), (None,)], "cpk double")
    grades = [r[0] for r in df.select(capability_grade(F.col("cpk"))).collect()]
    assert grades == ["bad", "marginal", "acceptable", None]
