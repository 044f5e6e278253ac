import os
from datetime import datetime, timedelta

import pytest

from shopfloor.operators.checks import DataCheckError
from shopfloor.plans import medallion
from shopfloor.scratch import materialize, scratch_scope

START = datetime(2026, 7, 1)
MACHINES = {"M1": "LINE-A", "M2": "LINE-A", "M3": "LINE-B"}


def write_inputs(folder):
    """Three machines, two days, a reading every two hours."""
    sensors = ["machine_id,line_id,reading_ts,temperature_c,vibration_mm_s,pressure_psi,latent_wear,will_fail_within_6h"]
    quality = ["machine_id,line_id,measured_ts,part_dimension_mm,in_spec"]
    for machine, line in MACHINES.items():
        for i in range(24):
            ts = (START + timedelta(hours=2 * i)).isoformat()
            soon = int(i % 8 in (5, 6, 7))
            sensors.append(f"{machine},{line},{ts},{60 + 9 * soon + i % 3},{1 + soon + i / 100},{100 - i % 4},0.1,{soon}")
            size = 50 + (i % 5) / 20
            quality.append(f"{machine},{line},{ts},{size},{int(size <= 50.15)}")
    quality.append(quality[1])
    quality.append("M1,LINE-A,not-a-time,50.0,1")
    downtime = [
        "machine_id,line_id,downtime_start_ts,downtime_hours,reason",
        "M1,LINE-A,2026-07-01T09:40:00,2.0,Equipment Failure",
        "M1,LINE-A,2026-07-01T09:40:00,0.5,Changeover",
        "M3,LINE-B,2026-07-09T09:40:00,0.5,Changeover",
    ]
    shifts = ["line_id,shift_date,shift,planned_production_hours", "LINE-A,2026-07-01,Day,8.0"]
    machines = ["machine_id,line_id,machine_type,install_date", "M1,LINE-A,CNC Mill,2023-10-30"]
    for name, lines in {
        "sensor_readings": sensors,
        "quality_measurements": quality,
        "downtime_events": downtime,
        "shift_log": shifts,
        "machines": machines,
    }.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    source, target = tmp_path_factory.mktemp("in"), tmp_path_factory.mktemp("out")
    write_inputs(source)
    settings = medallion.Settings(trees=5, max_depth=3, min_leaf=1, catalog=True)
    summary = medallion.run_medallion(spark, str(source), str(target), settings)
    return str(source), str(target), dict(map(tuple, summary.collect()))


def test_row_counts(run):
    _, _, counts = run
    assert counts["bronze.quality_measurements"] == 74
    assert counts["silver.quality_measurements"] == 72
    assert counts["silver.sensor_readings"] == 72
    assert counts["silver.downtime_events"] == 3
    assert counts["gold.fct_machine_daily_oee"] == 6
    # 49 and 24 measurements as they arrived, in fives.
    assert counts["gold.spc_control_chart_data"] == 9 + 4
    assert counts["gold.process_capability"] == 2
    assert counts["marts.fct_line_oee"] == 4
    assert counts["marts.fct_downtime_pareto"] == 2
    assert counts["gold.predictive_maintenance_metrics"] == 7
    assert counts["raw.downtime_events"] == 3
    assert counts["served.served_violations"] > 0


def test_contents(spark, run):
    _, target, _ = run
    gold = spark.read.parquet(f"{target}/gold/fct_machine_daily_oee")
    m1 = gold.where("machine_id = 'M1' and production_date = date'2026-07-01'").first()
    assert (m1.units_measured, m1.downtime_hours, m1.availability) == (12, 2.5, 0.8958)
    rejected = spark.read.parquet(f"{target}/quarantine/quality_measurements")
    assert rejected.count() == 1
    served = spark.read.parquet(f"{target}/served/spc_control_chart_data")
    assert dict(served.dtypes)["out_of_control"] == "boolean"
    violations = spark.read.parquet(f"{target}/checks/served_violations")
    assert violations.where("failures > 0").count() == 0
    tests = spark.read.parquet(f"{target}/checks/staging/*", f"{target}/checks/marts/*")
    assert tests.count() == 7
    assert tests.where("should_error").count() == 0
    chart = spark.read.option("header", True).csv(f"{target}/export/spc_control_chart_data")
    assert chart.columns[:4] == ["line_id", "subgroup_start_ts", "xbar", "range"]
    metrics = spark.read.option("header", True).csv(
        f"{target}/export/predictive_maintenance_metrics"
    )
    assert metrics.columns == ["metric", "value"]
    runs = spark.read.parquet(f"{target}/model_runs")
    assert {"n_train", "n_test", "roc_auc"} <= {r.name for r in runs.collect()}
    assert spark.table("stg_machine_daily_oee").count() == 6
    assert spark.table("marts.fct_line_oee").count() == 4


def test_rerun_overwrites(spark, run):
    source, target, counts = run
    settings = medallion.Settings(trees=5, max_depth=3, min_leaf=1, model_version=2)
    again = medallion.run_medallion(spark, source, target, settings)
    found = dict(map(tuple, again.collect()))
    assert found == {k: v for k, v in counts.items() if k in found}
    runs = spark.read.parquet(f"{target}/model_runs")
    assert runs.select("run_name").distinct().count() == 2
    assert runs.select("run_id", "started_at").distinct().count() == 2
    scores = spark.read.parquet(f"{target}/gold/failure_scores")
    assert {"machine_id", "reading_ts", "score"} <= set(scores.columns)


def test_threads_share_the_scratch_scope(spark):
    with scratch_scope(spark) as folder:
        made = medallion.together(
            {"a": lambda: materialize(spark.range(2), "a"), "b": lambda: spark.range(3)}
        )
        assert {name: df.count() for name, df in made.items()} == {"a": 2, "b": 3}
        assert len(os.listdir(folder)) == 1

    def fail():
        raise ValueError("no table")

    with pytest.raises(ValueError, match="no table"):
        medallion.together({"a": fail, "b": lambda: spark.range(1)})


def test_gate_blocks_the_marts(spark, run, tmp_path):
    _, target, _ = run
    days = spark.read.parquet(f"{target}/gold/fct_machine_daily_oee")
    stops = spark.read.parquet(f"{target}/silver/downtime_events")
    broken = days.selectExpr("* except (machine_id)", "cast(null as string) machine_id")
    with pytest.raises(DataCheckError, match="not_null_stg_machine_daily_oee_machine_id"):
        medallion.build_marts(broken, stops, str(tmp_path))
    # The other mart has nothing to do with the broken table.
    assert sorted(p.name for p in (tmp_path / "marts").iterdir()) == ["fct_downtime_pareto"]
    unknown = stops.selectExpr("* except (machine_id)", "cast(null as string) machine_id")
    with pytest.raises(DataCheckError, match="not_null_stg_downtime_events_machine_id"):
        medallion.build_marts(days, unknown, str(tmp_path / "2"))
    assert sorted(p.name for p in (tmp_path / "2/marts").iterdir()) == ["fct_line_oee"]


def test_failed_marts_do_not_stop_the_model(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_inputs(source)
    # A line without spread has no Cpk, which its served table demands.
    flat = ["machine_id,line_id,measured_ts,part_dimension_mm,in_spec"]
    flat += [f"M1,LINE-A,{(START + timedelta(hours=i)).isoformat()},50.0,1" for i in range(20)]
    (source / "quality_measurements.csv").write_text("\n".join(flat) + "\n")
    settings = medallion.Settings(trees=3, max_depth=2, min_leaf=1)
    with pytest.raises(DataCheckError, match="process_capability"):
        medallion.run_medallion(spark, str(source), str(tmp_path / "out"), settings)
    served = {p.name for p in (tmp_path / "out/served").iterdir()}
    assert served == {"fct_machine_daily_oee", "spc_control_chart_data"}
    assert (tmp_path / "out/models/predictive-maintenance/1").exists()
    # Nor does a broken served table stop the marts.
    assert {p.name for p in (tmp_path / "out/marts").iterdir()} == {"fct_line_oee", "fct_downtime_pareto"}


def test_failures_of_several_branches_are_raised_together(spark, monkeypatch, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_inputs(source)

    def fail(name):
        def build(*args):
            raise DataCheckError(name)

        return build

    monkeypatch.setattr(medallion, "build_served", fail("served is broken"))
    monkeypatch.setattr(medallion, "build_marts", fail("marts are broken"))
    with pytest.raises(DataCheckError, match="served is broken; marts are broken"):
        medallion.run_medallion(
            spark, str(source), str(tmp_path / "out"), medallion.Settings(trees=2, max_depth=2, min_leaf=1)
        )
    assert (tmp_path / "out/gold/predictive_maintenance_metrics").exists()


def test_every_bronze_row_is_accounted_for(spark, run):
    _, target, counts = run
    lost = spark.read.parquet(f"{target}/checks/lost_rows").collect()
    found = {(r.table_name, r.reason): r.rows for r in lost}
    assert found[("quality_measurements", "duplicate")] == 1
    assert found[("quality_measurements", "unparsable")] == 1
    assert found[("quality_measurements", "no_value")] == 0
    for name in ("sensor_readings", "quality_measurements", "downtime_events", "shift_log"):
        out = sum(n for (t, reason), n in found.items() if t == name and reason != "no_value")
        assert counts[f"bronze.{name}"] == counts[f"silver.{name}"] + out
