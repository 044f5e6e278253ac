import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopfloor.operators import spc
from shopfloor.sources.readers import read_parquet
from shopfloor.streaming import dedup, subgroups

T0 = datetime(2026, 5, 1)
SCHEMA = "line_id string, machine_id string, measured_ts timestamp, part_dimension_mm double"


def measurements(n=83, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        line = rng.choice(["A", "A", "A", "B", "C", None])
        value = None if i % 17 == 3 else round(rng.gauss(50, 2), 3)
        rows.append((line, f"M{i % 3}", T0 + timedelta(minutes=i // 2), value))
    return rows


def run(spark, stream, target, state):
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def shown(df):
    rows = df.select("line_id", "subgroup_index", "subgroup_start_ts", F.round("xbar", 9), F.round("range", 9))
    return sorted(map(str, rows.collect()))


@pytest.mark.parametrize("cuts", [[], [1, 2, 3], [40], [7, 8, 30, 31, 60]])
def test_stream_equals_batch_over_any_split_and_restart(spark, tmp_path, cuts):
    rows = measurements()
    # Cut where the time moves on, as equal times have no order between micro-batches.
    borders = [0, *[c * 2 for c in cuts if c * 2 < len(rows)], len(rows)]
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    groups = subgroups.subgroup_stream(stream)
    for low, high in zip(borders, borders[1:], strict=False):
        part = rows[low:high]
        random.Random(low).shuffle(part)
        spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(source)
        # A new query from the checkpoint each time.
        run(spark, groups, target, state)
    batch = spc.subgroups(spark.createDataFrame(rows, SCHEMA))
    found = spark.read.schema(groups.schema).parquet(target)
    assert shown(found) == shown(batch) and found.count() > 8


def test_state_holds_less_than_a_subgroup(spark, tmp_path):
    """However many rows a line has had."""
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [("A", "M", T0 + timedelta(seconds=i), float(i)) for i in range(1003)] + [("B", "M", T0, 1.0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    run(spark, subgroups.subgroup_stream(stream), target, state)
    held = spark.read.format("statestore").load(state).selectExpr("key", "value.*").collect()
    assert len(held) == 2
    for row in held:
        text = str(row)
        assert text.count("datetime") == 0 and len(text) < 600


def test_a_late_row_joins_the_next_subgroup(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    groups = subgroups.subgroup_stream(spark.readStream.schema(SCHEMA).parquet(source), size=2)
    for minutes in ([0, 10, 20], [5, 30]):
        part = [("A", "M", T0 + timedelta(minutes=m), float(m)) for m in minutes]
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(source)
        run(spark, groups, target, state)
    found = spark.read.parquet(target).orderBy("subgroup_index").collect()
    assert [(r["subgroup_index"], r["xbar"], r["range"]) for r in found] == [(0, 5.0, 10.0), (1, 12.5, 15.0)]


# --- dedup without a horizon ---------------------------------------------------------

RAW = "machine_id string, ts string, hours double"


def raw(spark, *rows):
    return spark.createDataFrame([(m, t, h) for m, t, h in rows], RAW)


def append(spark, target, batch_id, *rows):
    dedup.append_new(raw(spark, *rows), batch_id, target, "ts", "day", ["machine_id", "ts"])


def stored(spark, target):
    rows = read_parquet(spark, f"{target}/rows")
    return sorted((r["machine_id"] or "", str(r["ts"]), r["hours"]) for r in rows.collect())


def test_copies_of_any_age_are_dropped(spark, tmp_path):
    target = str(tmp_path)
    append(spark, target, 0, ("M1", "2026-05-01 10:00:00", 1.0), ("M1", "2026-05-01 10:00:00", 1.0), (None, "2026-05-01 11:00:00", 4.0))
    append(spark, target, 1, ("M1", "2026-05-09 10:00:00", 2.0))
    append(spark, target, 2, ("M1", "2026-05-01 10:00:00", 9.0), ("M2", "2026-05-01 10:00:00", 3.0), (None, "2026-05-01 11:00:00", 4.0))
    assert stored(spark, target) == [
        ("", "2026-05-01 11:00:00", 4.0),
        ("M1", "2026-05-01 10:00:00", 1.0),
        ("M1", "2026-05-09 10:00:00", 2.0),
        ("M2", "2026-05-01 10:00:00", 3.0),
    ]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    target = str(tmp_path)
    append(spark, target, 0, ("M1", "2026-05-01 10:00:00", 1.0), ("M1", "oops", 1.0))
    for _ in range(2):
        append(spark, target, 1, ("M1", "2026-05-01 10:00:00", 1.0), ("M2", "2026-05-01 12:00:00", 2.0), ("M9", "no", 3.0))
    assert len(stored(spark, target)) == 2
    rejects = spark.read.parquet(f"{target}/rejects").collect()
    assert sorted((r["ts_text"], r["batch_id"]) for r in rejects) == [("no", 1), ("oops", 0)]


def test_a_batch_reads_the_days_it_touches(spark, tmp_path):
    target = str(tmp_path)
    append(spark, target, 0, *[("M1", f"2026-05-{d:02d} 10:00:00", 1.0) for d in range(1, 21)])
    rows = dedup.read_rows(spark, target, read_parquet(spark, f"{target}/rows").drop("batch_id"))
    some = rows.where(F.col("day").isin([datetime(2026, 5, 3).date()]) & (F.col("batch_id") < 1))
    plan = some.select("machine_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ReadSchema: struct<machine_id:string>" in plan
    assert some.select(F.input_file_name()).distinct().count() == 1
    before = {f: f.stat().st_mtime_ns for f in Path(target, "rows").rglob("*.parquet")}
    append(spark, target, 1, ("M7", "2026-05-03 10:00:00", 1.0))
    assert all(f.stat().st_mtime_ns == t for f, t in before.items())


def test_empty_batches(spark, tmp_path):
    target = str(tmp_path)
    append(spark, target, 0)
    append(spark, target, 1, ("M1", "oops", 1.0))
    append(spark, target, 2, ("M1", "2026-05-03 10:00:00", 1.0))
    assert len(stored(spark, target)) == 1
