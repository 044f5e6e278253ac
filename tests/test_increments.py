import threading
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopfloor.operators import oee
from shopfloor.plans import incremental
from shopfloor.plans.incremental import Fact
from shopfloor.sources import versions

T0 = datetime(2026, 3, 1)
QUALITY = Fact("quality", "ts", "measured_date", ("id",))
STOPS = Fact("stops", "ts", "downtime_date", ("id",))


def quality(spark, ids):
    rows = [(i, f"M{i % 4}", f"L{i % 2}", T0 + timedelta(hours=7 * i), i % 3 > 0) for i in ids]
    df = spark.createDataFrame(rows, "id int, machine_id string, line_id string, ts timestamp, ok boolean")
    return df.withColumn("in_spec", F.col("ok").cast("int")).drop("ok")


def stops(spark, ids):
    rows = [(i, f"M{i % 4}", f"L{i % 2}", T0 + timedelta(hours=7 * i), 0.1 * (i % 9), f"r{i % 3}") for i in ids]
    return spark.createDataFrame(
        rows, "id int, machine_id string, line_id string, ts timestamp, downtime_hours double, reason string"
    )


def files(target):
    """Parquet files of the rebuilt layers, with their time of writing."""
    found = {}
    for layer in ("silver", "gold", "marts"):
        for f in Path(target, layer).rglob("*.parquet"):
            found[str(f.relative_to(target))] = f.stat().st_mtime_ns
    return found


def days_of(names):
    return {n.split("=")[1].split("/")[0] for n in names}


def full(quality_rows, stop_rows):
    measured = quality_rows.dropDuplicates(["id"]).withColumn("measured_date", F.to_date("ts"))
    stopped = stop_rows.dropDuplicates(["id"]).withColumn("downtime_date", F.to_date("ts"))
    return oee.machine_daily_oee(
        oee.quality_daily(measured), oee.downtime_daily(stopped)
    )


def same(a, b):
    left, right = (sorted(map(str, df.select(*a.columns).collect())) for df in (a, b))
    return left == right


def test_only_touched_days_are_written(spark, tmp_path):
    target = str(tmp_path)
    first = incremental.run_increment(quality(spark, range(40)), stops(spark, range(0, 40, 3)), target, 1, QUALITY, STOPS)
    assert same(first["fct_machine_daily_oee"], full(quality(spark, range(40)), stops(spark, range(0, 40, 3))))
    before = files(target)
    # Row 5 is late on an old day, row 3 is a copy, 40 and 41 are new days.
    second = incremental.run_increment(
        quality(spark, [3, 40, 41, 100]), stops(spark, [5]), target, 2, QUALITY, STOPS
    )
    after = files(target)
    touched = {str((T0 + timedelta(hours=7 * i)).date()) for i in (3, 5, 40, 41, 100)}
    kept = {n for n, t in after.items() if before.get(n) == t}
    assert days_of(set(before) - kept) <= touched
    assert days_of(set(after) - kept) <= touched
    assert days_of(kept) and days_of(after) > touched
    whole = full(quality(spark, [*range(40), 40, 41, 100]), stops(spark, [*range(0, 40, 3), 5]))
    assert same(second["fct_machine_daily_oee"], whole)
    assert same(second["fct_line_oee"], oee.line_oee(whole))


def test_a_repeated_delivery_changes_nothing(spark, tmp_path):
    target = str(tmp_path)
    for _ in range(2):
        done = incremental.run_increment(quality(spark, range(20)), stops(spark, [4, 8]), target, 1, QUALITY, STOPS)
    assert done["fct_machine_daily_oee"].agg(F.sum("units_measured")).first()[0] == 20
    assert done["manifest"].count() == done["manifest"].select("table_name", "day").distinct().count()


def test_an_interrupted_delivery_is_repeated(spark, tmp_path, monkeypatch):
    target = str(tmp_path)
    incremental.run_increment(quality(spark, range(10)), stops(spark, [1]), target, 1, QUALITY, STOPS)
    args = (quality(spark, range(8, 25)), stops(spark, [2, 9]), target, 2, QUALITY, STOPS)
    with monkeypatch.context() as patch:
        patch.setattr(incremental.oee, "machine_daily_oee", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.run_increment(*args)
    done = incremental.run_increment(*args)
    assert same(done["fct_machine_daily_oee"], full(quality(spark, range(25)), stops(spark, [1, 2, 9])))


def test_rows_without_time_are_kept_aside(spark, tmp_path):
    raw = quality(spark, range(6)).withColumn("ts", F.when(F.col("id") > 2, F.col("ts")).otherwise(None))
    done = incremental.run_increment(raw, stops(spark, []), str(tmp_path), 1, QUALITY, STOPS)
    assert done["fct_machine_daily_oee"].agg(F.sum("units_measured")).first()[0] == 3
    assert spark.read.parquet(f"{tmp_path}/rejects/quality").count() == 3


def test_reading_some_days_opens_their_folders_only(spark, tmp_path):
    done = incremental.run_increment(quality(spark, range(40)), stops(spark, [1]), str(tmp_path), 1, QUALITY, STOPS)
    some = incremental.of_days(done["fct_machine_daily_oee"], "production_date", [T0.date()])
    assert {f.split("production_date=")[1][:10] for f in some.inputFiles()} >= {str(T0.date())}
    assert some.select(F.input_file_name()).distinct().count() == 1
    assert "PartitionFilters: [isnotnull(production_date" in some._jdf.queryExecution().executedPlan().toString()


# --- versions ------------------------------------------------------------------------


def test_readers_see_committed_versions_only(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root)
    old = versions.publish_version(spark.range(10), root)
    staged = versions.stage(spark.range(99), root)
    # Killed here: the new folder is written, nobody sees it.
    assert versions.read_version(spark, root).count() == 10
    versions.commit(spark, staged)
    assert versions.read_version(spark, root).count() == 99
    assert versions.read_version(spark, root, 1).count() == 10
    assert old.count() == 10


def test_a_write_that_fails_leaves_the_old_state(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.publish_version(spark.range(10), root)
    bad = spark.range(20).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        versions.publish_version(bad, root)
    assert versions.read_version(spark, root).count() == 10
    assert versions.publish_version(spark.range(3), root).count() == 3


def test_only_one_of_two_writers_commits_a_number(spark, tmp_path):
    root = str(tmp_path / "t")
    a, b = versions.stage(spark.range(1), root), versions.stage(spark.range(2), root)
    assert a.version == b.version == 1
    versions.commit(spark, a)
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, b)
    assert versions.read_version(spark, root).count() == 1


def test_readers_during_overwrites_never_fail(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.publish_version(spark.range(100).withColumn("v", F.lit(0)), root)
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            seen.add(tuple(versions.read_version(spark, root).groupBy("v").count().first()))

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 5):
        versions.publish_version(spark.range(100).withColumn("v", F.lit(v)), root)
    stop.set()
    reader.join()
    assert seen and all(n == 100 for _, n in seen)


def test_prune_keeps_the_newest_and_removes_what_was_never_committed(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (1, 2, 3):
        versions.publish_version(spark.range(n), root)
    versions.stage(spark.range(50), root)
    assert len(versions.prune(spark, root, keep=2)) == 2
    assert versions.versions(spark, root) == [2, 3]
    assert versions.read_version(spark, root, 2).count() == 2
    assert versions.publish_version(spark.range(7), root).count() == 7


def test_partitioned_versions_keep_their_schema(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(6).select("id", (F.col("id") % 2).cast("string").alias("part"))
    read = versions.publish_version(df, root, ("part",))
    assert dict(read.dtypes) == {"id": "bigint", "part": "string"} and read.where("part = '1'").count() == 3
