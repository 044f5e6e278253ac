import os
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.operators import silver, spc
from shopfloor.scratch import materialize, scratch_root, scratch_scope
from shopfloor.sources import readers, schemas, tables, writers
from shopfloor.streaming import charts, ingest

CSV = (
    "machine_id,line_id,downtime_start_ts,downtime_hours,reason\r\n"
    "LATHE7,LINE-A,2026-07-09T08:15:00,0.45,Equipment Failure\r\n"
    "LATHE7,LINE-A,2026-07-09T08:15:00,0.45,Equipment Failure\r\n"
    "MCH0002,LINE-A,2026-07-10T00:10:00,oops,Changeover\r\n"
    "MCH0003,LINE-B,2026-07-12T12:00:00,1.5,Quality Hold\r\n"
)


@pytest.fixture
def csv_path(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "downtime_events.csv").write_text(CSV)
    return str(folder)


def test_csv_with_declared_schema(spark, csv_path):
    arrived = writers.write_parquet(
        readers.read_csv(spark, csv_path, schemas.DOWNTIME_EVENTS), csv_path + "-bronze"
    )
    good, bad = readers.split_corrupt(arrived)
    assert good.schema == schemas.DOWNTIME_EVENTS
    rows = good.orderBy("machine_id").collect()
    assert len(rows) == 3
    assert rows[0].downtime_start_ts == datetime(2026, 7, 9, 8, 15)
    assert rows[2].reason == "Quality Hold"
    assert [r._corrupt_record.split(",")[0] for r in bad.collect()] == ["MCH0002"]


def test_csv_with_inferred_types(spark, csv_path):
    kinds = dict(readers.read_csv(spark, csv_path).dtypes)
    assert kinds["downtime_start_ts"] == "timestamp"
    assert kinds["machine_id"] == "string"


def test_csv_sink_keeps_column_order(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    writers.write_csv(df, str(tmp_path / "out"), ["b", "a"])
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["b", "a"]


def test_partitioned_layer_prunes_folders_and_columns(spark, tmp_path):
    df = spark.range(30).select(
        "id",
        F.date_add(F.lit("2026-07-01").cast("date"), (F.col("id") % 3).cast("int")).alias("d"),
        F.lit("wide").alias("payload"),
    )
    path = str(tmp_path / "layer")
    assert writers.write_by_date(df, path, "d").count() == 30
    some = readers.read_parquet(
        spark, path, ["id", "d"], date="d", start="2026-07-02", end="2026-07-02"
    )
    assert some.count() == 10
    plan = some._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint>" in plan
    assert "PartitionFilters: [isnotnull(d" in plan

    # A rerun of one day replaces that day only.
    day = df.where("d = date'2026-07-03'").limit(4)
    writers.write_by_date(materialize(day, "day"), path, "d", replace_all=False)
    counts = dict(readers.read_parquet(spark, path).groupBy("d").count().collect())
    assert counts == {date(2026, 7, 1): 10, date(2026, 7, 2): 10, date(2026, 7, 3): 4}


def test_file_position_identifies_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    df = writers.write_parquet(spark.range(100).repartition(3), path)
    placed = readers.with_file_position(df)
    assert placed.select(*readers.FILE_POSITION).distinct().count() == 100


def test_arrival_follows_files_then_rows(spark, tmp_path):
    """A short early file and a long late one: the early row of the same key stays."""
    folder = tmp_path / "days"
    folder.mkdir()
    head = "machine_id,reading_ts,value\n"
    late = "".join(f"M{i},2026-01-02T00:00:00,{i}\n" for i in range(5000))
    for i, (name, body) in enumerate({"b": "X,2026-01-01T00:00:00,50.0\n", "a": late + "X,2026-01-01T00:00:00,99.0\n"}.items()):
        path = folder / f"{name}.csv"
        path.write_text(head + body)
        os.utime(path, (1_800_000_000 + i, 1_800_000_000 + i))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = readers.with_arrival(readers.read_csv(spark, str(folder)))
        stored = writers.write_parquet(raw, str(tmp_path / "bronze"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    kept = silver.deduplicate(stored, ["machine_id", "reading_ts"], readers.ARRIVAL)
    assert kept.where("machine_id = 'X'").first().value == 50.0
    within = stored.where("machine_id <> 'X'").orderBy(*readers.ARRIVAL).collect()
    assert [r.value for r in within] == sorted(r.value for r in within)


def test_streaming_rejects_are_stored(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("machine_id", "measured_ts")])
    (folder / "0.csv").write_text("machine_id,measured_ts\nM1,2026-07-01T00:00:00\nM1,oops\n")
    raw = ingest.read_csv_stream(spark, str(folder), schema)
    good = ingest.silver_stream(raw, "measured_ts", "measured_date", ["machine_id", "measured_ts"])
    assert run_stream(spark, good, str(tmp_path / "good"), str(tmp_path / "c1")).count() == 1
    _, rest = ingest.split_rejects(raw, "measured_ts", "measured_date")
    kept = run_stream(spark, rest, str(tmp_path / "rest"), str(tmp_path / "c2")).collect()
    assert [(r.machine_id, r.measured_ts, r.measured_ts_text) for r in kept] == [("M1", None, "oops")]


def test_malformed_messages_keep_their_text(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    messages = spark.createDataFrame([('{"a": 1}',), ("not json",)], "value string")
    found = ingest.parsed_messages(messages, schema).collect()
    assert [(r.a, r._corrupt_record) for r in found] == [(1, None), (None, "not json")]


def test_tables_and_views(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "line_id string, cpk double")
    tables.publish_table(df, "raw.capability_test")
    tables.publish_table(df, "raw.capability_test")
    ordered = tables.ordered_table(spark, "raw.capability_test", "cpk", "line_id")
    assert [r.line_id for r in ordered.collect()] == ["b", "a"]
    assert tables.publish_view(df.where("cpk > 1"), "good_lines").count() == 1


def test_scratch_tables_live_in_the_scratch_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark) == configured.rstrip("/")
    plan = materialize(spark.range(5), "five")._jdf.queryExecution().toString()
    assert scratch_root(spark) in plan


def test_scratch_scope_removes_its_tables_only(spark):
    outside = materialize(spark.range(5), "outside")
    with scratch_scope(spark) as folder:
        assert materialize(spark.range(3), "inside").count() == 3
        assert os.listdir(folder)
    assert not os.path.exists(folder)
    assert outside.count() == 5


def test_scratch_without_a_configured_folder():
    def session(**settings):
        conf = SimpleNamespace(get=lambda name, default=None: settings.get(name, default))
        return SimpleNamespace(conf=conf)

    local = session(**{"spark.master": "local[2]"})
    assert os.path.isdir(scratch_root(local))
    assert scratch_root(local) == scratch_root(local)
    with pytest.raises(RuntimeError, match="shared by all executors"):
        scratch_root(session(**{"spark.master": "yarn"}))


@pytest.fixture
def stream_dir(tmp_path):
    folder = tmp_path / "stream"
    folder.mkdir()
    header = "machine_id,line_id,measured_ts,part_dimension_mm,in_spec\n"
    batches = [
        ["M1,A,2026-07-01T00:00:00,50.0,1", "M1,A,2026-07-01T00:00:00,50.0,1"],
        ["M1,A,2026-07-01T00:40:00,50.4,0", "M2,A,2026-07-01T23:00:00,50.1,1"],
        ["M1,A,2026-07-01T23:30:00,50.0,1", "M1,A,2026-07-01T23:30:00,50.0,1"],
        ["M2,A,2026-07-04T00:00:00,50.2,1"],
        ["M2,A,2026-07-05T00:00:00,50.2,1"],
    ]
    for i, rows in enumerate(batches):
        add_file(folder, i, header + "\n".join(rows) + "\n")
    return str(folder)


def add_file(folder, i, text):
    """Files are taken up in the order of their times, so these have to differ."""
    path = folder / f"{i}.csv"
    path.write_text(text)
    os.utime(path, (1_800_000_000 + i, 1_800_000_000 + i))


def run_stream(spark, stream, path, checkpoint, partition_by=None):
    query = ingest.start_parquet_sink(
        stream, path, checkpoint, partition_by, available_now=True
    )
    assert query.awaitTermination(120)
    return spark.read.parquet(path)


def test_streaming_silver(spark, stream_dir, tmp_path):
    raw = ingest.read_csv_stream(spark, stream_dir, schemas.QUALITY_MEASUREMENTS, 1)
    silver = ingest.silver_stream(
        raw, "measured_ts", "measured_date", ["machine_id", "measured_ts"]
    )
    out, checkpoint = str(tmp_path / "silver"), str(tmp_path / "cp")
    found = run_stream(spark, silver, out, checkpoint, "measured_date")
    assert sorted((r.machine_id, str(r.measured_ts)) for r in found.collect()) == [
        ("M1", "2026-07-01 00:00:00"),
        ("M1", "2026-07-01 00:40:00"),
        ("M1", "2026-07-01 23:30:00"),
        ("M2", "2026-07-01 23:00:00"),
        ("M2", "2026-07-04 00:00:00"),
        ("M2", "2026-07-05 00:00:00"),
    ]
    assert found.select("measured_date").distinct().count() == 3
    # Nothing new: a restart from the checkpoint adds nothing.
    assert run_stream(spark, silver, out, checkpoint, "measured_date").count() == 6


def test_streaming_daily_quality(spark, stream_dir, tmp_path):
    raw = ingest.read_csv_stream(spark, stream_dir, schemas.QUALITY_MEASUREMENTS, 1)
    daily = ingest.daily_quality_stream(raw)
    found = run_stream(spark, daily, str(tmp_path / "daily"), str(tmp_path / "cp"))
    rows = {
        (r.machine_id, str(r.production_date)): (r.units_measured, r.units_in_spec)
        for r in found.collect()
    }
    # Days that have closed; the last two are still open.
    assert rows[("M1", "2026-07-01")] == (5, 4)
    assert rows[("M2", "2026-07-01")] == (1, 1)
    assert ("M2", "2026-07-05") not in rows


def test_streaming_daily_downtime(spark, tmp_path):
    folder = tmp_path / "stops"
    folder.mkdir()
    header = "machine_id,line_id,downtime_start_ts,downtime_hours,reason\n"
    for i, row in enumerate(
        ["M1,A,2026-07-01T01:00:00,1.5,x", "M1,A,2026-07-01T02:00:00,0.5,y", "M1,A,2026-07-09T00:00:00,1.0,x"]
    ):
        add_file(folder, i, header + row + "\n")
    raw = ingest.read_csv_stream(spark, str(folder), schemas.DOWNTIME_EVENTS, 1)
    daily = ingest.daily_downtime_stream(raw)
    found = run_stream(spark, daily, str(tmp_path / "d"), str(tmp_path / "cp"))
    assert [(r.machine_id, r.downtime_hours) for r in found.collect()] == [("M1", 2.0)]


def test_streaming_charts_equal_the_batch_chart(spark, tmp_path):
    folder = tmp_path / "measured"
    folder.mkdir()
    header = "machine_id,line_id,measured_ts,part_dimension_mm,in_spec\n"
    for i in range(4):
        rows = [
            f"M{m},{'A' if m < 3 else 'B'},2026-07-01T{6 * i + h:02d}:00:00,{50 + (7 * h + i + m) % 5 / 10},1"
            for h in range(6)
            for m in (1, 2, 3)
        ]
        add_file(folder, i, header + "\n".join(rows) + "\n")
    everything = readers.read_csv(spark, str(folder), schemas.QUALITY_MEASUREMENTS)
    groups = spc.subgroups(everything)
    limits = spc.control_limits(groups)
    expected = spc.control_chart(groups, limits)

    raw = ingest.read_csv_stream(spark, str(folder), schemas.QUALITY_MEASUREMENTS, 1)
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    query = charts.start_charts(raw, limits, target, checkpoint, available_now=True)
    assert query.awaitTermination(180)
    found = spark.read.parquet(f"{target}/chart").drop("batch_id")
    assert found.count() == expected.count() == 9 + 4
    assert found.exceptAll(expected).count() == 0

    # A repeated batch replaces its own output.
    batch = everything.where("measured_ts >= timestamp'2026-07-01 18:00:00'")
    charts.chart_batch(batch, 3, limits, target)
    again = spark.read.parquet(f"{target}/chart").drop("batch_id")
    assert again.exceptAll(expected).count() == 0
    assert again.count() == 13
