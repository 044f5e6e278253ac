"""Registered queries that run a stream: the provided tables arrive in parts, one run each.

Every run starts from the checkpoint of the one before, as after a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopfloor.operators import spc
from shopfloor.plans import roles
from shopfloor.scratch import scratch_path
from shopfloor.sources.schemas import DOWNTIME_EVENTS
from shopfloor.streaming import dedup, ingest, subgroups

Start = Callable[[DataFrame], StreamingQuery]


def _in_runs(parts: list[DataFrame], fmt: str, source: str, stream: DataFrame, start: Start) -> None:
    """Deliver the parts one after the other; each is worked off before the next one comes."""
    for part in parts:
        part.write.mode("append").format(fmt).option("header", True).save(source)
        start(stream).awaitTermination()


def _delivered(spark: SparkSession, sample: DataFrame) -> tuple[str, DataFrame]:
    """A folder that starts empty, and its stream of Parquet files with the sample's columns."""
    source = scratch_path(spark, "stream-in")
    sample.limit(0).write.parquet(source)
    return source, spark.readStream.schema(sample.schema).parquet(source)


def _sink(spark: SparkSession) -> tuple[str, Start]:
    path, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    return path, lambda s: ingest.start_parquet_sink(s, path, checkpoint, available_now=True)


def _day(ts: str = "ts") -> Column:
    return F.to_date(ts)


# --- subgroups -----------------------------------------------------------------------


def spc_stream_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control chart of a stream that comes in four parts, against the limits of all rows."""
    rows = roles.measurements(spark, sf_dir)
    limits = spc.control_limits(spc.subgroups(rows, tie_break=["event_id"]))
    borders = [None, "2024-01-04", "2024-01-11", "2024-01-12", None]
    parts = []
    for low, high in zip(borders, borders[1:], strict=False):
        part = rows
        if low is not None:
            part = part.where(F.col("measured_ts") >= F.lit(low).cast("timestamp_ntz"))
        if high is not None:
            part = part.where(F.col("measured_ts") < F.lit(high).cast("timestamp_ntz"))
        parts.append(part)
    source, stream = _delivered(spark, rows)
    groups = subgroups.subgroup_stream(stream, tie_break=["event_id"])
    chart = subgroups.chart_stream(groups, limits)
    path, start = _sink(spark)
    _in_runs(parts, "parquet", source, chart, start)
    return spark.read.schema(chart.schema).parquet(path)


# --- silver without a horizon --------------------------------------------------------

KEY = ["machine_id", "downtime_start_ts", "downtime_hours"]


def _late_copies(spark: SparkSession, sf_dir: str) -> str:
    """Stops in three runs; the last brings copies more than a week old and unreadable times."""
    stops = roles.stops_as_raw(spark, sf_dir).withColumn("day", F.substring("downtime_start_ts", 1, 10))
    old = stops.where("day <= '2024-01-13'")
    unreadable = stops.where("day = '2024-01-20'").withColumn(
        "downtime_start_ts", F.concat(F.lit("about "), F.col("day"))
    )
    parts = [
        stops.where("day <= '2024-01-10'"),
        stops.where("day > '2024-01-10' and day <= '2024-01-20'"),
        stops.where("day > '2024-01-20'").unionByName(old).unionByName(unreadable),
    ]
    source, target, checkpoint = (scratch_path(spark, f"late-{n}") for n in ("in", "out", "state"))
    parts[0].drop("day").limit(0).write.option("header", True).csv(source)
    raw = ingest.read_csv_stream(spark, source, DOWNTIME_EVENTS)
    _in_runs(
        [part.drop("day") for part in parts],
        "csv",
        source,
        raw,
        lambda s: dedup.start_distinct_sink(
            s, target, checkpoint, "downtime_start_ts", "downtime_date", KEY, available_now=True
        ),
    )
    return target


def streaming_silver_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stops of a stream, free of copies however late they come."""
    rows = spark.read.parquet(f"{_late_copies(spark, sf_dir)}/rows")
    return rows.select(
        *DOWNTIME_EVENTS.names, "downtime_date"
    ).withColumn("downtime_start_ts", F.col("downtime_start_ts").cast("timestamp_ntz"))


def streaming_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same stream could not read, per machine: lines kept as they came."""
    rejects = spark.read.parquet(f"{_late_copies(spark, sf_dir)}/rejects")
    text = F.split("_corrupt_record", ",")
    return rejects.select(
        F.coalesce("machine_id", text[0]).alias("machine_id"),
        F.coalesce("line_id", text[1]).alias("line_id"),
        text[2].alias("text"),
    )


# --- daily facts ---------------------------------------------------------------------


def _parts_by_day(rows: DataFrame) -> list[DataFrame]:
    """The first half of the month without some rows, then the rest with these late rows."""
    early = _day() <= F.lit("2024-01-15").cast("date")
    late = F.col("event_id") % 13 == 0
    return [rows.where(early & ~late), rows.where(~early | late)]


def _daily(spark: SparkSession, rows: DataFrame, daily: Callable[[DataFrame], DataFrame]) -> DataFrame:
    source, stream = _delivered(spark, rows)
    closed = daily(stream)
    path, start = _sink(spark)
    _in_runs(_parts_by_day(rows), "parquet", source, closed, start)
    return spark.read.schema(closed.schema).parquet(path)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("machine_id"),
        (F.col("user_id") % 5).alias("line_id"),
        roles.in_spec().alias("in_spec"),
        (F.col("value") / 100).alias("downtime_hours"),
        "event_type",
    )


def streaming_quality_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units per machine and closed day; rows later than the watermark are not counted."""
    rows = _events(spark, sf_dir).where("event_type <> 'error'").drop("downtime_hours", "event_type")
    return _daily(spark, rows, lambda s: ingest.daily_quality_stream(s, ts="ts"))


def streaming_downtime_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).where("event_type = 'error'").drop("in_spec", "event_type")
    return _daily(spark, rows, lambda s: ingest.daily_downtime_stream(s, ts="ts"))


STREAM_QUERIES = {
    "spc_stream_chart": spc_stream_chart,
    "streaming_silver_late": streaming_silver_late,
    "streaming_rejects": streaming_rejects,
    "streaming_quality_daily": streaming_quality_daily,
    "streaming_downtime_daily": streaming_downtime_daily,
}
