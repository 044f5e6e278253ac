"""Streaming bronze to silver, and streaming daily facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopfloor.functions import exact_sum
from shopfloor.operators import silver
from shopfloor.sources.readers import CORRUPT


def read_csv_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New CSV files of a folder as a stream; lines that do not parse keep their text."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.readStream.schema(with_corrupt)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def read_kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: T.StructType,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """JSON messages of a topic as typed rows; needs Spark's Kafka package.

    Messages that do not parse keep their text in ``_corrupt_record``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return parsed_messages(reader.load(), schema)


def parsed_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The JSON of the ``value`` column as typed rows, with ``_corrupt_record``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    body = F.from_json(F.col("value").cast("string"), with_corrupt, options).alias("row")
    return messages.select(body).select("row.*")


def split_rejects(raw: DataFrame, ts: str, date: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows with a time, and the rest with its texts as they came.

    Both sides are streams of their own; start a sink for each.
    """
    text = f"{ts}_text"
    parsed = silver.typed(raw.withColumn(text, F.col(ts).cast("string")), ts, date)
    good = F.col(ts).isNotNull()
    if CORRUPT in raw.columns:
        good = good & F.col(CORRUPT).isNull()
    valid, rest = silver.split_valid(parsed, good)
    return valid.drop(text, CORRUPT), rest


def silver_stream(
    raw: DataFrame,
    ts: str,
    date: str,
    key: Sequence[str],
    late_by: str = "1 hour",
) -> DataFrame:
    """Typed rows, one per key, as long as copies arrive within ``late_by``.

    The key's state is dropped once the watermark has passed, so the state is bounded
    by the rows of that interval. A watermark needs a timestamp with time zone, hence
    the cast. Rows whose time does not parse are left to :func:`split_rejects`.
    """
    valid, _ = split_rejects(raw, ts, date)
    return (
        valid.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, late_by)
        .dropDuplicatesWithinWatermark(list(key))
        .withColumn(date, F.to_date(ts))
    )


def daily_quality_stream(
    quality: DataFrame,
    ts: str = "measured_ts",
    machine: str = "machine_id",
    line: str = "line_id",
    in_spec: str = "in_spec",
    late_by: str = "1 hour",
) -> DataFrame:
    """Units measured and in spec per machine-day, emitted when the day has closed."""
    return _daily(quality, ts, machine, line, late_by).agg(
        F.count("*").alias("units_measured"), F.sum(in_spec).alias("units_in_spec")
    ).select(
        machine,
        line,
        F.to_date("day.start").alias("production_date"),
        "units_measured",
        "units_in_spec",
    )


def daily_downtime_stream(
    downtime: DataFrame,
    ts: str = "downtime_start_ts",
    machine: str = "machine_id",
    line: str = "line_id",
    hours: str = "downtime_hours",
    late_by: str = "1 hour",
) -> DataFrame:
    """Hours lost per machine-day, emitted when the day has closed."""
    return _daily(downtime, ts, machine, line, late_by).agg(
        exact_sum(hours).alias("downtime_hours")
    ).select(
        machine, line, F.to_date("day.start").alias("production_date"), "downtime_hours"
    )


def _daily(df: DataFrame, ts: str, machine: str, line: str, late_by: str):
    return (
        df.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, late_by)
        .groupBy(F.window(ts, "1 day").alias("day"), machine, line)
    )


def start_parquet_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once per row."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
