"""Deduplication of a stream without a horizon.

A watermark forgets keys, so copies later than it pass. Here the sink itself is the memory: a
micro-batch is compared with the keys that the sink holds for the days it touches. Nothing is
kept in the state store, and a batch reads the key columns of a few day folders however long the
stream has run.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopfloor.operators import silver
from shopfloor.scratch import materialize, scratch_scope
from shopfloor.sources.readers import path_exists
from shopfloor.streaming.ingest import split_rejects

BATCH = "batch_id"


def append_new(
    batch: DataFrame, batch_id: int, target: str, ts: str, date: str, key: Sequence[str]
) -> None:
    """Add to ``target/rows`` what it does not hold yet, and to ``target/rejects`` what is invalid.

    The key has to decide the day, as when it includes the time. Rows lie under (day, batch) and
    are compared with earlier batches only, so a repeated batch replaces its own output.
    """
    spark = batch.sparkSession
    arrived = materialize(batch, "stream-batch")
    valid, rest = split_rejects(arrived, ts, date)
    rest.write.mode("overwrite").parquet(f"{target}/rejects/{BATCH}={batch_id}")
    rows = materialize(silver.deduplicate(valid, key), "stream-distinct")
    # The days of one micro-batch.
    days = [r[0] for r in rows.select(date).distinct().collect()]
    if not days:
        return
    path = f"{target}/rows"
    if path_exists(spark, path):
        # Of earlier batches only their folders of these days are read, and of these the key.
        held = (
            read_rows(spark, target, rows)
            .where(F.col(date).isin(days) & (F.col(BATCH) < batch_id))
            .select(*[F.col(c).alias(f"__{c}") for c in key])
        )
        alike = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key])
        rows = rows.join(held, alike, "left_anti")
    (
        rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
        .hint("rebalance", date)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date, BATCH)
        .parquet(path)
    )


def read_rows(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """The sink's rows, with the columns of ``like`` and the batch."""
    schema = like.withColumn(BATCH, F.lit(0).cast("long")).schema
    return spark.read.schema(schema).parquet(f"{target}/rows")


def start_distinct_sink(
    raw: DataFrame,
    target: str,
    checkpoint: str,
    ts: str,
    date: str,
    key: Sequence[str],
    available_now: bool = False,
) -> StreamingQuery:
    """Store a raw stream's valid rows, one per key for all time, and its rejects."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            append_new(batch, batch_id, target, ts, date, key)

    writer = raw.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
