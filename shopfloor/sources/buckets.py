"""Tables stored in the partitioning that later steps need.

Deduplication, daily aggregates and their join all work per machine, line and day. Facts that are
written in buckets of these columns are shuffled once, at the write; every later step reads them
as they lie. A machine is spread over its days, so no bucket grows with a machine's history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(
    df: DataFrame, name: str, location: str, by: Sequence[str], buckets: int
) -> DataFrame:
    """Overwrite a catalog table whose files hold one bucket each; returns the table.

    Choose ``buckets`` by the table's size (one is the least that a task reads); tables that are
    to be joined without a shuffle need the same number and the same columns.
    """
    (
        df.repartition(buckets, *by)
        .sortWithinPartitions(*by)
        .write.mode("overwrite")
        .option("path", location)
        .bucketBy(buckets, *by)
        .sortBy(*by)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
