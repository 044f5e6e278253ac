"""Control charts on a stream, against frozen limits.

A subgroup is a number of rows, not a span of time, so it is no window on a stream.
Every micro-batch is charted as a batch instead: the rows that did not fill a subgroup
are carried to the next one, fewer than a subgroup per line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopfloor.operators import spc
from shopfloor.operators.joins import join_on
from shopfloor.scratch import materialize, scratch_scope


def chart_batch(
    batch: DataFrame,
    batch_id: int,
    limits: DataFrame,
    target: str,
    line: str = "line_id",
    ts: str = "measured_ts",
    tie_break: Sequence[str] = ("machine_id",),
    value: str = "part_dimension_mm",
    size: int = spc.SUBGROUP_SIZE,
) -> None:
    """Chart one micro-batch into ``target/chart`` and keep its tail in ``target/carry``.

    Both are written under the batch number, so a repeated batch replaces its own
    output. A row that arrives after a later one was charted joins the next subgroup.
    """
    columns = list(dict.fromkeys([line, ts, *tie_break, value]))
    rows = batch.select(*columns).where(F.col(value).isNotNull())
    if batch_id > 0:
        earlier = f"{target}/carry/{batch_id - 1}"
        rows = rows.unionByName(batch.sparkSession.read.schema(rows.schema).parquet(earlier))
    rows = materialize(rows, "chart-batch")
    placed = spc.place(rows, line, ts, tie_break, value, keep=columns)

    groups = materialize(spc.group_placed(placed, line, ts, value, size), "chart-groups")
    chart = spc.control_chart(groups, limits, line, size)
    chart.write.mode("overwrite").parquet(f"{target}/chart/batch_id={batch_id}")

    filled = materialize(
        rows.groupBy(line).agg((F.count("*") - F.count("*") % size).alias("__filled")),
        "chart-filled",
    )
    tail = join_on(placed, filled, [line]).where(F.col("place") >= F.col("__filled"))
    tail.select(*columns).write.mode("overwrite").parquet(f"{target}/carry/{batch_id}")


def start_charts(
    silver: DataFrame,
    limits: DataFrame,
    target: str,
    checkpoint: str,
    available_now: bool = False,
    **columns,
) -> StreamingQuery:
    """Chart a stream of measurements; read the result from ``target/chart``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            chart_batch(batch, batch_id, limits, target, **columns)

    writer = silver.writeStream.foreachBatch(on_batch).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
