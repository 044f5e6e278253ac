"""Subgroups on a stream, from the state of each line.

A subgroup is a number of measurements, so all that a line has to remember between micro-batches
is the measurements that have not filled one: at most ``size - 1`` times and values, and how
many subgroups it has had. The state lives in Spark's state store and is restored with the
checkpoint. A micro-batch's measurements of one line are put into order in one task; bound the
micro-batch (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) by what a task can hold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shopfloor.functions import epoch_micros
from shopfloor.operators import spc

AT = "__at"
STATE = "n_subgroups long, times array<long>, vals array<double>"


def _advance(size: int, order: list[str], line: str, value: str):
    def advance(
        key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        done, times, values = state.get if state.exists else (0, [], [])
        rows = pd.concat(list(chunks)).sort_values(order, kind="stable")
        at = np.concatenate([np.array(times, dtype=np.int64), rows[AT].to_numpy(np.int64)])
        found = np.concatenate([np.array(values, dtype=float), rows[value].to_numpy(float)])
        # What was left over may be overtaken by a late measurement of an earlier time.
        by_time = np.argsort(at, kind="stable")
        at, found = at[by_time], found[by_time]
        full = len(at) // size * size
        groups = found[:full].reshape(-1, size)
        state.update((done + full // size, at[full:].tolist(), found[full:].tolist()))
        yield pd.DataFrame(
            {
                line: [key[0]] * len(groups),
                "subgroup_index": np.arange(done, done + len(groups), dtype=np.int64),
                "start": at[:full:size],
                "xbar": groups.sum(axis=1) / size,
                "range": groups.max(axis=1, initial=-np.inf) - groups.min(axis=1, initial=np.inf),
            }
        )

    return advance


def subgroup_stream(
    measurements: DataFrame,
    line: str = "line_id",
    ts: str = "measured_ts",
    tie_break: Sequence[str] = ("machine_id",),
    value: str = "part_dimension_mm",
    size: int = spc.SUBGROUP_SIZE,
) -> DataFrame:
    """The stream of :func:`shopfloor.operators.spc.subgroups`, each emitted when it is full.

    Equal to the batch whatever the micro-batches are, as long as these follow each other in
    time; a measurement that arrives after a later one was grouped joins the next subgroup.
    Measurements without a time or value are left out.
    """
    columns = list(dict.fromkeys([line, ts, *tie_break, value]))
    rows = (
        measurements.select(*columns)
        .where(F.col(value).isNotNull() & F.col(ts).isNotNull())
        .withColumn(AT, epoch_micros(F.col(ts)))
    )
    ordered = [AT, *[c for c in tie_break if c != line], value]
    kind = rows.schema[line].dataType.simpleString()
    groups = rows.drop(ts).groupBy(line).applyInPandasWithState(
        _advance(size, list(dict.fromkeys(ordered)), line, value),
        f"`{line}` {kind}, subgroup_index long, start long, xbar double, `range` double",
        STATE,
        "append",
        GroupStateTimeout.NoTimeout,
    )
    start = F.timestamp_micros("start").cast(rows.schema[ts].dataType)
    return groups.select(
        line, "subgroup_index", start.alias("subgroup_start_ts"), "xbar", "range"
    )


def chart_stream(groups: DataFrame, limits: DataFrame, line: str = "line_id") -> DataFrame:
    """Each subgroup of a stream against the frozen limits of its line."""
    return spc.control_chart(groups, limits, line, keep_index=True)
