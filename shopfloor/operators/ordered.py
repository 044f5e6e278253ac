"""Exact ordered computations over keys of any size.

A window over ``PARTITION BY line ORDER BY ts`` puts a whole line into one task, and a
window without partitions puts everything there. So the ordered sequence is always cut:

1. rows are range-partitioned on (key, order), so a hot key is cut into many pieces of
   similar size, and each piece is sorted and written once (:func:`lay_out`);
2. one row per (key, piece) summarises the piece;
3. the summaries, running over a key's pieces, give what each piece must add.

The source is read twice, for the sample of the range partitioning and for the layout.
``pieces`` sets the number of range partitions; without it the session's shuffle
partitions hold, and adaptive execution joins small ones.

``order`` has to identify a row within its key (end it with an id, or with the file
position columns of :func:`shopfloor.sources.readers.with_file_position`): rows that
tie on all of it cannot be cut apart, and their sequence would be arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.operators.joins import join_on
from shopfloor.scratch import materialize

POSITION = "__position"
PIECE = "__piece"
SHIFT = "__shift"
# monotonically_increasing_id keeps the partition number above these bits.
ROW_BITS = 33


def lay_out(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    keep: Sequence[str],
    label: str,
    pieces: int | None = None,
) -> DataFrame:
    """Write ``keep`` in (key, order) order, with a position that rises along it."""
    columns = [*key, *order]
    placed = (
        df.select(*dict.fromkeys([*columns, *keep]))
        .repartitionByRange(*([pieces] if pieces else []), *columns)
        .sortWithinPartitions(*columns)
        .select(*keep, F.monotonically_increasing_id().alias(POSITION))
    )
    return materialize(placed, label).withColumn(
        PIECE, F.shiftright(F.col(POSITION), ROW_BITS)
    )


def _earlier_pieces(key: Sequence[str]):
    return (
        Window.partitionBy(*key)
        .orderBy(PIECE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def with_sequence(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    keep: Sequence[str],
    name: str = "sequence",
    pieces: int | None = None,
) -> DataFrame:
    """``keep`` columns plus each row's 0-based place within its key."""
    rows = lay_out(df, key, order, [*dict.fromkeys([*keep, *key])], "sequence", pieces)
    summary = rows.groupBy(*key, PIECE).agg(
        F.min(POSITION).alias("first"), F.count("*").alias("n")
    )
    before = F.coalesce(F.sum("n").over(_earlier_pieces(key)), F.lit(0))
    # At most one row per written piece and per key.
    shifts = materialize(
        summary.select(*key, PIECE, (before - F.col("first")).alias(SHIFT)),
        "sequence-shifts",
    )
    return join_on(rows, shifts, [*key, PIECE]).select(
        *keep, (F.col(POSITION) + F.col(SHIFT)).alias(name)
    )


def with_running_total(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    name: str,
    pieces: int | None = None,
) -> DataFrame:
    """``df`` plus the total of ``value`` over all rows up to and including each row.

    Rows run over the whole table, in ascending ``order``. Meant for aggregated tables;
    ``df`` is written first.
    """
    table = materialize(df, "running-input")
    rows = lay_out(table, [], order, table.columns, "running", pieces)
    summary = rows.groupBy(PIECE).agg(F.sum(value).alias("total"))
    before = F.coalesce(F.sum("total").over(_earlier_pieces([])), F.lit(0))
    shifts = materialize(summary.select(PIECE, before.alias(SHIFT)), "running-shifts")
    within = (
        Window.partitionBy(PIECE)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        join_on(rows.withColumn("__within", F.sum(value).over(within)), shifts, [PIECE])
        .select(*table.columns, (F.col("__within") + F.col(SHIFT)).alias(name))
    )
