"""Global order without one task seeing all rows; helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.scratch import materialize

PIECE = "__piece"
POSITION = "__position"
# monotonically_increasing_id keeps the partition number above these bits.
ROW_BITS = 33

# The words of every contract: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_order(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``df`` written in ascending ``order``, with the number of its piece and its place.

    Rows are range-partitioned, so a hot value of the leading column is cut as long as
    the rest of ``order`` varies; the written table fixes pieces and places.
    """
    place = F.monotonically_increasing_id()
    rows = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(POSITION, place),
        label,
    )
    low = F.lit((1 << ROW_BITS) - 1)
    return rows.select(
        *df.columns,
        F.shiftright(POSITION, ROW_BITS).alias(PIECE),
        F.col(POSITION).bitwiseAND(low).alias(POSITION),
    )


def _before(sizes: DataFrame) -> DataFrame:
    """Per piece the total of ``n`` over the pieces ahead: one row for each written piece."""
    ahead = Window.orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(PIECE, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__ahead"))


def with_rank(df: DataFrame, order: Sequence[str], name: str, label: str) -> DataFrame:
    """``df`` plus each row's place, from 0, in ascending ``order`` over all rows."""
    rows = in_order(df, order, label)
    ahead = _before(rows.groupBy(PIECE).agg(F.count("*").alias("n")))
    return rows.join(ahead, PIECE).select(
        *df.columns, (F.col(POSITION) + F.col("__ahead")).alias(name)
    )


def with_total_before(
    df: DataFrame, order: Sequence[str], value: str, name: str, label: str
) -> DataFrame:
    """``df`` plus the total of ``value`` over all rows ahead in ascending ``order``."""
    rows = in_order(df, order, label)
    ahead = _before(rows.groupBy(PIECE).agg(F.sum(value).alias("n")))
    within = Window.partitionBy(PIECE).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum(value).over(within), F.lit(0))
    return (
        rows.withColumn("__within", here)
        .join(ahead, PIECE)
        .select(*df.columns, (F.col("__within") + F.col("__ahead")).alias(name))
    )
