"""Connected components of a link table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.scratch import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``comp``, the least node its links reach, for each end of (``a``, ``b``).

    Each round takes the least label of the neighbours and then the label's own label,
    so chains shorten by more than half a round. A hub's links are combined before the
    shuffle, and the labels of a round are a written table.
    """
    both = materialize(
        links.select("a", "b").union(links.select("b", "a")).distinct(), "links"
    )
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("comp").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", "comp", F.least("comp", "near").alias("low")
        )
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("lower"))
        moved = materialize(
            lower.join(jump, "low", "left").select(
                "node",
                F.least("low", F.coalesce("lower", "low")).alias("next"),
                (F.least("low", F.coalesce("lower", "low")) != F.col("comp")).alias("changed"),
            ),
            "labels",
        )
        labels = moved.select("node", F.col("next").alias("comp"))
        if moved.where("changed").isEmpty():
            return labels
