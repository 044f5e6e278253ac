"""Evaluation of a binary classifier from (label, score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions import guarded_round
from shopfloor.operators.ordered import with_running_total


def positive_rate(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: rows, positives and the mean label."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(label).cast("bigint")).alias("n_positive"),
        guarded_round(F.avg(label), 6).alias("positive_rate"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def classification_metrics(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    threshold: float = 0.5,
    digits: int | None = 6,
) -> DataFrame:
    """One row: confusion counts, precision, recall and F1 of class 1."""
    actual = F.col(label) == 1
    predicted = F.col(score) > threshold
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))

    def shown(value: Column) -> Column:
        return value if digits is None else guarded_round(value, digits)

    return scored.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    ).select(
        "tp",
        "fp",
        "fn",
        "tn",
        shown(precision).alias("precision"),
        shown(recall).alias("recall"),
        shown(f1).alias("f1_score"),
    )


def roc_auc(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    digits: int | None = 6,
    pieces: int | None = None,
) -> DataFrame:
    """One row: positives, negatives and the area under the ROC curve, ties as one half.

    Rows shrink to one per distinct score first. Each positive beats the negatives with
    a lower score and half of those with its own; NULL if one class is missing.
    """
    by_score = scored.groupBy(F.col(score).alias("__score")).agg(
        F.count_if(F.col(label) == 1).alias("__pos"),
        F.count_if(F.col(label) != 1).alias("__neg"),
    )
    ranked = with_running_total(by_score, ["__score"], "__neg", "__upto", pieces)
    # Exact for any count: wins may exceed what a bigint product can hold.
    beaten = F.col("__upto").cast("double") - F.col("__neg") / F.lit(2.0)
    pairs = F.col("n_positive").cast("double") * F.col("n_negative")
    auc = F.try_divide(F.col("__wins"), pairs)
    return ranked.agg(
        F.sum("__pos").alias("n_positive"),
        F.sum("__neg").alias("n_negative"),
        F.sum(F.col("__pos") * beaten).alias("__wins"),
    ).select(
        "n_positive",
        "n_negative",
        (auc if digits is None else guarded_round(auc, digits)).alias("roc_auc"),
    )


def to_long(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """One ``(metric, value)`` row per column of a one-row table."""
    rounded = metrics.select(
        *[guarded_round(F.col(c).cast("double"), digits).alias(c) for c in metrics.columns]
    )
    return rounded.unpivot([], list(metrics.columns), "metric", "value")
