"""Equi-joins in which NULL keys match, without ambiguous columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(
    left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "inner"
) -> DataFrame:
    """``left`` with the columns of ``right``; the key appears once, NULL equals NULL.

    Grouping treats NULL as a value, so a group with a NULL key has to find its
    aggregate again.
    """
    renamed = {column: f"__right_{column}" for column in key}
    other = right.withColumnsRenamed(renamed)
    matches = [F.col(c).eqNullSafe(F.col(renamed[c])) for c in key]
    joined = left.join(other, reduce(lambda a, b: a & b, matches), how)
    return joined.drop(*renamed.values())
