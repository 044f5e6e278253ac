"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDING_GUARD = 1e-9


def guarded_round(value: Column, digits: int) -> Column:
    """Round half away from zero, with ties decided on the decimal value.

    A mean of 4-digit numbers often sits on a tie such as 0.95835, whose nearest
    double lies just below it. The guard lifts such values over the tie, so the
    result does not depend on the order in which partial sums were merged.
    """
    return F.round(value + F.signum(value) * F.lit(ROUNDING_GUARD), digits)


def spec_flag(value: Column, target: float = 50.0, tolerance: float = 0.30) -> Column:
    """1 where the value lies within ``target`` ± ``tolerance``, both ends included."""
    return (F.abs(value - F.lit(target)) <= F.lit(tolerance)).cast("int")


def capability_grade(
    cpk: Column, bad_below: float = 1.0, acceptable_from: float = 1.33
) -> Column:
    """``bad``, ``marginal`` or ``acceptable``; NULL where Cpk is unknown."""
    return (
        F.when(cpk < bad_below, F.lit("bad"))
        .when(cpk < acceptable_from, F.lit("marginal"))
        .when(cpk.isNotNull(), F.lit("acceptable"))
    )


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without time zone.

    A timestamp without zone is read in the session time zone, which
    :func:`shopfloor.session.build_session` sets to UTC.
    """
    return F.unix_micros(ts.cast("timestamp"))


def hash_bucket(key: Sequence[Column], buckets: int = 100) -> Column:
    """A bucket number in ``[0, buckets)`` that depends on the key alone.

    The first eight hex digits of the key's MD5 give the same bucket on any engine,
    for any row order and any partitioning.
    """
    text = F.concat_ws("|", *[column.cast("string") for column in key])
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(buckets)).cast("int")


def exact_sum(column: str) -> Column:
    """The sum as a double, added up as decimals of six digits: any order gives the same."""
    return F.sum(F.col(column).cast("decimal(28,6)")).cast("double")
