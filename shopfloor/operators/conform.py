"""Typed staging projections and conformance to the declared serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.functions import guarded_round
from shopfloor.operators.checks import pk_violations
from shopfloor.sources.schemas import ServingTable


def staged(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _served(value: Column, source: T.DataType, field: T.StructField) -> Column:
    kind = field.dataType
    if isinstance(source, T.DecimalType) and isinstance(kind, T.DecimalType):
        # Exact as it is: no way through a double, which holds some fifteen digits.
        return F.round(value, kind.scale).try_cast(kind)
    if isinstance(kind, T.DecimalType):
        # Rounded like every other published figure; NULL where it does not fit.
        return guarded_round(value.cast("double"), kind.scale).try_cast(kind)
    return value.try_cast(kind)


def conform(df: DataFrame, table: ServingTable) -> DataFrame:
    """``df`` in the serving table's columns, names, types and precision.

    A value that does not fit becomes NULL, which :func:`conform_violations` reports.
    """
    source_of = {new: old for old, new in table.renames.items()}
    return df.select(
        *[
            _served(F.col(source), df.schema[source].dataType, f).alias(f.name)
            for f in table.schema
            for source in [source_of.get(f.name, f.name)]
        ]
    )


def conform_violations(conformed: DataFrame, table: ServingTable) -> DataFrame:
    """``rule, failures`` for NOT NULL, text length and primary key of a table."""
    rules: dict[str, Column] = {}
    for field in table.schema:
        if not field.nullable:
            rules[f"not_null_{field.name}"] = F.col(field.name).isNull()
    for name, limit in table.max_length.items():
        rules[f"max_length_{name}"] = F.length(name) > limit
    counted = conformed.agg(*[F.count_if(bad).alias(rule) for rule, bad in rules.items()])
    report = counted.unpivot([], list(rules), "rule", "failures")
    if table.key:
        broken = pk_violations(conformed, table.key).agg(F.count("*").alias("failures"))
        rule = F.lit(f"primary_key_{'_'.join(table.key)}")
        report = report.unionByName(broken.select(rule.alias("rule"), "failures"))
    return report
