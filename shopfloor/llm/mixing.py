"""Mixing sources to target weights by iterative proportional fitting.

The tokens per cell (source, language, topic) are raked until their margins have the target
shares of a token budget, with no cell asked for more than it holds. A document is kept with
its cell's probability, raked tokens over given tokens, decided by a hash of its id, so that
every run keeps the same documents and the expected tokens meet the targets.

Values that the targets do not name share the entry ``OTHER``. So the cells are bounded by
the targets, whatever the data hold; these sums are all the driver collects, and fitting
them takes milliseconds. The documents are read twice and not shuffled.

Targets without an entry ``OTHER`` say nothing about unnamed values: these keep the budget's share
of their tokens, and the targets hold for the tokens that remain. Nulls and unlisted languages are
sampled like that in ``DOCUMENT_TARGETS``; an entry ``OTHER`` of 0 leaves them out.

Edge cases: null values fall under ``OTHER``; targets of values without tokens are spread over
the rest; where no probabilities can meet the targets (too few tokens) the last iterate is
taken, which stays within the tokens there are; a null text or one without words has no tokens
and is kept by its cell's probability, or by the budget's share where the cell is empty; repeated
rows share their fate; a null id hashes as "null"; an empty table gives an empty result. The
kept columns sit in a struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.layout import WORD, table

OTHER = "*"
CYCLES = 500
TOLERANCE = 1e-9


@dataclass(frozen=True)
class Targets:
    """Target shares per dimension and the budget as a share of all tokens."""

    shares: Mapping[str, Mapping[str, float]]
    budget: float = 0.5
    seed: int = 17
    names: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "names", tuple(self.shares))


def rake(tokens: np.ndarray, margins: Sequence[np.ndarray], budget: float) -> np.ndarray:
    """Tokens per cell with the target margins, at most the given ones.

    ``margins`` are shares per dimension; those of slices without tokens are spread over the rest.
    """
    total = float(tokens.sum())
    if not total:
        return np.zeros_like(tokens, dtype=float)
    axes = range(tokens.ndim)
    wanted = []
    for axis, share in zip(axes, margins, strict=True):
        held = tokens.sum(axis=tuple(a for a in axes if a != axis))
        share = np.where(held > 0, share, 0.0)
        if not share.sum():
            share = held
        wanted.append(share / share.sum() * budget * total)
    fitted = tokens * budget
    for _ in range(CYCLES):
        before = fitted
        for axis, target in zip(axes, wanted, strict=True):
            others = tuple(a for a in axes if a != axis)
            now = fitted.sum(axis=others)
            factor = np.divide(target, now, out=np.ones_like(now), where=now > 0)
            fitted = fitted * np.expand_dims(factor, others)
        fitted = np.minimum(fitted, tokens)
        if np.abs(fitted - before).max() <= TOLERANCE * total:
            break
    return fitted


def _shares(held: np.ndarray, labels: Sequence[str], shares: Mapping[str, float]) -> np.ndarray:
    """Shares in the order of ``labels``, given the tokens that each holds."""
    wanted = np.array([shares.get(v, 0.0) for v in labels])
    at = labels.index(OTHER)
    if OTHER in shares or not held[at]:
        return wanted
    # Unnamed values keep what they hold; the named ones with tokens share the rest.
    unnamed = held[at] / held.sum()
    wanted = np.where(held > 0, wanted, 0.0)
    if not wanted.sum():
        return held / held.sum()
    wanted *= (1 - unnamed) / wanted.sum()
    wanted[at] = unnamed
    return wanted


def _named(column: Column, shares: Mapping[str, float]) -> Column:
    known = [name for name in shares if name != OTHER]
    value = column.cast("string")
    return F.when(value.isin(known), value).otherwise(OTHER) if known else F.lit(OTHER)


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that follows from a key alike in Spark and in SQL."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 48)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sampled(
    documents: DataFrame,
    targets: Targets,
    dimensions: Mapping[str, Column],
    keep: Sequence[str],
    tokens: Column,
    key: str = "doc_id",
) -> DataFrame:
    """The sampled rows: ``row`` (a struct of ``keep``), the cell, ``tokens``, ``probability``."""
    names = targets.names
    rows = documents.select(
        F.struct(*keep).alias("row"),
        *[_named(dimensions[d], targets.shares[d]).alias(d) for d in names],
        tokens.alias("tokens"),
        uniform(F.col(key), targets.seed).alias("__draw"),
    )
    labels = [sorted({*targets.shares[d], OTHER}) for d in names]
    # At most one row per combination of target entries.
    cells = rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")).collect()
    held = np.zeros([len(x) for x in labels])
    for cell in cells:
        held[tuple(x.index(cell[d]) for d, x in zip(names, labels, strict=True))] = cell["tokens"]
    axes = range(len(names))
    margins = [
        _shares(held.sum(axis=tuple(a for a in axes if a != axis)), labels[axis], targets.shares[names[axis]])
        for axis in axes
    ]
    fitted = rake(held, margins, targets.budget)
    chance = np.divide(fitted, held, out=np.full_like(held, targets.budget), where=held > 0)
    listed = [
        (*[x[i] for i, x in zip(at, labels, strict=True)], float(p)) for at, p in np.ndenumerate(chance)
    ]
    schema = ", ".join([f"`{d}` string" for d in names] + ["probability double"])
    probabilities = documents.sparkSession.createDataFrame(listed, schema)
    return (
        rows.join(F.broadcast(probabilities), list(names))
        .where(F.col("__draw") < F.col("probability"))
        .select("row", *names, "tokens", "probability")
    )


# --- for documents -------------------------------------------------------------------

# Target shares of the registered query and the pipeline.
DOCUMENT_TARGETS = Targets(
    shares={
        "source": {"src0": 0.25, OTHER: 0.75},
        "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
        "topic": {"listing": 0.1, "passage": 0.5, "article": 0.4},
    },
    budget=0.6,
)


def topic(text: str, tokens: Column) -> Column:
    """Documents name no topic; this coarse one follows from their form and length."""
    listing = F.contains(F.coalesce(text, F.lit("")), F.lit(" | "))
    return F.when(listing, "listing").when(tokens < 500, "passage").otherwise("article")


def sampled_documents(
    documents: DataFrame, keep: Sequence[str], targets: Targets = DOCUMENT_TARGETS
) -> DataFrame:
    tokens = word_count("text")
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic("text", tokens)}
    return sampled(documents, targets, dimensions, keep, tokens)


def op10_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents sampled to the target weights."""
    found = sampled_documents(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", *found.columns[1:])
