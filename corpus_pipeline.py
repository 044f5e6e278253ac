"""The training-data pipeline: language, quality, near duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of ``documents``. A stage's result is written before the next one
starts, which then removes the intermediate tables of the stages before it.

Edge cases: repeated rows pass as often as they occur up to the near-duplicate stage, which
keeps one; rows without text go at the first stage; an empty table gives an empty result at
every stage; extra columns are carried along to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopfloor.llm import jaccard, langid, mixing, packing, quality
from shopfloor.llm.stages import in_stage, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those that the models reject go."""
    with in_stage(spark):
        learn = ~langid.held_out("doc_id")
        found = langid.identified(docs, learn, keep=docs.columns)
        return found.where("accepted").select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the cutoffs of their language and source."""
    with in_stage(spark):
        return quality.judged(docs, keep=docs.columns).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word similarity 0.8 or more."""
    with in_stage(spark):
        return jaccard.one_of_each(docs, words=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of source, language and topic."""
    with in_stage(spark):
        return mixing.sampled_documents(docs, keep=docs.columns).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    with in_stage(spark):
        return packing.packed_documents(docs)


STAGES = [
    ("language", language),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packed", packed),
]

# Character models, set similarity and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
