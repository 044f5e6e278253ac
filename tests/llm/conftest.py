import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def make_documents(spark):
    """Documents from (doc_id, text, lang, source) tuples, with columns whose names may clash."""

    def make(rows):
        full = [(*r, None if r[1] is None else len(r[1])) for r in rows]
        return (
            spark.createDataFrame(full, DOCUMENTS)
            .withColumn("row", F.lit("mine"))
            .withColumn("n", F.lit(1))
            .withColumn("tokens", F.lit(2))
            .withColumn("__rank", F.lit(3))
            .withColumn("learn", F.lit(False))
            .withColumn("kept", F.lit("x"))
        )

    return make


ODD_TEXTS = [None, "", " \n\t ", "word", "a b", "…", "ein zwei drei vier fünf sechs"]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, blank and very long texts, repeated rows."""
    long = " ".join(f"wort{i % 977}" for i in range(60_000))
    rows = [(i, text, "de", "s") for i, text in enumerate(ODD_TEXTS)]
    rows += [(20, long, "de", "s"), (20, long, "de", "s"), (21, long, None, None)]
    rows += [(None, "no id at all here", "en", "t"), (None, None, None, None)]
    return rows


def as_rows(df) -> list[Row]:
    return df.collect()
