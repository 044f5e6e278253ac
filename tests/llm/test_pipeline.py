import random

import corpus_pipeline
import pytest
from brute import jaccard_components
from shopfloor.llm import langid, quality
from shopfloor.scratch import materialize


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The result of every stage on the smallest tables, written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"test-{name}")
        out.append((name, docs))
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns_and_narrow_down(stages):
    for (_, before), (_, after) in zip(stages[:-2], stages[1:-1], strict=True):
        assert after.columns == before.columns
        assert set(ids(after)) <= set(ids(before))


def test_decisions_are_those_of_the_operators(stages):
    docs, language, rules, unique, mixed, packed = (df for _, df in stages)
    found = langid.identified(docs, ~langid.held_out("doc_id"), keep=["doc_id"])
    assert ids(language) == ids(found.where("accepted").select("row.doc_id"))
    judged = quality.judged(language, keep=["doc_id"])
    assert ids(rules) == ids(judged.where("kept").select("row.doc_id"))
    texts = [tuple(r) for r in rules.select("doc_id", "text").collect()]
    expected = {c for _, _, c in jaccard_components(texts, 5, 80)}
    assert set(ids(unique)) == expected
    assert sorted({r["doc_id"] for r in packed.collect()}) == ids(mixed)


def test_run_equals_the_stages(spark, sf_dir, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select(*columns).collect()))
    assert run == sorted(map(tuple, stages[-1][1].select(*columns).collect()))


def test_clean_documents_stay_and_junk_goes(spark, make_documents, sf_dir):
    rng = random.Random(2)
    words = [f"{a}{b}{c}" for a in "mnrst" for b in ("a", "en", "io") for c in ("lu", "der", "", "sch")]
    rows = [
        (i, "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(12)), "en", "s") for i in range(300)
    ]
    junk = [(900, None, "en", "s"), (901, "$$$ ### " * 60, "en", "s"), (902, "spam spam spam " * 80, "en", "s")]
    copies = [(1000 + i, rows[i][1], "en", "s") for i in range(5)]
    docs = make_documents([*rows, *junk, *copies])
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = materialize(stage(spark, docs, sf_dir), "test-clean")
    assert ids(docs) == [r[0] for r in rows]


def test_odd_rows_and_empty_table(spark, make_documents, odd_rows, sf_dir):
    for docs in (make_documents(odd_rows), make_documents(odd_rows).where("false")):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf_dir), "test-odd")
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
