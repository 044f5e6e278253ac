import re
from collections import Counter

import duckdb
import pytest
from brute import words_of
from shopfloor.llm import quality


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_on_odd_rows(make_documents, odd_rows):
    rows = [
        *odd_rows,
        (50, "a b c a b c a b", "en", "s"),
        (51, "x y z\nx y z\n\n \nx y z # * <b>|&", "en", "s"),
        (52, "\x0bein\x0czwei\rdrei vier \U0001f600$%", "en", "s"),
        (53, "a a a a a", "en", "s"),
    ]
    found = quality.judged(make_documents(rows), keep=["doc_id", "text", "kept", "row"]).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[c] for c in COLUMNS) == plain_counts(r["row"]["text"])
        words, repeated = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (words < 50 or 100 * repeated > 50 * words)
        assert not (r["base_failed"] and r["kept"])


def test_query_equals_plain_counts_and_sql(spark, sf_dir):
    found = quality.op7_adaptive_quality(spark, sf_dir)
    rows = sorted(tuple(r) for r in found.collect())
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in rows:
        assert r[1:6] == plain_counts(texts[r[0]])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    columns = ", ".join(found.columns)
    assert rows == sorted(con.execute(f"SELECT {columns} FROM ({quality.ORACLE_OP7})").fetchall())


def test_thresholds_adapt_to_the_group(make_documents):
    """What is usual for one source is an outlier in another."""
    plain = " ".join(f"word{i}" for i in range(80))
    marked = " ".join(f"word{i}$$$" for i in range(80))
    rows = [(i, plain + f" p{i}", "en", "calm") for i in range(300)]
    rows += [(1000 + i, marked + f" p{i}", "en", "loud") for i in range(300)]
    rows += [(5000, marked, "en", "calm")]
    found = quality.judged(make_documents(rows), keep=["doc_id"]).collect()
    kept = {r["row"]["doc_id"] for r in found if r["kept"]}
    assert kept == {r[0] for r in rows} - {5000}


def test_small_groups_use_the_merged_sketch(make_documents):
    plain = " ".join(f"word{i}" for i in range(80))
    rows = [(i, plain + f" p{i}", "en", f"s{i % 100}") for i in range(300)]
    rows += [(900, plain.replace(" ", "% "), "en", "s1")]
    found = quality.judged(make_documents(rows), keep=["doc_id"]).collect()
    assert {r["row"]["doc_id"] for r in found if not r["kept"]} == {900}


def test_sketches_merge(make_documents, spark):
    df = make_documents([(i, "w " * (50 + i % 7), "en", "s") for i in range(40)])
    counts = quality.with_counts(df.select("lang", "source", "text"), "text")
    whole = quality.sketches(counts).collect()
    parts = quality.sketches(counts.where("n_words % 2 = 0")).union(
        quality.sketches(counts.where("n_words % 2 = 1"))
    )
    merged = parts.groupBy("lang", "source", "measure", "value").sum("n").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, merged))


def test_empty_table(make_documents):
    empty = make_documents([(1, "x", "en", "s")]).where("false")
    assert quality.judged(empty, keep=["doc_id"]).collect() == []


@pytest.mark.parametrize("value, rounded", [(0, 0), (31, 31), (33, 32), (1023, 992)])
def test_values_keep_five_digits(spark, value, rounded):
    assert spark.range(1).selectExpr(f"bigint({value}) AS v").select(quality._rounded("v")).first()[0] == rounded
