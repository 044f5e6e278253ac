import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from shopfloor.llm import mixing


def test_raking_meets_the_margins():
    rng = np.random.default_rng(0)
    tokens = rng.integers(100, 1000, (4, 3, 2)).astype(float)
    margins = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.3, 0.2]), np.array([0.55, 0.45])]
    fitted = mixing.rake(tokens, margins, 0.3)
    assert (fitted <= tokens + 1e-9).all()
    for axis, share in enumerate(margins):
        others = tuple(a for a in range(3) if a != axis)
        assert np.allclose(fitted.sum(axis=others), share * 0.3 * tokens.sum(), rtol=1e-5)


def test_raking_with_empty_slices_and_too_few_tokens():
    tokens = np.array([[10.0, 0.0], [0.0, 0.0], [90.0, 100.0]])
    fitted = mixing.rake(tokens, [np.array([0.5, 0.2, 0.3]), np.array([0.5, 0.5])], 0.9)
    assert (fitted <= tokens).all() and fitted[0, 0] == 10
    assert mixing.rake(np.zeros((2, 2)), [np.ones(2), np.ones(2)], 0.5).sum() == 0


def test_expected_and_drawn_tokens_follow_the_targets(make_documents):
    rng = np.random.default_rng(3)
    rows = [
        (i, "w " * int(rng.integers(5, 40)), str(rng.choice(["en", "de"], p=[0.9, 0.1])), str(rng.choice(["a", "b", "c"])))
        for i in range(6000)
    ]
    targets = mixing.Targets({"source": {"a": 0.5, "*": 0.5}, "lang": {"en": 0.8, "de": 0.2}}, budget=0.4)
    df = make_documents(rows)
    found = mixing.sampled(
        df, targets, {"source": F.col("source"), "lang": F.col("lang")}, ["doc_id"], mixing.word_count("text")
    ).collect()
    total = sum(len(r[1].split()) for r in rows)
    drawn = sum(r["tokens"] for r in found)
    assert abs(drawn / (0.4 * total) - 1) < 0.06
    for name, value, share in (("source", "a", 0.5), ("source", "*", 0.5), ("lang", "de", 0.2)):
        own = sum(r["tokens"] for r in found if r[name] == value)
        assert abs(own / drawn - share) < 0.04


def test_query_equals_plain_version(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    targets = mixing.DOCUMENT_TARGETS
    cells, placed = {}, []
    for r in rows:
        n = len((r["text"] or "").split())
        topic = "listing" if " | " in (r["text"] or "") else "passage" if n < 500 else "article"
        named = (r["source"], r["lang"], topic)
        cell = tuple(v if v in targets.shares[d] else "*" for d, v in zip(targets.names, named, strict=True))
        cells[cell] = cells.get(cell, 0) + n
        placed.append((r["doc_id"], n, cell))
    labels = [sorted({*targets.shares[d], "*"}) for d in targets.names]
    held = np.zeros([len(x) for x in labels])
    for cell, n in cells.items():
        held[tuple(x.index(v) for x, v in zip(labels, cell, strict=True))] = n
    margins = [np.array([targets.shares[d].get(v, 0) for v in x]) for d, x in zip(targets.names, labels, strict=True)]
    fitted = mixing.rake(held, margins, targets.budget)
    expected = {}
    for doc_id, n, cell in placed:
        at = tuple(x.index(v) for x, v in zip(labels, cell, strict=True))
        chance = fitted[at] / held[at] if held[at] else targets.budget
        draw = int(hashlib.md5(f"{targets.seed}:{doc_id}".encode()).hexdigest()[:12], 16) / 2**48
        if draw < chance:
            expected[doc_id] = (n, round(chance, 9))
    found = mixing.op10_raked_mixture(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["tokens"], round(r["probability"], 9)) for r in found} == expected


def test_odd_rows(make_documents, odd_rows):
    df = make_documents(odd_rows)
    found = mixing.sampled_documents(df, keep=df.columns)
    rows = found.collect()
    ids = [r["row"]["doc_id"] for r in rows]
    assert ids.count(20) in (0, 2)
    assert all(0 < r["probability"] <= 1 for r in rows)
    assert mixing.sampled_documents(df.where("false"), keep=df.columns).collect() == []


def test_null_and_unlisted_languages_keep_the_share_of_the_budget(make_documents):
    rng = np.random.default_rng(5)
    langs = ["en", "en", "de", "fr", "es", "it", None]
    rows = [
        (i, "w " * int(rng.integers(5, 900)), langs[i % len(langs)], f"src{i % 3}") for i in range(4200)
    ]
    found = mixing.sampled_documents(make_documents(rows), keep=["doc_id", "lang"]).collect()
    expected = {}
    for r in found:
        lang = r["row"]["lang"]
        expected[lang] = expected.get(lang, 0) + r["tokens"]
    given = {}
    for _, text, lang, _ in rows:
        given[lang] = given.get(lang, 0) + len(text.split())
    budget, named = mixing.DOCUMENT_TARGETS.budget, mixing.DOCUMENT_TARGETS.shares["lang"]
    for lang in ("it", None):
        assert abs(expected[lang] / given[lang] - budget) < 0.06
    rest = sum(expected[lang] for lang in named)
    for lang, share in named.items():
        assert abs(expected[lang] / rest - share) < 0.04


def test_unnamed_values_alone_and_an_entry_of_zero(make_documents):
    df = make_documents([(i, "some words here", "it", "s") for i in range(400)])
    dimensions = {"lang": F.col("lang")}
    for shares, least, most in (({"en": 1.0}, 170, 230), ({"en": 0.5, "*": 0.5}, 170, 230)):
        targets = mixing.Targets({"lang": shares}, budget=0.5)
        found = mixing.sampled(df, targets, dimensions, ["doc_id"], mixing.word_count("text"))
        assert least <= found.count() <= most
    both = df.union(make_documents([(1000 + i, "some words here", "en", "s") for i in range(400)]))
    targets = mixing.Targets({"lang": {"en": 1.0, "*": 0.0}}, budget=0.4)
    found = mixing.sampled(both, targets, dimensions, ["lang"], F.lit(3)).collect()
    assert found and {r["lang"] for r in found} == {"en"}


def test_raking_is_the_plain_one():
    """Fitting cell by cell with loops, the caps at what a cell holds included."""
    rng = np.random.default_rng(4)
    for _ in range(5):
        tokens = rng.integers(0, 500, (3, 4)).astype(float)
        tokens[0, 1] = 0
        margins = [rng.random(3) + 0.2, rng.random(4) + 0.2]
        cells = {at: v for at, v in np.ndenumerate(tokens)}
        total = tokens.sum()
        fitted = {at: v * 0.3 for at, v in cells.items()}
        for _ in range(5000):
            for axis, share in enumerate(margins):
                for k, part in enumerate(share):
                    own = [at for at in cells if at[axis] == k]
                    now = sum(fitted[at] for at in own)
                    if now:
                        for at in own:
                            fitted[at] *= part / share.sum() * 0.3 * total / now
            fitted = {at: min(v, cells[at]) for at, v in fitted.items()}
        found = mixing.rake(tokens, margins, 0.3)
        for at, v in fitted.items():
            assert found[at] == pytest.approx(v, abs=1e-3 * total)
