import random

from brute import jaccard_components
from shopfloor.llm import jaccard, shingles

import numpy as np
import pyarrow as pa


def components(df, words, percent):
    found = jaccard.similarity_components(df, words, percent).collect()
    return sorted((r["id"], r["n"], r["component"]) for r in found)


def near_copies(seed: int, groups: int, copies: int) -> list[tuple]:
    """Groups of edited copies, with passages that documents of many groups share."""
    rng = random.Random(seed)
    shared = [" ".join(f"p{rng.randrange(9999)}" for _ in range(30)) for _ in range(3)]
    rows, key = [], 0
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(20, 150))]
        for _ in range(rng.randrange(1, copies)):
            words = list(base)
            for _ in range(rng.randrange(0, 7)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            if rng.random() < 0.4:
                words += shared[rng.randrange(3)].split()
            rows.append((key, " ".join(words), "en", "s"))
            key += 1
    rows += [(key + i, rows[i][1].upper(), "en", "s") for i in range(20)]
    return rows


def test_components_equal_brute_force_on_near_copies(make_documents):
    rows = near_copies(5, groups=40, copies=25)
    for words, percent in ((4, 85), (2, 60)):
        expected = jaccard_components([r[:2] for r in rows], words, percent)
        assert components(make_documents(rows), words, percent) == sorted(expected)


def test_one_large_group_of_near_copies(make_documents):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(140)]
    rows = []
    for key in range(400):
        words = list(base)
        for _ in range(rng.randrange(0, 8)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((key, " ".join(words), "en", "s"))
    expected = jaccard_components([r[:2] for r in rows], 4, 85)
    assert components(make_documents(rows), 4, 85) == sorted(expected)


def test_query_equals_brute_force(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = jaccard.op4_ngram_jaccard_join(spark, sf_dir).collect()
    expected = jaccard_components([tuple(r) for r in given], 4, 85)
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_odd_rows(make_documents, odd_rows):
    found = jaccard.similarity_components(make_documents(odd_rows), 4, 85).collect()
    by_id = {r["id"]: r for r in found}
    assert len(found) == len(odd_rows)
    assert by_id[0]["n"] == by_id[1]["n"] == by_id[2]["n"] == 0
    assert by_id[0]["component"] == 0 and by_id[2]["component"] == 2
    assert by_id[3]["n"] == by_id[4]["n"] == 1
    assert by_id[20]["component"] == by_id[21]["component"] == 20
    assert sum(r["id"] is None for r in found) == 2


def test_empty_table(make_documents):
    empty = make_documents([(1, "x", "en", "s")]).where("false")
    assert jaccard.similarity_components(empty, 4, 85).collect() == []
    assert jaccard.one_of_each(empty).collect() == []


def test_one_of_each_keeps_blank_rows_and_one_row_per_group(make_documents, odd_rows):
    rows = [*odd_rows, *near_copies(3, groups=6, copies=6)[:30]]
    rows = [(None if r[0] is None else r[0] + 100 * (i >= len(odd_rows)), *r[1:]) for i, r in enumerate(rows)]
    df = make_documents(rows)
    kept = jaccard.one_of_each(df, words=5, percent=80)
    assert kept.columns == df.columns
    # Rows without id stand for themselves in the plain version by an id no row has.
    named = [(10**9 if r[0] is None else r[0], r[1]) for r in rows]
    expected = jaccard_components(named, 5, 80)
    groups = {c for (key, n, c) in expected if n}
    blanks = sum(n == 0 for _, n, _ in expected)
    assert kept.count() == len(groups) + blanks


def test_bitmaps_bound_the_common_tokens():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in (3, 50, 400, 800)]
    many = shingles.Sets(np.concatenate(sets), np.cumsum([len(s) for s in sets]))
    maps = shingles.bitmaps(many)
    for a, one in zip(sets, maps, strict=True):
        for b, two in zip(sets, maps, strict=True):
            assert shingles.most_common(one, two, len(a), len(b)) >= len(np.intersect1d(a, b))


def test_shingles_follow_the_word_windows():
    texts = ["A b\tc d  e", "a B c d E", "a b c", "", None, "a b c d x a b c d"]
    sets = [s for _, s in shingles.slabs(pa.array(texts, pa.string()), 4)]
    sizes = np.concatenate([s.sizes() for s in sets]).tolist()
    assert sizes == [2, 2, 1, 0, 0, 5]
    c1, c2 = shingles.signatures(sets[0])
    assert c1[0] == c1[1] and c2[0] == c2[1] and c1[0] != c1[2]
