import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from shopfloor.llm import runs


def plain_runs(words, least=6, times=4):
    """All runs by comparing every lag, smallest periods by trying all divisors."""
    found = []
    n = len(words)
    for q in range(1, n):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            end = x
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - x + q
            own = words[x : x + length]
            smaller = any(own[d:] == own[:-d] for d in range(1, q))
            if length >= max(least, times * q) and not smaller:
                found.append((x, length, q))
            x = end
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The contract's row, word by word."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(found),
        *best,
        None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
        n,
    )


def found_runs(words, **options):
    table = {w: i for i, w in enumerate(dict.fromkeys(words))}
    numbers = np.array([table[w] for w in words], dtype=np.int64)
    rows = runs.runs_of(numbers, np.array([len(words)]), **options)
    return [tuple(r[1:]) for r in rows.tolist()]


@given(st.lists(st.sampled_from("abc"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_runs_of_random_words(words):
    assert found_runs(words) == plain_runs(words)


@given(
    st.lists(
        st.tuples(st.lists(st.sampled_from("ab"), min_size=1, max_size=13), st.integers(1, 9)),
        min_size=1,
        max_size=5,
    )
)
@settings(max_examples=300, deadline=None)
def test_runs_of_repeated_stretches(parts):
    words = [w for part, n in parts for w in part * n]
    assert found_runs(words) == plain_runs(words)


def test_periods_of_every_class_and_multiples():
    for q in (1, 2, 3, 4, 5, 8, 9, 16, 17, 33, 64, 65):
        unit = ["a"] * (q - 1) + ["b"]
        words = ["x", *unit * 4, *unit[: q // 2], "y", *unit * 3, "z"]
        assert found_runs(words) == plain_runs(words)


def test_several_texts_do_not_touch():
    numbers = np.array([1] * 5 + [1] * 5 + [1] * 7 + [1, 2] * 4 + [1, 2] * 4)
    rows = runs.runs_of(numbers, np.array([5, 5, 7, 0, 8, 8])).tolist()
    assert rows == [[2, 0, 7, 1], [4, 0, 8, 2], [5, 0, 8, 2]]


def test_other_bounds():
    words = list("ababab" + "c" + "aaaa" + "xyzxyzxyz")
    assert found_runs(words, least=3, times=3) == plain_runs(words, 3, 3)
    with pytest.raises(ValueError):
        runs.runs_of(np.array([1]), np.array([1]), least=20, times=4)


def test_query_is_the_plain_version(spark, sf_dir):
    rows = {tuple(r) for r in runs.op11_periodic_runs(spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [(i, t) for i, t in texts if len((t or "").split()) <= 600]
    assert len(rows) == len(texts) and len(short) > 100
    planted = 0
    for doc_id, text in short:
        expected = plain_row(doc_id, text)
        assert expected in rows
        planted += bool(expected[1])
    assert planted >= 10


def test_odd_rows(spark, make_documents, odd_rows):
    df = make_documents(odd_rows)
    found = sorted((tuple(r) for r in runs.periodic_runs(df).collect()), key=str)
    assert len(found) == len(odd_rows)
    by_id = {r[0]: r for r in found}
    assert by_id[0][1:] == (0, [], "") and by_id[2][1:] == (0, [], "")
    # 60,000 words that repeat after 977: one run, of which 977 words stay.
    assert [tuple(r) for r in by_id[20][2]] == [(0, 60_000, 977)]
    assert len(by_id[20][3].split()) == 977
    assert runs.periodic_runs(df.where("false")).collect() == []


def test_a_text_of_one_word_and_a_long_nested_one(make_documents):
    rows = [(1, "na " * 200_000, "en", "s"), (2, ("a a a a a a a b " * 50 + "c ") * 40, "en", "s")]
    found = {r[0]: r for r in runs.periodic_runs(make_documents(rows)).collect()}
    assert [tuple(r) for r in found[1]["runs"]] == [(0, 200_000, 1)] and found[1]["collapsed"] == "na"
    words = rows[1][1].split()
    small = plain_runs(words[:1203])
    assert [tuple(r) for r in found[2]["runs"] if r["start"] + r["length"] < 1203 and r["period"] < 401] == [
        r for r in small if r[0] + r[1] < 1203
    ]
    assert (0, len(words), 401) in [tuple(r) for r in found[2]["runs"]]
