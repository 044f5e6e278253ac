import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from shopfloor.llm import crosstoken, tokens
from shopfloor.scratch import materialize

A, B = tokens.default_tokenizer(), crosstoken.default_pieces()


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_level():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, n = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            table[chr(256 + n)] = b
            n += 1
    return table


def plain_tokens(text, encoders, table):
    """(id, end offset) of both tokenizers' tokens, or none if they do not spell the text."""
    if not text:
        return [], []
    first, second = encoders
    whole = (" " + text).encode()
    found = first.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(table[c] for c in first.id_to_token(i))) for i in found.ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()
        b.append((i, raw))
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    out = []
    for side in (a, b):
        at, ends = 0, []
        for i, raw in side:
            at += len(raw)
            ends.append((i, at))
        out.append(ends)
    return out


def plain_rows(texts, encoders):
    """The contract's rows by offsets, one text at a time."""
    table = byte_level()
    aligned, count = [], Counter()
    for doc_id, text in texts:
        a, b = plain_tokens(text, encoders, table)
        links = [(i, j) for i, x in a for j, y in b if x == y] if len(a) < 300 else None
        if links is None:
            at = {y: j for j, y in b}
            links = [(i, at[x]) for i, x in a if x in at]
        count.update(links)
        aligned.append((doc_id, a, b, links))
    best = defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    rows = []
    for doc_id, a, b, links in aligned:
        common = sorted({x for _, x in a} & {y for _, y in b})
        groups, at = [], 0
        for end in common:
            left = ",".join(str(i) for i, x in a if at < x <= end) if len(a) < 300 else None
            if left is None:
                groups = None
                break
            groups.append(left + "|" + ",".join(str(j) for j, y in b if at < y <= end))
            at = end
        digest = "" if not a else None if groups is None else hashlib.sha256(";".join(groups).encode()).hexdigest()
        top = sum(count[x] == best[x[1]] for x in links)
        rows.append((doc_id, len(a), len(b), len(common), len(links), top, sum(count[x] for x in links), digest))
    return rows


ODD = [
    (0, None), (1, ""), (2, " "), (3, "a  b\t\n c"), (4, "<|endoftext|> </s> <unk> <0x41>"), (5, "漢字 ½ é é ﬁ 𝔘"),
    (6, "▁x ▁"), (7, "plain words, plain words"), (7, "plain words, plain words"), (None, "no id"),
    (8, "\x00 nul \x1c"), (9, "word " * 5000), (10, "x" * 3000), (11, "  "), (12, "Ａ　b ​"),
]


def test_odd_rows_are_the_plain_version(spark, encoders):
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("row", F.lit("mine")).withColumn("a", F.lit(1))
    expected = plain_rows(ODD, encoders)
    for part_pairs in (crosstoken.PART_PAIRS, 1):
        found = crosstoken.aligned_documents(df, part_pairs=part_pairs).collect()
        rows = sorted(
            (
                r["doc_id"] is None, r["doc_id"] or 0, r["n_a"], r["n_b"], r["n_links"], r["n_best"], r["count_sum"],
                hashlib.sha256(r["groups"].encode()).hexdigest() if r["n_a"] else "",
            )
            for r in found
        )
        plain = sorted((e[0] is None, e[0] or 0, e[1], e[2], e[4], e[5], e[6], e[7]) for e in expected)
        for mine, theirs in zip(rows, plain, strict=True):
            assert mine[:-1] == theirs[:-1]
            assert theirs[-1] in (mine[-1], None)
    assert crosstoken.aligned_documents(df.where("false")).collect() == []


def test_query_is_the_plain_version(spark, sf_dir, encoders):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: tuple(r) for r in crosstoken.op12_cross_tokenizer_alignment(spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    digests = 0
    for expected in plain_rows([tuple(t) for t in texts], encoders):
        found = rows[expected[0]]
        assert found[:-1] == expected[:-1]
        if expected[-1] is not None:
            assert found[-1] == expected[-1]
            digests += 1
    assert digests > 20


@given(st.sets(st.integers(0, 2**48), max_size=400))
@settings(max_examples=60, deadline=None)
def test_hash_is_minimal_and_perfect(keys):
    keys = np.array(sorted(keys), dtype=np.int64)
    sizes, bits = crosstoken.build_hash(keys)
    slots = crosstoken.PerfectHash(1, 0, [sizes], [bits]).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_counts_by_a_deep_tree_and_unknown_pairs(spark):
    rng = np.random.default_rng(1)
    rows = [(int(t), int(p), int(n)) for t, p, n in zip(
        rng.integers(0, 40, 5000), rng.integers(0, 900, 5000) << 32 | 7, rng.integers(1, 9, 5000), strict=True)]
    expected = Counter()
    for _, p, n in rows:
        expected[p] += n
    partial = materialize(spark.createDataFrame(rows, "task long, pair long, n long"), "partial")
    segments = 5
    hashes = materialize(crosstoken.perfect_hash(partial.select("pair").distinct(), segments), "hash")
    counts = crosstoken.dense_counts(partial, hashes, segments, 40, fan=3)
    model = hashes.join(counts, "segment").orderBy("segment").toArrow()
    known = np.array(sorted(expected), dtype=np.int64)
    table = crosstoken.Counts(segments, 0, model)
    assert table.of(known).tolist() == [expected[p] for p in known.tolist()]
    assert table.of(known + 1).tolist() == [0] * len(known)
    # A part of the segments knows its own pairs only.
    own = crosstoken.segment_of(known, segments)
    half = crosstoken.Counts(segments, 2, model.filter(np.isin(model["segment"], [2, 3])))
    assert half.of(known).tolist() == [
        expected[p] if s in (2, 3) else 0 for p, s in zip(known.tolist(), own.tolist(), strict=True)
    ]


def test_vocabularies():
    assert tokens.token_bytes(A)[262] == b" the" and len(tokens.token_bytes(A)) == 50257
    assert min(map(len, tokens.token_bytes(A))) == 1
    assert min(map(len, crosstoken.piece_bytes(B))) == 1 and crosstoken.piece_bytes(B)[3] == b"\x00"
