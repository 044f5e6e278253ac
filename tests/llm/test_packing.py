import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from shopfloor.llm import packing, tokens
from shopfloor.scratch import materialize


@pytest.fixture(scope="module")
def encoder():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def check_places(rows, capacity):
    """Every piece has its place, and the places of a sequence have no gap."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query_round_trip(spark, sf_dir, encoder):
    rows = packing.op6_linear_grouping_packing(spark, sf_dir).collect()
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    used = check_places(rows, 1024)
    assert used <= -(-sum(r["length"] for r in rows) // 1024) * 1.05 + 1
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert len(pieces) == len(texts)
    for doc_id, text in texts:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 1024 for r in own[1:])
        assert len(own) == max(1, -(-len(ids) // 1024))
        at = 0
        for r in own:
            raw = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(raw))
            at += r["length"]


def test_odd_rows_and_sequences(spark, make_documents, odd_rows, encoder):
    df = make_documents(odd_rows)
    rows = packing.packed_documents(df, max_tokens=64).collect()
    check_places(rows, 64)
    total = sum(len(encoder.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in odd_rows)
    assert sum(r["length"] for r in rows) == total
    assert packing.packed_documents(df.where("false")).collect() == []


@given(
    st.lists(
        st.text(st.sampled_from(" \n\t\r\x0b'sdmtlvreabcXYZ019éß²½×ɏ.,!#|¡\x85\xa0\u2003\x1c漢½١<>")), max_size=6
    )
)
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_tokenizer(encoder, texts):
    texts = [*texts, "it's we'll I'D  don't<|endoftext|> x", "  \n\n a  b\t"]
    texts += [" " * 500 + "x", "a" * 700, "\r\n \t" * 200, ("b" + " " * 399) * 3]
    encoder.encode_special_tokens = True
    found = tokens.Encoder(packing.default_tokenizer()).ids(texts)
    for text, ids in zip(texts, found, strict=True):
        whole = encoder.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == whole


def test_sequences_hold_the_ids(make_documents, encoder):
    df = make_documents([(i, "some words " * i, "en", "s") for i in range(12)])
    cut = materialize(packing.cut_documents(df, packing.default_tokenizer(), 32), "cut")
    packed = packing.pack(cut, ["doc_id", "piece"], 32)
    for row in packing.sequences(packed).collect():
        assert len(row["ids"]) % 4 == 0 and len(row["ids"]) <= 32 * 4
        assert row["begins"][0] == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_rank_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 64
    counts = np.zeros(capacity + 1, dtype=np.int64)
    some = rng.choice(np.arange(1, capacity + 1), rng.integers(1, capacity), replace=False)
    counts[some] = rng.integers(1, 400, len(some))
    runs, sequences = packing.plan_runs(counts, capacity)
    order = np.lexsort((runs.rank, runs.length))
    rows, seen = [], np.zeros_like(counts)
    for k, i in enumerate(order):
        length, rank = runs.length[i], runs.rank[i]
        after = k + 1 < len(order) and runs.length[order[k + 1]] == length
        stop = runs.rank[order[k + 1]] if after else counts[length]
        for nth in range(stop - rank):
            rows.append(
                {
                    "sequence_id": runs.sequence[i] + nth // runs.per[i],
                    "offset": runs.offset[i] + nth % runs.per[i] * length,
                    "length": length,
                }
            )
        seen[length] += stop - rank
    assert (seen == counts).all()
    assert check_places(rows, capacity) == sequences
    lower = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    half = counts[capacity // 2 + 1 :].sum()
    assert sequences <= 1.25 * max(lower, half) + 2


def test_configurations_cover_the_demand():
    sizes, demand = [60, 45, 40, 30, 21], [50, 40, 70, 90, 33]
    plan = packing.configurations(sizes, demand, 100)
    covered = sum(use * mix for mix, use in plan)
    assert (covered >= np.array(demand) - 1e-6).all()
    assert all((mix * sizes).sum() <= 100 for mix, _ in plan)
    assert sum(use for _, use in plan) <= sum(demand)


def test_groups_are_of_equal_cardinality():
    counts = np.zeros(101, dtype=np.int64)
    counts[[30, 50, 51, 52, 90]] = [7, 10, 5, 5, 13]
    sizes, members = packing.group_lengths(counts, 20, 4)
    # The first two groups of ten have the same largest length and are one size.
    assert [sum(m.values()) for m in members] == [20, 10, 10]
    assert sizes == sorted(sizes, reverse=True)
    assert all(max(m) <= s for s, m in zip(sizes, members, strict=True))


def test_literals_of_added_tokens_are_those_tokens(make_documents):
    """The ids are those of a tokenizer in its default state."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    literals = [x.content for x in plain.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in literals
    texts = [f"{a}{x}{b}" for x in literals for a, b in (("", ""), ("hello ", " world"), ("don't", "x"))]
    texts += [x * 2 for x in literals] + ["hello <|endoftext| world", "漢<|endoftext|>", "  a  b\t"]
    df = make_documents([(i, t, "en", "s") for i, t in enumerate(texts)])
    rows = packing.cut_documents(df, packing.default_tokenizer(), 1024, end_id=2).collect()
    found = {r["doc_id"]: np.frombuffer(r["ids"], dtype="<u4").tolist() for r in rows}
    for i, text in enumerate(texts):
        assert found[i] == [*plain.encode(text, add_special_tokens=False).ids, 2]
    assert found[texts.index("hello <|endoftext|> world")] == [31373, 220, 50256, 995, 2]
