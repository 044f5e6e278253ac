"""Alignment of two tokenizers' tokens, with corpus-wide counts behind a minimal perfect hash.

Both tokenizers' tokens cover the same bytes. Offsets where a token of either ends cut them into
groups; the two tokens that end there are linked. An id pair's count is how often it is linked in
the corpus.

1. Each text is encoded once; the ids are written, packed. A text of which either tokenizer's
   tokens do not spell the bytes has none.
2. The first pass aligns the texts from their ids and collects each task's distinct pairs with how
   often it met them.
3. The distinct pairs are dealt by hash into segments of about ``SEGMENT``. Each gets a minimal
   perfect hash: levels of bit arrays, in which a key that has a bit to itself stays and the
   others go on to the next level; a key's slot is the number of set bits before its own. The
   keys themselves lie in slot order, so that a look-up is verified.
4. Tasks' counts of a segment are added into a dense vector indexed by slot, one vector for
   every ``FAN`` tasks; vectors are then summed ``FAN`` at a time, as a tree, until each segment
   has one. No group holds more than ``FAN`` tasks' shares of one segment.
5. The second pass aligns the texts again and looks their pairs up. Every task holds the slots, keys
   and counts of at most ``PART_PAIRS`` pairs (17 bytes each); if there are more, the pass is
   repeated for each part of the segments and the parts' sums are added. The best count per id of
   the second tokenizer has one number for each entry of its vocabulary.

Frequent pairs are one slot like any other, and texts stay in their row: there is no hot key.

Edge cases: null and empty texts, and texts that either tokenizer changes, have no tokens and zeros;
literals of special tokens are plain text; repeated rows count as often as they occur, each with
its own result row, also without id; very long texts are aligned whole; columns that are not named
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.layout import table
from shopfloor.llm.tokens import Encoder, default_tokenizer, lots, token_bytes
from shopfloor.scratch import materialize

SEGMENT = 4096
FAN = 64
PART_PAIRS = 4_000_000
# A task hands its distinct pairs on when it holds so many.
HELD_PAIRS = 2_000_000
# Bits of a level for each key that is still without a slot.
SPARE = 2
_WORD = 64
_SEGMENT_SEED = 0
# Rows of one task are numbered in these bits.
TASK_BITS = 40


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# --- encoding ------------------------------------------------------------------------


@cache
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def piece_bytes(path: str) -> list[bytes]:
    """Per id of a piece model its bytes: a byte piece's own, else UTF-8 with spaces for U+2581."""
    model = _pieces(path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [
        bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        for i, name in enumerate(names)
    ]


def _code(*vocabularies: list) -> str:
    """The narrowest array code that holds every id."""
    return "H" if max(map(len, vocabularies)) <= 1 << 16 else "I"


def encoded(
    documents: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row a number of its own, its id, and the packed ids of both tokenizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, pieces = Encoder(first), _pieces(second)
        a_bytes, b_bytes = token_bytes(first), piece_bytes(second)
        code = _code(a_bytes, b_bytes)
        number = TaskContext.get().partitionId() << TASK_BITS
        for batch in batches:
            for begin, lot in lots(batch.column(1)):
                spaced = [" " + t if t else "" for t in lot]
                a_ids = encoder.ids(spaced, code)
                b_ids = pieces.encode(lot, num_threads=1)
                a_out, b_out = [], []
                for whole, a, b in zip(spaced, a_ids, b_ids, strict=True):
                    raw = whole.encode()
                    same = (
                        b"".join(map(b_bytes.__getitem__, b)) == raw
                        and b"".join(map(a_bytes.__getitem__, memoryview(a).cast(code))) == raw
                    )
                    a_out.append(a if same else b"")
                    b_out.append(array(code, b).tobytes() if same else b"")
                yield pa.record_batch(
                    [
                        pa.array(np.arange(number, number + len(lot))),
                        batch.column(0).slice(begin, len(lot)),
                        pa.array(a_out, pa.binary()),
                        pa.array(b_out, pa.binary()),
                    ],
                    ["row", key, "a", "b"],
                )
                number += len(lot)

    given = documents.select(F.col(key).cast("long").alias(key), F.col(text).cast("string"))
    return given.mapInArrow(run, f"row long, `{key}` long, a binary, b binary")


# --- alignment -----------------------------------------------------------------------


class Aligned:
    """The tokens of several texts laid end to end, cut into groups."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], a_size: np.ndarray, b_size: np.ndarray):
        self.n_a, self.n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a, b))
        self.a, self.b = (np.concatenate([np.empty(0, int), *ids]).astype(np.int64) for ids in (a, b))
        a_end, b_end = np.cumsum(a_size[self.a]), np.cumsum(b_size[self.b])
        total = int(a_end[-1]) if len(a_end) else 0
        ends = np.zeros((2, total + 1), dtype=bool)
        ends[0, a_end] = ends[1, b_end] = True
        both = ends[0] & ends[1]
        # Tokens that close a group; the two of one group are linked.
        self.a_last, self.b_last = both[a_end], both[b_end]
        self.pair = self.a[self.a_last] << 32 | self.b[self.b_last]
        owner = np.repeat(np.arange(len(a)), self.n_a)
        self.owner = owner[self.a_last]
        self.n_links = np.bincount(self.owner, minlength=len(a))

    def groups(self, a_text: np.ndarray, b_text: np.ndarray) -> list[bytes]:
        """Per text ``a1,a2|b1;a3|b2``; ``*_text`` hold an id's text and comma, and its text and end."""
        a_group = np.cumsum(self.a_last) - self.a_last
        b_group = np.cumsum(self.b_last) - self.b_last
        a_count, b_count = np.bincount(a_group), np.bincount(b_group)
        # A token comes after all of earlier groups and, on the second side, after the first.
        a_place = np.arange(len(self.a)) + (np.cumsum(b_count) - b_count)[a_group]
        b_place = np.arange(len(self.b)) + np.cumsum(a_count)[b_group]
        out = np.empty(len(self.a) + len(self.b), dtype=object)
        out[a_place] = a_text[self.a_last.astype(int), self.a]
        out[b_place] = b_text[self.b_last.astype(int), self.b]
        every = out.tolist()
        stops = np.cumsum(self.n_a + self.n_b).tolist()
        starts = [0, *stops[:-1]]
        return [b"".join(every[x:y])[:-1] for x, y in zip(starts, stops, strict=True)]


class Aligner:
    """Aligns rows of packed ids; made once in each task."""

    def __init__(self, first: str, second: str):
        a_bytes, b_bytes = token_bytes(first), piece_bytes(second)
        self.kind = "<u2" if _code(a_bytes, b_bytes) == "H" else "<u4"
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (a_bytes, b_bytes))

    def aligned(self, a: pa.Array, b: pa.Array) -> Aligned:
        a_ids, b_ids = (
            [np.frombuffer(x.as_buffer(), dtype=self.kind) for x in ids] for ids in (a, b)
        )
        return Aligned(a_ids, b_ids, self.a_size, self.b_size)


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for begin in range(0, batch.num_rows, rows):
        yield batch.slice(begin, rows)


def _totals(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and the sum of their counts."""
    keys, place = np.unique(np.concatenate(pairs), return_inverse=True)
    return keys, np.bincount(place, np.concatenate(counts), len(keys)).astype(np.int64)


def task_pairs(tokens: DataFrame, first: str, second: str) -> DataFrame:
    """The distinct pairs of each task and how often it links them: ``task``, ``pair``, ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task = Aligner(first, second), TaskContext.get().partitionId()
        pairs, counts, held = [], [], 0

        def out() -> pa.RecordBatch:
            keys, n = pairs.pop(), counts.pop()
            tasks = pa.array(np.full(len(keys), task, dtype=np.int64))
            return pa.record_batch([tasks, pa.array(keys), pa.array(n)], ["task", "pair", "n"])

        for batch in batches:
            for part in _slices(batch):
                found = aligner.aligned(part.column(0), part.column(1))
                keys, n = np.unique(found.pair, return_counts=True)
                pairs.append(keys)
                counts.append(n)
                held += len(keys)
                if held > 2 * HELD_PAIRS:
                    keys, n = _totals(pairs, counts)
                    pairs[:], counts[:], held = [keys], [n], len(keys)
                    if held > HELD_PAIRS:
                        yield out()
                        held = 0
        if pairs:
            keys, n = _totals(pairs, counts)
            pairs[:], counts[:] = [keys], [n]
            yield out()

    return tokens.select("a", "b").mapInArrow(run, "task long, pair long, n long")


# --- minimal perfect hash ------------------------------------------------------------


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well-spread 64-bit numbers, different for different keys, by one of many seeds."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(seed + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (mixed(keys, _SEGMENT_SEED) % np.uint64(segments)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[list[int], bytes]:
    """Sizes in bits and the bits of the levels of a hash of distinct ``keys``."""
    sizes, bits = [], []
    while len(keys):
        size = -(-SPARE * len(keys) // _WORD) * _WORD
        place = (mixed(keys, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone, bitorder="little").tobytes())
        keys = keys[~alone[place]]
    return sizes, b"".join(bits)


class PerfectHash:
    """Slots of the keys of consecutive segments, numbered through."""

    def __init__(self, segments: int, first: int, sizes: list[list[int]], bits: list[bytes]):
        self.segments, self.first = segments, first
        levels = max(map(len, sizes), default=0)
        self.size = np.zeros((len(sizes), levels), dtype=np.int64)
        for k, own in enumerate(sizes):
            self.size[k, : len(own)] = own
        flat = self.size.ravel()
        self.begin = (np.cumsum(flat) - flat).reshape(self.size.shape)
        self.words = np.frombuffer(b"".join(bits), dtype="<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Per key its slot, if it is a key of these segments; for others -1 or any slot."""
        found = np.full(len(keys), -1, dtype=np.int64)
        segment = segment_of(keys, self.segments) - self.first
        left = np.flatnonzero((segment >= 0) & (segment < len(self.size)))
        for level in range(self.size.shape[1]):
            size = self.size[segment[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            place = (mixed(keys[left], level + 1) % size.astype(np.uint64)).astype(np.int64)
            place += self.begin[segment[left], level]
            word, bit = place // _WORD, (place % _WORD).astype(np.uint64)
            here = self.words[word]
            hit = (here >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(here & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[hit]] = (self.before[word] + below)[hit]
            left = left[~hit]
        return found


def _with_segment(df: DataFrame, segments: int) -> DataFrame:
    """``df`` with the segment of each ``pair``."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment = segment_of(batch.column("pair").to_numpy(), segments)
            yield pa.record_batch([*batch.columns, pa.array(segment)], [*names, "segment"])

    return df.mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "segment"]))


def perfect_hash(pairs: DataFrame, segments: int) -> DataFrame:
    """Per segment the ``sizes`` and ``bits`` of its hash, and its ``keys`` by slot."""

    def build(group: pa.Table) -> pa.Table:
        segment = group.column("segment")[0].as_py()
        keys = np.sort(group.column("pair").to_numpy())
        sizes, bits = build_hash(keys)
        by_slot = np.empty_like(keys)
        by_slot[PerfectHash(segments, segment, [sizes], [bits]).slots(keys)] = keys
        return pa.table(
            {
                "segment": pa.array([segment], pa.int64()),
                "sizes": pa.array([sizes], pa.list_(pa.int32())),
                "bits": pa.array([bits], pa.binary()),
                "keys": pa.array([by_slot.tobytes()], pa.binary()),
            }
        )

    schema = "segment long, sizes array<int>, bits binary, keys binary"
    return _with_segment(pairs, segments).groupBy("segment").applyInArrow(build, schema)


# --- counts --------------------------------------------------------------------------

_COUNTS = "segment long, fold long, counts binary"


def _vector(segment: int, fold: int, counts: np.ndarray) -> pa.Table:
    return pa.table(
        {
            "segment": pa.array([segment], pa.int64()),
            "fold": pa.array([fold], pa.int64()),
            "counts": pa.array([counts.astype("<i8").tobytes()], pa.binary()),
        }
    )


def dense_counts(partial: DataFrame, hashes: DataFrame, segments: int, tasks: int, fan: int = FAN) -> DataFrame:
    """Per segment the ``counts`` of its pairs by slot, summed as a tree over ``tasks``."""

    def add(rows: pa.Table, own: pa.Table) -> pa.Table:
        if not rows.num_rows or not own.num_rows:
            return _vector(0, 0, np.empty(0)).slice(0, 0)
        segment, fold = rows.column("segment")[0].as_py(), rows.column("fold")[0].as_py()
        keys = np.frombuffer(own.column("keys")[0].as_buffer(), dtype="<i8")
        table = PerfectHash(
            segments, segment, own.column("sizes").to_pylist(), own.column("bits").to_pylist()
        )
        pair = rows.column("pair").to_numpy()
        slot = table.slots(pair)
        if not np.array_equal(keys[slot], pair):
            raise ValueError("a pair is not in the hash")
        counts = np.zeros(len(keys), dtype=np.int64)
        np.add.at(counts, slot, rows.column("n").to_numpy())
        return _vector(segment, fold, counts)

    def total(key: tuple, vectors: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x.as_buffer(), dtype="<i8") for x in vectors.column("counts"))
        return _vector(key[0].as_py(), key[1].as_py(), counts)

    folds = -(-max(tasks, 1) // fan)
    dealt = _with_segment(partial, segments).withColumn("fold", F.expr(f"task div {fan}"))
    each = hashes.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)).cast("array<long>")))
    by = ["segment", "fold"]
    vectors = dealt.groupBy(*by).cogroup(each.groupBy(*by)).applyInArrow(add, _COUNTS)
    while folds > 1:
        folds = -(-folds // fan)
        vectors = (
            vectors.withColumn("fold", F.expr(f"fold div {fan}"))
            .groupBy(*by)
            .applyInArrow(total, _COUNTS)
        )
    return vectors.select("segment", "counts")


class Counts:
    """Look-up of the counts of the pairs of some consecutive segments, given in their order."""

    def __init__(self, segments: int, first: int, model: pa.Table):
        held = [x - first for x in model.column("segment").to_pylist()]
        sizes: list[list[int]] = [[] for _ in range(max(held, default=-1) + 1)]
        for k, own in zip(held, model.column("sizes").to_pylist(), strict=True):
            sizes[k] = own
        self.hash = PerfectHash(segments, first, sizes, model.column("bits").to_pylist())
        self.keys, self.counts = (
            np.frombuffer(b"".join(model.column(c).to_pylist()), dtype="<i8")
            for c in ("keys", "counts")
        )

    def of(self, pairs: np.ndarray) -> np.ndarray:
        """The count of each pair; 0 for pairs that are not among the keys."""
        slot = self.hash.slots(pairs)
        known = slot >= 0
        known[known] = self.keys[slot[known]] == pairs[known]
        out = np.zeros(len(pairs), dtype=np.int64)
        out[known] = self.counts[slot[known]]
        return out


def best_counts(model: DataFrame, entries: int) -> np.ndarray:
    """The highest count of a pair per id of the second tokenizer, ``entries`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(entries, dtype=np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1), strict=True):
                second = np.frombuffer(keys.as_buffer(), dtype="<i8") & 0xFFFFFFFF
                np.maximum.at(best, second, np.frombuffer(counts.as_buffer(), dtype="<i8"))
        own = np.flatnonzero(best)
        yield pa.record_batch([pa.array(own), pa.array(best[own])], ["id", "n"])

    found = (
        model.select("keys", "counts")
        .mapInArrow(run, "id long, n long")
        .groupBy("id")
        .agg(F.max("n").alias("n"))
        .toArrow()
    )
    best = np.zeros(entries, dtype=np.int64)
    best[found["id"].to_numpy()] = found["n"].to_numpy()
    return best


# --- the job -------------------------------------------------------------------------


def _texts_of(entries: int, end: bytes) -> np.ndarray:
    """Each id's decimal text with a comma, and with ``end``."""
    out = np.empty((2, entries), dtype=object)
    out[0] = [b"%d," % i for i in range(entries)]
    out[1] = [b"%d%s" % (i, end) for i in range(entries)]
    return out


def _look_up(tokens: DataFrame, first: str, second: str, part, best, key: str, leading: bool) -> DataFrame:
    """The second pass: per row its figures by one part of the counts; the texts if ``leading``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(first, second)
        a_text = _texts_of(len(aligner.a_size), b"|") if leading else None
        b_text = _texts_of(len(aligner.b_size), b";") if leading else None
        counts, highest = part.value, best.value
        for batch in batches:
            for rows in _slices(batch):
                found = aligner.aligned(rows.column("a"), rows.column("b"))
                n = counts.of(found.pair)
                top = (n > 0) & (n == highest[found.pair & 0xFFFFFFFF])
                texts = found.groups(a_text, b_text) if leading else [None] * rows.num_rows
                size = rows.num_rows
                yield pa.record_batch(
                    [
                        rows.column("row"),
                        rows.column(key),
                        pa.array(found.n_a),
                        pa.array(found.n_b),
                        pa.array(found.n_links),
                        pa.array(np.bincount(found.owner[top], minlength=size)),
                        pa.array(np.bincount(found.owner, n, size).astype(np.int64)),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    ["row", key, "n_a", "n_b", "n_links", "n_best", "count_sum", "groups"],
                )

    return tokens.mapInArrow(
        run,
        f"row long, `{key}` long, n_a long, n_b long, n_links long, n_best long, count_sum long, groups string",
    )


def pair_counts(tokens: DataFrame, first: str, second: str) -> tuple[DataFrame, int, int]:
    """The model of the corpus: per segment its hash, keys and counts; segments; distinct pairs."""
    partial = materialize(task_pairs(tokens, first, second), "task-pairs")
    pairs = materialize(partial.select("pair").distinct(), "pairs")
    distinct = pairs.count()
    segments = max(1, -(-distinct // SEGMENT))
    tasks = (partial.agg(F.max("task")).first()[0] or 0) + 1
    hashes = materialize(perfect_hash(pairs, segments), "pair-hash")
    counts = dense_counts(partial, hashes, segments, tasks)
    return materialize(hashes.join(counts, "segment"), "pair-counts"), segments, distinct


def aligned_documents(
    documents: DataFrame,
    first: str | None = None,
    second: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    part_pairs: int = PART_PAIRS,
) -> DataFrame:
    """Per row its id, tokens, links, best links, sum of counts, and its ``groups`` as text."""
    first, second = first or default_tokenizer(), second or default_pieces()
    context = documents.sparkSession.sparkContext
    tokens = materialize(encoded(documents, first, second, key, text), "tokens")
    model, segments, _ = pair_counts(tokens, first, second)
    best = context.broadcast(best_counts(model, len(piece_bytes(second))))
    step = max(1, part_pairs // SEGMENT)
    parts = []
    for begin in range(0, segments, step):
        # At most ``part_pairs`` pairs, give or take the spread of the segments' sizes.
        own = model.where(F.col("segment").between(begin, begin + step - 1)).orderBy("segment")
        part = context.broadcast(Counts(segments, begin, own.toArrow()))
        parts.append(_look_up(tokens, first, second, part, best, key, begin == 0))
    if len(parts) == 1:
        return parts[0].drop("row")
    every = parts[0]
    for other in parts[1:]:
        every = every.union(other)
    return (
        every.groupBy("row")
        .agg(
            *(F.max(c).alias(c) for c in (key, "n_a", "n_b", "n_links")),
            *(F.sum(c).alias(c) for c in ("n_best", "count_sum")),
            F.max("groups").alias("groups"),
        )
        .drop("row")
    )


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a byte-level tokenizer against a piece model."""
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return aligned_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_a",
        "n_b",
        F.col("n_links").alias("n_groups"),
        "n_links",
        "n_best",
        "count_sum",
        digest.alias("groups_sha256"),
    )
