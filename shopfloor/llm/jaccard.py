"""Exact n-gram Jaccard join with token-combination prefixes.

Tokens are the distinct word shingles of a text. All sets order their tokens alike: rare
ones first, by a table that counts the tokens of all sets in a fixed number of buckets, then
frequent ones by how often they occur. So a passage that many texts share stays out of their
prefixes. Two sets of which the
similarity reaches the threshold share a token among the first ``p`` of either, and ``g + 1``
tokens among the first ``p + g``. So

* a rare token in the prefix is a key by itself, and
* if their first common token is a frequent one, all ``g + 1`` tokens they share in the
  extended prefix are frequent. With the frequent tokens dealt into ``g`` classes by hash,
  two of them fall into one class: the keys are the pairs of tokens within a class. ``g``
  grows with the set, so a set has a few pairs for each token of its prefix, not their square.

The smaller set of a pair needs a shorter prefix (its keys carry an index mark), and ``g`` is
that of the larger one, under which smaller sets that could match are indexed too.

Texts with the same set are one class; only classes are joined. Near copies share most keys,
so a group of them would be candidates of each other. Instead hubs of the keys gather loose
groups, by what bitmaps of the sets allow. Pairs of different groups that share a key (index
mark against any, sizes compatible) and whose bitmaps allow a link are verified one by one. Members of a group are compared with its root, and
with each other by what they differ from the root in: two members are linked only if both are
linked to the root or their differences share enough tokens, which is a prefix join over the
differences (:func:`_group_pairs`). Pairs inside a component need no verification, as the
result is the component. No link between components can be missed, and nothing is capped.

Which tokens are frequent only steers the cost. It is counted over all texts: runs of sets
report tokens they hold several times, and tokens whose reported sum reaches a share of the
texts are frequent. As each text holds a bounded number of shingles on average, at most
(mean set size / share) tokens are, whatever the number of texts; this list is broadcast.

Edge cases: null or blank texts have the empty set, which links with nothing; texts with fewer
words than a shingle have one token, the whole sequence; repeated rows and equal texts share
their class; null ids never become a component's name unless it has no other; columns that
are not named are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm import shingles
from shopfloor.llm.components import components
from shopfloor.llm.layout import table, with_rank
from shopfloor.scratch import materialize

FREQUENT_SHARE = 0.001
# Runs of sets of about so many tokens report those they hold at least so often.
RUN_TOKENS = 1_500_000
RUN_LEAST = 4
STAR_ROUNDS = 1
# Loose groups hold sets whose bitmaps allow a similarity less than links by so many points.
LOOSER = 15
# Keys of frequent tokens pass the first shuffle in so many parts.
SALTS = 64
# The filter that spares texts without partner a shuffle has 2**23 bits: 1 MB, whatever the
# input. Where it fills up it lets more texts pass, and the join after it still decides.
FILTER_BITS = 23
# Tokens are counted in so many buckets, whatever the input: two megabytes once they are levels.
COUNTERS = 1 << 21
# Counters are handed on in blocks of so many.
COUNTER_BLOCK = 1 << 15
PROBE, INDEX = 1, 2


def _fresh(seen: set, c1: np.ndarray, c2: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of non-empty sets that the current run has not had."""
    out = np.zeros(len(c1), dtype=bool)
    for i, key in enumerate(zip(c1.tolist(), c2.tolist(), strict=True)):
        if sizes[i] and key not in seen:
            seen.add(key)
            out[i] = True
    return out


def _counter_rows(counters: np.ndarray, names: Sequence[str]) -> pa.RecordBatch:
    """A row for each block of counters that is not all zero: its number as ``token``, and itself."""
    blocks = counters.reshape(-1, COUNTER_BLOCK)
    own = np.flatnonzero(blocks.any(axis=1))
    packed = [zlib.compress(np.minimum(blocks[k], 65535).astype("<u2").tobytes(), 1) for k in own]
    none, short = pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.int32())
    columns = [none, none, short, none, pa.array(packed, pa.binary()), pa.array(own), none]
    return pa.record_batch(columns, names)


def _token_levels(scanned: DataFrame) -> np.ndarray:
    """Per bucket how many tokens of all sets fell into it, in steps of a quarter of a doubling.

    Counters are summed by the tasks that read them, then by block, so that no group holds more
    than one block of each reading task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(zlib.decompress(packed), dtype="<u2").astype(np.int64)
                total[block] = total[block] + own if block in total else own
        held = [zlib.compress(total[b].tobytes(), 1) for b in total]
        yield pa.record_batch([pa.array(list(total), pa.int64()), pa.array(held, pa.binary())], ["block", "counts"])

    def level(key: tuple, parts: pa.Table) -> pa.Table:
        packed = parts.column("counts").to_pylist()
        counts = sum(np.frombuffer(zlib.decompress(x), dtype="<i8") for x in packed)
        levels = np.floor(4 * np.log2(counts + 1.0)).astype(np.uint8).tobytes()
        return pa.table({"block": [key[0].as_py()], "levels": pa.array([levels], pa.binary())})

    blocks = scanned.where("token is not null and count is null").select("token", "bits")
    found = (
        blocks.mapInArrow(read, "block long, counts binary")
        .groupBy("block")
        .applyInArrow(level, "block long, levels binary")
        .toArrow()
    )
    out = np.zeros((COUNTERS // COUNTER_BLOCK, COUNTER_BLOCK), dtype=np.uint8)
    for block, levels in zip(*(found.column(c).to_pylist() for c in found.column_names), strict=True):
        out[block] = np.frombuffer(levels, dtype=np.uint8)
    return out.ravel()


def _scan_sets(words: int):
    """(id, text) to one row per text, one per token that a run holds several times, and the
    task's counters of tokens."""
    names = ["id", "c1", "c2", "n", "bits", "token", "count"]

    def report(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= RUN_LEAST
        tokens, counts = tokens[often].view(np.int64), counts[often]
        none = pa.nulls(len(tokens), pa.int64())
        short, blank = pa.nulls(len(tokens), pa.int32()), pa.nulls(len(tokens), pa.binary())
        return pa.record_batch(
            [none, none, short, none, blank, pa.array(tokens), pa.array(counts)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set = set()
        size = 0
        counters = np.zeros(COUNTERS, dtype=np.int32)
        for batch in batches:
            for first, sets in shingles.slabs(batch.column(1), words):
                c1, c2 = shingles.signatures(sets)
                sizes = sets.sizes()
                rows = len(sizes)
                none = pa.nulls(rows, pa.int64())
                bits = pa.array(shingles.bitmaps(sets), pa.binary())
                own = [batch.column(0).slice(first, rows), *map(pa.array, (c1, c2, sizes))]
                yield pa.record_batch([*own, bits, none, none], names)
                fresh = _fresh(seen, c1, c2, sizes)
                held.append(sets.hashes[np.repeat(fresh, sizes)])
                np.add.at(counters, _bucket(held[-1]), 1)
                size += len(held[-1])
                if size >= RUN_TOKENS:
                    yield report(held)
                    held, size = [], 0
                    seen.clear()
        if size:
            yield report(held)
        yield _counter_rows(counters, names)

    return run


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(COUNTERS - 1)).astype(np.int64)


def _least_overlap(percent: int, n: int) -> int:
    return -(-percent * n // 100)


def _classes(percent: int, n: int) -> int:
    """The number of classes for frequent tokens of a set of ``n``: a power of two, or 0."""
    prefix = n - _least_overlap(percent, n) + 1
    most = min(max(prefix // 2, 1), _least_overlap(percent, n) - 1)
    return 1 << (most.bit_length() - 1) if most > 0 else 0


def _pairs(tokens: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pairs within a class, and the place of the later token of each."""
    dealt = tokens >> np.uint64(40) & np.uint64(classes - 1)
    order = np.argsort(dealt, kind="stable")
    token, group = tokens[order], dealt[order]
    keys, places = [], []
    step = 1
    while step < len(token):
        same = np.flatnonzero(group[step:] == group[:-step])
        if not len(same):
            break
        one, two = token[same], token[same + step]
        low, high = np.minimum(one, two), np.maximum(one, two)
        salt = shingles.mix(np.array([classes], dtype=np.uint64))
        keys.append(shingles.mix(shingles.mix(low + salt) * shingles.MULTIPLIER + high))
        places.append(np.maximum(order[same], order[same + step]))
        step += 1
    if not keys:
        return tokens[:0], np.empty(0, dtype=np.int64)
    return np.concatenate(keys), np.concatenate(places)


def _frequent_keys(
    tokens: np.ndarray, rare: int, n: int, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, marks) from the ordered frequent ``tokens`` of a set with ``rare`` other ones."""
    probe_prefix = n - _least_overlap(percent, n) + 1
    index_prefix = n - -(-2 * percent * n // (100 + percent)) + 1
    own = _classes(percent, n)
    largest = 100 * n // percent
    wanted = {own}
    size = n
    while size <= largest:
        wanted.add(_classes(percent, size))
        size = size + 1 if size < 64 else size + size // 64
    wanted.add(_classes(percent, largest))
    for classes in sorted(wanted - {0}):
        # The first common token lies in the plain prefix.
        prefix = probe_prefix if classes == own else index_prefix
        if rare >= prefix:
            continue
        keys, places = _pairs(tokens[: prefix + classes - rare], classes)
        indexed = (places < index_prefix + classes - rare) & (rare < index_prefix)
        marks = np.where(indexed, INDEX, 0)
        if classes == own:
            marks = marks | PROBE
        yield keys, marks


def _scan_keys(words: int, percent: int, frequent):
    """(text) to the keys of its prefix: (frequent, key, c1, c2, n, mark)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank, levels = frequent.value
        for batch in batches:
            seen: set = set()
            for _, sets in shingles.slabs(batch.column(0), words):
                c1, c2 = shingles.signatures(sets)
                sizes = sets.sizes()
                fresh = _fresh(seen, c1, c2, sizes)
                if not fresh.any():
                    continue
                hashes, owner = sets.hashes, np.repeat(np.arange(len(sizes)), sizes)
                if len(known):
                    spot = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    often = known[spot] == hashes
                else:
                    spot, often = None, np.zeros(len(hashes), dtype=bool)
                rares = np.bincount(owner[~often], minlength=len(sizes))
                # Rare tokens first, by level and then by hash, in which they are sorted already.
                order = owner.astype(np.uint64) << np.uint64(9) | often.astype(np.uint64) << np.uint64(8)
                order = np.argsort(order | levels[_bucket(hashes)], kind="stable")
                place = np.empty(len(hashes), dtype=np.int64)
                place[order] = np.arange(len(hashes)) - np.repeat(sets.ends - sizes, sizes)
                probe = sizes - -(-percent * sizes // 100) + 1
                index = sizes - -(-2 * percent * sizes // (100 + percent)) + 1
                single = ~often & (place < probe[owner]) & fresh[owner]
                own = owner[single]
                keys = [hashes[single]]
                marks = [np.where(place[single] < index[own], PROBE | INDEX, PROBE)]
                owners = [own]
                needs = np.flatnonzero(fresh & (rares < sizes) & (rares < probe))
                begin = sets.ends - sizes
                for i in needs.tolist():
                    mine = slice(begin[i], sets.ends[i])
                    tokens = hashes[mine][often[mine]]
                    tokens = tokens[np.argsort(rank[spot[mine][often[mine]]])]
                    for key, mark in _frequent_keys(tokens, int(rares[i]), int(sizes[i]), percent):
                        keys.append(key)
                        marks.append(mark)
                        owners.append(np.full(len(key), i))
                key, mark, own = map(np.concatenate, (keys, marks, owners))
                hot = np.arange(len(key)) >= len(keys[0])
                kept = mark > 0
                own = own[kept]
                yield pa.record_batch(
                    [
                        pa.array(hot[kept]),
                        pa.array(key[kept].view(np.int64)),
                        pa.array(c1[own]),
                        pa.array(c2[own]),
                        pa.array(sizes[own].astype(np.int32)),
                        pa.array(mark[kept].astype(np.int8)),
                    ],
                    ["hot", "key", "c1", "c2", "n", "mark"],
                )

    return run


def _scan_texts(words: int, wanted):
    """(text) to (c1, c2, text) of wanted sets, each once in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            seen: set = set()
            for first, sets in shingles.slabs(batch.column(0), words):
                c1, c2 = shingles.signatures(sets)
                spot = c1 & np.int64((1 << FILTER_BITS) - 1)
                hit = (bits[spot >> np.int64(6)] >> (spot & np.int64(63)) & np.int64(1)).astype(bool)
                fresh = np.flatnonzero(hit & _fresh(seen, c1, c2, sets.sizes()))
                text = batch.column(0).take(pa.array(fresh + first))
                yield pa.record_batch(
                    [pa.array(c1[fresh]), pa.array(c2[fresh]), text], ["c1", "c2", "text"]
                )

    return run


def _scan_tokens(words: int):
    """(node, text) to (node, tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingles.slabs(batch.column(1), words):
                ends = pa.array(np.concatenate([[0], sets.ends]).astype(np.int32))
                tokens = pa.ListArray.from_arrays(ends, pa.array(sets.hashes.view(np.int64)))
                node = batch.column(0).slice(first, len(sets.ends))
                yield pa.record_batch([node, tokens], ["node", "tokens"])

    return run


def _compatible(percent: int, one: str, two: str):
    low, high = F.least(one, two), F.greatest(one, two)
    return low * 100 >= high * percent


def _possible(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The (a, b) that could reach the similarity, judged by bitmaps of the sets."""

    def bound(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [shingles.most_common(*row) for row in zip(*batch, strict=True)], dtype="int64"
            )

    most = F.pandas_udf(bound, T.LongType())
    first = bits.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("bits").alias("b1"))
    second = bits.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("b2"))
    judged = pairs.join(first, "a").join(second, "b").withColumn("most", most("b1", "b2", "n1", "n2"))
    union = F.col("n1") + F.col("n2") - F.col("most")
    return judged.where(F.col("most") * 100 >= union * percent).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose sets reach the similarity."""
    first = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    second = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb")).cast("long")
    union = F.size("ta") + F.size("tb") - F.col("common")
    return (
        pairs.join(first, "a")
        .join(second, "b")
        .withColumn("common", common)
        .where(F.col("common") * 100 >= union * percent)
        .select("a", "b")
    )


def _most_apart(percent: int, sizes):
    """The largest symmetric difference of two linked sets, from the sum of their sizes."""
    return F.floor(sizes * (100 - percent) / (100 + percent) + 1e-9).cast("long")


def _differences(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Per member of a loose group: the tokens in which it and the group's root differ."""
    root = sets.select(F.col("node").alias("root"), F.col("tokens").alias("tr"))
    apart = F.concat(F.array_except("tokens", "tr"), F.array_except("tr", "tokens"))
    return (
        groups.withColumnRenamed("comp", "root")
        .join(sets, "node")
        .join(root, "root")
        .select(
            "root",
            "node",
            F.size("tokens").cast("long").alias("n"),
            F.size("tr").cast("long").alias("n_root"),
            apart.alias("apart"),
        )
    )


def _core_links(differences: DataFrame, percent: int) -> DataFrame:
    """Links of each group's most typical member, which deviates least from the majority.

    They join most of a group of near copies, so few pairs of its members are left to look at.
    """
    members = differences.groupBy("root").agg(F.count("*").alias("members"))
    tokens = differences.select("root", "node", F.explode("apart").alias("token"))
    seen = tokens.groupBy("root", "token").agg(F.count("*").alias("df")).join(members, "root")
    seen = seen.select("root", "token", (F.col("df") * 2 > F.col("members")).alias("usual"))
    usual = seen.where("usual").groupBy("root").agg(F.count("*").alias("all"))
    own = (
        tokens.join(seen, ["root", "token"])
        .groupBy("root", "node")
        .agg(F.sum(F.when(F.col("usual"), -1).otherwise(1)).alias("off"))
    )
    deviation = F.coalesce("off", F.lit(0)) + F.coalesce("all", F.lit(0))
    core = (
        differences.select("root", "node")
        .join(own, ["root", "node"], "left")
        .join(usual, "root", "left")
        .groupBy("root")
        .agg(F.min(F.struct(deviation.alias("off"), "node"))["node"].alias("core"))
    )
    typical = differences.join(core, "root").where("node = core").select(
        "root", "core", F.col("n").alias("n1"), F.col("apart").alias("one")
    )
    differ = F.size("one") + F.size("apart") - 2 * F.size(F.array_intersect("one", "apart"))
    return (
        differences.join(materialize(typical, "cores"), "root")
        .where(F.col("node") != F.col("core"))
        .where(differ <= _most_apart(percent, F.col("n") + F.col("n1")))
        .select(F.col("core").alias("a"), F.col("node").alias("b"))
    )


def _group_pairs(differences: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between components inside loose groups.

    With A = a member's difference to its root, two members differ in
    ``|A| + |A'| - 2 |A & A'|`` tokens. If that can be small enough without a common token,
    both are linked to the root; else the pair has to share tokens of A, which few do
    although they share most of their text: a prefix join over these.
    """
    held = _with_comp(differences, labels).withColumn("a", F.size("apart").cast("long"))
    # Groups that are one component need nothing more.
    mixed = held.groupBy("root").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    held = materialize(held.join(mixed.where("low <> high").select("root"), "root"), "apart")
    tokens = held.select("root", "node", "n", "comp", "a", F.explode("apart").alias("token"))
    seen = tokens.groupBy("root", "token").agg(F.count("*").alias("df"))
    shared = tokens.join(seen.where("df > 1"), ["root", "token"])
    # Tokens that only one member has come first in its order and cannot be shared.
    place = F.row_number().over(Window.partitionBy("node").orderBy("df", "token"))
    useful = F.count("*").over(Window.partitionBy("node"))
    ranked = shared.withColumn("useful", useful).withColumn(
        "place", F.col("a") - F.col("useful") + place
    )
    widest = _most_apart(percent, F.col("n") + F.floor(F.col("n") * 100 / percent))
    least_index = F.greatest(F.lit(1), F.ceil((2 * F.col("a") - widest) / 2))
    least_probe = F.greatest(F.lit(1), F.col("a") - widest)
    ranked = materialize(
        ranked.withColumn("indexed", F.col("place") <= F.col("a") - least_index + 1)
        .where(F.col("place") <= F.col("a") - F.least(least_probe, least_index) + 1)
        .select("root", "token", "node", "n", "comp", "a", "useful", "place", "indexed"),
        "apart-keys",
    )
    one, two = (
        ranked.select("root", "token", *[F.col(c).alias(f"{c}{k}") for c in ranked.columns[2:]])
        for k in (1, 2)
    )
    bound = F.col("a1") + F.col("a2") - _most_apart(percent, F.col("n1") + F.col("n2"))
    pairs = (
        one.where("indexed1")
        .join(two, ["root", "token"])
        .where(F.expr("comp1 <> comp2 and (a1 < a2 or (a1 = a2 and node1 < node2))"))
        .where(2 * F.least("useful1", "useful2") >= bound)
        # The first token that two members share leaves only what follows it in either to share.
        .where(2 * (1 + F.least(F.col("a1") - F.col("place1"), F.col("a2") - F.col("place2"))) >= bound)
        .where(_compatible(percent, "n1", "n2"))
        .select(F.col("node1").alias("a"), F.col("node2").alias("b"))
        .distinct()
    )
    first = held.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("apart").alias("one"))
    second = held.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("apart").alias("two"))
    differ = F.size("one") + F.size("two") - 2 * F.size(F.array_intersect("one", "two"))
    return (
        pairs.join(first, "a")
        .join(second, "b")
        .where(differ <= _most_apart(percent, F.col("n1") + F.col("n2")))
        .select("a", "b")
    )


def _with_comp(keys: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return keys.withColumn("comp", F.col("node"))
    return keys.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _star_pairs(keys: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each key's hub of this turn beside its members of other components."""
    band = F.floor(F.log("n") * float(1 / np.log(100 / percent))).cast("int")
    banded = keys.withColumn("band", band)
    order = F.xxhash64("node", F.lit(turn))
    hubs = banded.groupBy("key", "band").agg(
        F.min(F.struct(order.alias("o"), "node", "comp", "n")).alias("hub"),
        F.min("comp").alias("low"),
        F.max("comp").alias("high"),
    )
    hubs = hubs.where("low <> high").select("key", "band", "hub")
    return (
        banded.join(hubs, ["key", "band"])
        .where(F.col("comp") != F.col("hub.comp"))
        .where(_compatible(percent, "n", "hub.n"))
        .select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
        .distinct()
    )


def _rest_pairs(keys: DataFrame, percent: int) -> DataFrame:
    """All pairs between components that share a key, one with index mark, sizes compatible."""
    met = keys.groupBy("key", "comp").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("mark").alias("mark")
    )
    mixed = met.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    mixed = mixed.where("low <> high").select("key")
    met = met.join(mixed, "key")
    one = met.select("key", *[F.col(c).alias(f"{c}1") for c in ("comp", "least", "most")])
    two = met.select("key", *[F.col(c).alias(f"{c}2") for c in ("comp", "least", "most")])
    meet = one.join(two, "key").where(
        (F.col("comp1") < F.col("comp2"))
        & (F.col("most1") * 100 >= F.col("least2") * percent)
        & (F.col("most2") * 100 >= F.col("least1") * percent)
    )
    left = keys.select(
        "key", *[F.col(c).alias(f"{c}1") for c in ("comp", "node", "n", "mark")]
    )
    right = keys.select(
        "key", *[F.col(c).alias(f"{c}2") for c in ("comp", "node", "n", "mark")]
    )
    index1 = F.col("mark1").bitwiseAND(F.lit(INDEX)) > 0
    index2 = F.col("mark2").bitwiseAND(F.lit(INDEX)) > 0
    probe1 = F.col("mark1").bitwiseAND(F.lit(PROBE)) > 0
    probe2 = F.col("mark2").bitwiseAND(F.lit(PROBE)) > 0
    smaller_first = (F.col("n1") <= F.col("n2")) & index1 & probe2
    smaller_second = (F.col("n2") <= F.col("n1")) & index2 & probe1
    return (
        meet.select("key", "comp1", "comp2")
        .join(left, ["key", "comp1"])
        .join(right, ["key", "comp2"])
        .where(_compatible(percent, "n1", "n2") & (smaller_first | smaller_second))
        .select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b"))
        .distinct()
    )


def _shared_keys(texts: DataFrame, words: int, percent: int, frequent) -> DataFrame:
    """The keys that sets of compatible sizes have in common: (key, c1, c2, n, mark).

    Keys of rare tokens have few members, so a window finds those with a partner. Those of
    frequent ones may have any number: they pass that shuffle spread over salts, are then
    counted on the map side, and joined, which splits large keys.
    """
    schema = "hot boolean, key long, c1 long, c2 int, n int, mark byte"
    found = texts.mapInArrow(_scan_keys(words, percent, frequent), schema)
    indexed = F.col("mark").bitwiseAND(F.lit(INDEX)) > 0
    salt = F.when(F.col("hot"), F.pmod("c1", F.lit(SALTS))).otherwise(0)
    by_size = Window.partitionBy("key", "salt").orderBy("n", (~indexed), "c1", "c2")
    smaller = F.max(F.when(indexed, F.col("n"))).over(
        by_size.rowsBetween(Window.unboundedPreceding, -1)
    )
    candidates = materialize(
        found.withColumn("salt", salt)
        .withColumn("smaller", smaller)
        .withColumn("larger", F.lead("n").over(by_size))
        .where(
            F.col("hot")
            | (F.col("smaller") * 100 >= F.col("n") * percent)
            | (indexed & (F.col("larger") * percent <= F.col("n") * 100))
        )
        .select(*found.columns),
        "candidate-keys",
    )
    hot = candidates.where("hot")
    met = hot.groupBy("key").agg(F.min("c1").alias("low"), F.max("c1").alias("high"))
    often = hot.join(met.where("low <> high").select("key"), "key")
    return materialize(
        candidates.where("not hot")
        .unionByName(often)
        .groupBy("key", "c1", "c2", "n")
        .agg(F.bit_or("mark").alias("mark")),
        "shared-keys",
    )


def _filter_words(nodes: DataFrame) -> np.ndarray:
    """A bit per hash value of the nodes' ``c1``: a fixed number of bits, summed up by Spark."""
    spot = F.col("c1").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = nodes.groupBy(F.shiftright(spot, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(c1 & 63 as int))")).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def similarity_components(
    documents: DataFrame,
    words: int = 5,
    percent: int = 80,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row of ``documents``: its id, set signature (``c1``, ``c2``), ``n`` and ``component``.

    ``component`` is the least id that links of at least ``percent`` similarity reach.
    """
    spark = documents.sparkSession
    given = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    texts = given.select("text")
    scanned = materialize(
        given.mapInArrow(
            _scan_sets(words),
            "id long, c1 long, c2 int, n long, bits binary, token long, count long",
        ),
        "sets",
    )
    rows = scanned.where("n is not null").select("id", "c1", "c2", "n")
    classes = materialize(
        scanned.where("n > 0")
        .groupBy("c1", "c2")
        .agg(F.min("id").alias("least"), F.max("n").alias("n"), F.first("bits").alias("bits")),
        "classes",
    )
    total = rows.count()
    often = (
        scanned.where("count is not null")
        .groupBy("token")
        .agg(F.sum("count").alias("count"))
        .where(F.col("count") >= FREQUENT_SHARE * total)
        .toArrow()
    )
    token = often["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    known, count = token[order], often["count"].to_numpy()[order]
    rank = np.empty(len(known), dtype=np.int64)
    rank[np.lexsort((known, count))] = np.arange(len(known))
    frequent = spark.sparkContext.broadcast((known, rank, _token_levels(scanned)))

    shared = _shared_keys(texts, words, percent, frequent)
    nodes = materialize(
        with_rank(shared.select("c1", "c2").distinct(), ["c1", "c2"], "node", "nodes"), "nodes"
    )
    keys = materialize(
        shared.join(nodes, ["c1", "c2"]).select("key", "node", "n", "mark"), "node-keys"
    )
    bits = materialize(nodes.join(classes, ["c1", "c2"]).select("node", "n", "bits"), "bitmaps")
    # Hubs gather loose groups: sets that may be near their hub, linked or not.
    groups: DataFrame | None = None
    edges: DataFrame | None = None
    for turn in range(STAR_ROUNDS):
        pairs = _star_pairs(_with_comp(keys, groups), percent, turn)
        near = materialize(_possible(pairs, bits, percent - LOOSER), "near")
        edges = near if edges is None else edges.unionByName(near)
        groups = components(edges)
    # Pairs of different groups that may be links.
    pairs = _rest_pairs(_with_comp(keys, groups), percent)
    rest = materialize(_possible(pairs, bits, percent), "rest")

    needed = materialize(
        groups.select("node")
        .union(rest.select("a"))
        .union(rest.select("b"))
        .distinct()
        .join(nodes, "node"),
        "needed",
    )
    wanted = spark.sparkContext.broadcast(_filter_words(needed))
    signed = texts.mapInArrow(_scan_texts(words, wanted), "c1 long, c2 int, text string")
    first = Window.partitionBy("c1", "c2").orderBy("node")
    chosen = (
        signed.join(needed, ["c1", "c2"])
        .withColumn("copy", F.row_number().over(first))
        .where("copy = 1")
        .select("node", "text")
    )
    sets = materialize(
        chosen.mapInArrow(_scan_tokens(words), "node long, tokens array<long>"), "tokens"
    )
    # Pairs between groups are verified one by one; members of a group are compared with its
    # root, then with each other by what they differ from the root in.
    differences = materialize(_differences(groups, sets), "differences")
    apart = _most_apart(percent, F.col("n") + F.col("n_root"))
    rooted = differences.where((F.size("apart") <= apart) & (F.col("node") != F.col("root")))
    links = materialize(
        _linked(rest, sets, percent)
        .unionByName(rooted.select(F.col("root").alias("a"), F.col("node").alias("b")))
        .unionByName(_core_links(differences, percent)),
        "outer-links",
    )
    labels = components(links)
    inner = materialize(_group_pairs(differences, labels, percent), "inner-links")
    labels = components(links.unionByName(inner))

    linked = nodes.join(labels, "node")
    comps = linked.join(classes, ["c1", "c2"]).groupBy("comp").agg(F.min("least").alias("component"))
    named = materialize(linked.join(comps, "comp").select("c1", "c2", "component"), "named")
    known_names = materialize(
        classes.join(named, ["c1", "c2"], "left").select(
            "c1", "c2", F.coalesce("component", "least").alias("component")
        ),
        "class-names",
    )
    full = rows.where("n > 0").join(known_names, ["c1", "c2"])
    blank = rows.where("n = 0").withColumn("component", F.col("id"))
    return full.select("id", "c1", "c2", "n", "component").unionByName(
        blank.select("id", "c1", "c2", "n", "component")
    )


def one_of_each(
    documents: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The row with the least id of each group of linked texts; texts without words stay.

    Only texts of the one class that has that id travel, and of equal texts only the first
    leaves the task that read it.
    """
    columns = documents.columns
    found = materialize(
        similarity_components(documents, words, percent, key, text), "components"
    )
    # Per group the class that holds its least id, and that id; nulls last.
    classes = found.where("n > 0").groupBy("component", "c1", "c2").agg(F.min("id").alias("id"))
    first = Window.partitionBy("component").orderBy(F.col("id").asc_nulls_last(), "c1", "c2")
    chosen = materialize(
        classes.withColumn("place", F.row_number().over(first)).where("place = 1")
        # Groups of which no text has an id share the name null; each class of them stays.
        .unionByName(classes.where("component is null").withColumn("place", F.lit(1)))
        .select(F.col("c1").alias("k1"), F.col("c2").alias("k2"))
        .distinct(),
        "chosen",
    )
    signed = documents.select(F.struct(*columns).alias("row"), F.col(key).cast("long").alias("id"))
    schema = T.StructType(
        [
            T.StructField("row", signed.schema["row"].dataType),
            T.StructField("id", T.LongType()),
            T.StructField("c1", T.LongType()),
            T.StructField("c2", T.IntegerType()),
            T.StructField("n", T.LongType()),
        ]
    )
    rows = signed.mapInArrow(_sign(words, text), schema)
    # Rows without words are no copies of each other: each is a partition of its own.
    alone = F.when(F.col("n") == 0, F.monotonically_increasing_id())
    place = Window.partitionBy("c1", "c2", "alone").orderBy(F.col("id").asc_nulls_last())
    firsts = (
        rows.withColumn("alone", alone)
        .withColumn("place", F.row_number().over(place))
        .where("place = 1")
    )
    return (
        firsts.join(chosen, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")), "left")
        .where((F.col("n") == 0) | F.col("k1").isNotNull())
        .select("row.*")
    )


def _sign(words: int, text: str):
    """(row, id) to (row, id, c1, c2, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingles.slabs(pc.struct_field(batch.column(0), [text]), words):
                c1, c2 = shingles.signatures(sets)
                part = batch.slice(first, len(c1))
                yield pa.record_batch(
                    [*part.columns, *map(pa.array, (c1, c2, sets.sizes()))],
                    ["row", "id", "c1", "c2", "n"],
                )

    return run


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under a 4-word shingle similarity of 0.85."""
    found = similarity_components(table(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
    )
