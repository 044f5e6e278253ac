"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased; everything but letters becomes one space between words. Spark counts
the 4-grams of all learning rows per language, partly summed where they are read. All of them,
of all languages, make the model, so counts of counts, context totals and continuation counts
are those of the whole corpus. The driver fetches the counts in portions, works out the
interpolated Kneser-Ney probabilities and stores them sparsely: per language and order one
sorted array of packed grams and one of probabilities, and the same for contexts. Scoring is a
binary search per language and different gram of a slab; grams that a language does not have
fall back through its context weights to the next lower order, again by binary search.

The model takes some 12 bytes per different 4-gram of a language and as much per context, on the
driver and on each executor's Python workers. It grows with the different grams, not with the
rows; where it outgrows their memory, let ``learn`` take a sample of the labelled rows.

The language with the least cross-entropy per character wins. It is rejected if that
cross-entropy lies beyond the language's cutoff. Cutoffs are calibrated on one part in
``CALIBRATION`` of the learning rows, by hash of the text, which the models never see (a model
knows its own texts too well), where they are predicted as labelled: their median plus ``SLACK`` times the distance from there to their
99.9 % quantile, at least ``LEAST_BITS``, plus ``SHORT_BITS`` over the text's length, as a few
characters tell little. Cross-entropies are counted in hundredths of a bit, so the quantiles cover
all rows and merge by adding counts.

Edge cases: a null text, one without letters and any text where nothing could be learned is
"und", score 0, rejected. Null labels teach nothing. A null id is not held out. Repeated
rows count as often as they occur; ties go to the first language by name; texts of any length
are processed whole, in slabs. Only named columns are read, and kept columns sit in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm.layout import table
from shopfloor.scratch import materialize

ORDER = 4
# Counts are fetched in portions of about so many grams.
PORTION_GRAMS = 4_000_000
SLACK = 2.0
SHORT_BITS = 16.0
CALIBRATION = 8
LEAST_BITS = 1.5
UNKNOWN = "und"
# Texts are worked on in slabs of about so many characters.
SLAB_CHARS = 1 << 18
# Least weight of the uniform distribution below the lowest order.
UNIFORM_WEIGHT = 0.01
ALPHABET = 1 << 16


@cache
def _symbols() -> np.ndarray:
    """Code point to symbol: letters to themselves (16 bits), all else to a space.

    Letters beyond U+FFFF are folded into 16 bits; none becomes the space.
    """
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    code = np.arange(0x110000)
    folded = (code ^ (code >> 16 << 5)) & 0xFFFF
    # The exclamation mark is no letter, so its symbol is free.
    folded[folded == 0x20] = 0x21
    return np.where(letter, folded, 0x20).astype(np.uint16)


def grams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed 4-grams of texts, one after the other, and how many each text has.

    A text reads as spaces, its words and a space; it has none if it has no letter.
    """
    counts = np.zeros(len(texts), dtype=np.int64)
    parts = []
    for row, text in enumerate(texts):
        code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbol = _symbols()[code]
        space = symbol == 0x20
        symbol = symbol[~(space & np.concatenate([[True], space[:-1]]))]
        if not len(symbol):
            continue
        ends = [] if symbol[-1] == 0x20 else [0x20]
        padded = np.concatenate([[0x20] * (ORDER - 1), symbol, ends]).astype(np.uint64)
        n = len(padded) - ORDER + 1
        packed = padded[:n].copy()
        for k in range(1, ORDER):
            packed = packed << np.uint64(16) | padded[k : k + n]
        counts[row] = n
        parts.append(packed)
    return (np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)), counts


def _slabs(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    held: list[str] = []
    first, size = 0, 0
    for row, scalar in enumerate(texts):
        text = scalar.as_py()
        if held and size + len(text or "") > SLAB_CHARS:
            yield first, held
            held, first, size = [], row, 0
        held.append(text or "")
        size += len(held[-1])
    if held:
        yield first, held


# --- learning ------------------------------------------------------------------------


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, gram, n), summed over slabs."""
    for batch in batches:
        langs = np.asarray(batch.column(0).to_pylist(), dtype=object)
        for first, texts in _slabs(batch.column(1)):
            own = langs[first : first + len(texts)]
            for lang in sorted(set(own)):
                packed, _ = grams([t for t, x in zip(texts, own, strict=True) if x == lang])
                gram, n = np.unique(packed, return_counts=True)
                yield pa.record_batch(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)],
                    ["lang", "gram", "n"],
                )


@dataclass
class Level:
    """One order's grams with their probabilities, and its contexts with their weights."""

    grams: np.ndarray
    probability: np.ndarray
    contexts: np.ndarray
    weight: np.ndarray


@dataclass
class Model:
    """Per language its levels, from the lowest order up."""

    languages: list[str]
    levels: list[list[Level]]

    def column(self, language: int, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Per gram the interpolated probability of its last symbol in one language."""
        return _probability(self.levels[language], packed, order)

    def probability(self, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Per gram and language the interpolated probability of its last symbol."""
        out = np.empty((len(packed), len(self.languages)), dtype=np.float32)
        for language in range(len(self.languages)):
            out[:, language] = self.column(language, packed, order)
        return out


def _probability(levels: Sequence[Level], packed: np.ndarray, order: int) -> np.ndarray:
    if not order:
        return np.full(len(packed), 1 / ALPHABET, dtype=np.float32)
    level = levels[order - 1]
    out = np.empty(len(packed), dtype=np.float32)
    spot, known = _find(level.grams, packed)
    out[known] = level.probability[spot[known]]
    other = np.flatnonzero(~known)
    if len(other):
        missing = packed[other]
        lower = _probability(levels, missing & _low(order - 1), order - 1)
        spot, known = _find(level.contexts, missing >> np.uint64(16))
        lower[known] *= level.weight[spot[known]]
        out[other] = lower
    return out


def _low(order: int) -> np.uint64:
    return np.uint64((1 << (16 * order)) - 1)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    spot = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return spot, keys[spot] == wanted


def _levels(gram: np.ndarray, n: np.ndarray) -> list[Level]:
    """One language's levels from its sorted 4-grams and their counts."""
    # From the highest order down: grams with counts, below the highest the number of
    # different symbols seen before them.
    orders = [(gram, n)]
    for order in range(ORDER - 1, 0, -1):
        orders.append(np.unique(orders[-1][0] & _low(order), return_counts=True))
    levels: list[Level] = []
    for order, (keys, n) in zip(range(1, ORDER + 1), reversed(orders), strict=True):
        once, twice = int((n == 1).sum()), int((n == 2).sum())
        discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
        contexts, own = np.unique(keys >> np.uint64(16), return_inverse=True)
        total = np.bincount(own, weights=n)
        weight = (discount * np.bincount(own) / total).astype(np.float32)
        if order == 1:
            weight = np.maximum(weight, np.float32(UNIFORM_WEIGHT))
        probability = ((n - discount) / total[own]).astype(np.float32)
        probability += weight[own] * _probability(levels, keys & _low(order - 1), order - 1)
        levels.append(Level(keys, probability, contexts, weight))
    return levels


def kneser_ney(languages: Sequence[str], counted: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model from each language's sorted 4-grams and their counts."""
    return Model(list(languages), [_levels(*counted[lang]) for lang in languages])


def learned(documents: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> Model:
    """The model of the rows where ``learn`` holds that have text and language."""
    rows = documents.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    found = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = materialize(
        found.mapInArrow(_count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    # One row per language.
    sizes = {r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    portions = -(-sum(sizes.values()) // PORTION_GRAMS)
    fetched: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {name: [] for name in languages}
    for portion in range(portions):
        own = F.pmod(F.xxhash64("gram"), F.lit(portions)) == portion
        part = counts.where(own).select("lang", "gram", "n").toArrow()
        owner = pc.index_in(part["lang"], pa.array(languages, pa.string())).to_numpy()
        gram, n = part["gram"].to_numpy().view(np.uint64), part["n"].to_numpy()
        order = np.lexsort((gram, owner))
        ends = np.cumsum(np.bincount(owner, minlength=len(languages)))
        for name, at in zip(languages, np.split(order, ends[:-1]), strict=True):
            fetched[name].append((gram[at], n[at]))
    levels = []
    for name in languages:
        gram, n = (np.concatenate(x) for x in zip(*fetched.pop(name), strict=True))
        order = np.argsort(gram, kind="stable")
        levels.append(_levels(gram[order], n[order]))
    return Model(languages, levels)


# --- predicting ----------------------------------------------------------------------


def _score(model, inside: str | None):
    """(row, lang, calibrates[, text]) to the row with prediction, score, bits and characters.

    The text is a column of its own or, named ``inside``, a field of the row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = model.value
        names = np.asarray([*fitted.languages, UNKNOWN], dtype=object)
        for batch in batches:
            whole = pc.struct_field(batch.column(0), [inside]) if inside else batch.column(3)
            for first, texts in _slabs(whole):
                packed, counts = grams(texts)
                best = np.full(len(texts), len(names) - 1)
                score, bits = np.zeros(len(texts)), np.zeros(len(texts))
                some = np.flatnonzero(counts)
                if len(some) and fitted.languages:
                    own = counts[some]
                    begin = np.cumsum(own) - own
                    different, place = np.unique(packed, return_inverse=True)
                    mean = np.empty((len(some), len(fitted.languages)))
                    for language in range(len(fitted.languages)):
                        cost = -np.log2(fitted.column(language, different)).astype(np.float64)
                        mean[:, language] = np.add.reduceat(cost[place], begin) / own
                    best[some] = mean.argmin(axis=1)
                    least = mean.min(axis=1)
                    bits[some] = least
                    odds = np.exp2(-(mean - least[:, None]) * np.minimum(own, 64)[:, None])
                    score[some] = 1 / odds.sum(axis=1)
                part = batch.slice(first, len(texts))
                yield pa.record_batch(
                    [
                        *part.columns[:3],
                        pa.array(names[best], pa.string()),
                        pa.array(score),
                        pa.array(bits),
                        pa.array(counts),
                    ],
                    ["row", "lang", "calibrates", "lang_pred", "score", "bits", "chars"],
                )

    return run


def identified(
    documents: DataFrame,
    learn: Column,
    keep: Sequence[str],
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Per row: ``row`` (a struct of ``keep``), ``lang_pred``, ``score``, ``bits``, ``accepted``."""
    calibrates = F.pmod(F.xxhash64(text), F.lit(CALIBRATION)) == 0
    fitted = learned(documents, learn & ~calibrates, text, lang)
    model = documents.sparkSession.sparkContext.broadcast(fitted)
    # A kept text is sent to the workers once.
    inside = text if text in keep else None
    given = documents.select(
        F.struct(*keep).alias("row"),
        F.col(lang).cast("string").alias("lang"),
        F.coalesce(learn & calibrates, F.lit(False)).alias("calibrates"),
        *([] if inside else [F.col(text).alias("text")]),
    )
    schema = T.StructType(
        [
            T.StructField("row", given.schema["row"].dataType),
            T.StructField("lang", T.StringType()),
            T.StructField("calibrates", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("bits", T.DoubleType()),
            T.StructField("chars", T.LongType()),
        ]
    )
    scored = materialize(given.mapInArrow(_score(model, inside), schema), "languages")
    right = scored.where(F.col("calibrates") & (F.col("lang") == F.col("lang_pred")))
    steps = right.groupBy("lang_pred", F.floor(F.col("bits") * 100).alias("step")).agg(
        F.count("*").alias("n")
    )
    own = Window.partitionBy("lang_pred")
    upto = own.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    summed = steps.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(own))
    middle = F.min(F.when(F.col("upto") * 2 >= F.col("all"), F.col("step")))
    upper = F.min(F.when(F.col("upto") * 1000 >= F.col("all") * 999, F.col("step")))
    beyond = F.greatest(SLACK * (upper - middle), F.lit(100 * LEAST_BITS))
    found = summed.groupBy("lang_pred").agg((middle + beyond).alias("cut"))
    # One row per language.
    cuts = materialize(found.select("lang_pred", (F.col("cut") / 100).alias("cut")), "cutoffs")
    allowed = F.coalesce("cut", F.lit(np.inf)) + SHORT_BITS / F.greatest("chars", F.lit(1))
    accepted = (F.col("lang_pred") != UNKNOWN) & (F.col("bits") <= allowed)
    judged = scored.join(cuts, "lang_pred", "left")
    return judged.select("row", "lang_pred", "score", "bits", "chars", accepted.alias("accepted"))


def held_out(key: str) -> Column:
    """Whether a document is kept out of learning."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2


def op3_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    documents = table(spark, sf_dir, "documents")
    found = identified(documents, ~held_out("doc_id"), keep=["doc_id"])
    return found.select("row.doc_id", *found.columns[1:]).withColumn("held_out", held_out("doc_id"))
