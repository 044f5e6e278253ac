r"""Quality rules with adaptive thresholds, in DataFrame functions alone.

Each text gets counts (words, symbols, repeated lines, repeated three-word windows). Per
language and source a mergeable quantile sketch holds each measure's distribution: counts
of the values rounded down to five leading binary digits, so a quantile is right to 1/16
and sketches are merged by adding counts, on the map side, over sources or overall. A
cutoff lies ``FENCE`` interquartile ranges beyond the upper (or lower) quartile of the
document's own group, so what is usual for a language and source passes there; a least range
per measure keeps groups without spread from rejecting small deviations. Groups of fewer
than ``LEAST_ROWS`` documents use their language's merged sketch, and languages of fewer the
sketch of all. The cutoffs are a table of one row per group and are joined to the documents.

The sketch of the union of two parts is the sum of theirs, whatever the partitioning, so
results are the same on every run.

Edge cases: a null text has no words and fails the base rule; null languages and sources
are groups of their own; repeated rows are judged alike; an empty table gives an empty
result; columns outside ``keep`` are not carried, and kept ones sit in a struct, so their
names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm.layout import SPACE, table
from shopfloor.scratch import materialize

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
FENCE = 4
LEAST_ROWS = 200
GROUP = ("lang", "source")


@dataclass(frozen=True)
class Measure:
    """An integer measure: its SQL expression, the sides it is cut on, its least range."""

    name: str
    value: str
    least_range: int
    lower: bool = False


MEASURES = (
    Measure("symbols", "1000 * n_symbols div greatest(word_chars, 1)", 20),
    Measure("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 125),
    Measure("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", 100),
    Measure("word_length", "100 * word_chars div greatest(n_words, 1)", 100, lower=True),
)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def with_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus the counts of its ``text`` column, which is dropped."""
    kept = [c for c in df.columns if c != text]
    words = F.filter(F.split(text, SPACE), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(_without(x, BLANKS)) > 0)
    split = df.withColumn(text, F.coalesce(text, F.lit(""))).select(
        *kept,
        words.alias("__words"),
        lines.alias("__lines"),
        F.length(_without(F.col(text), BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(F.col(text), SYMBOLS))).cast("long").alias("n_symbols"),
    )
    n = F.size("__words")
    hashes = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(
                F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        *kept,
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("__windows"),
    )
    # Only texts in which a window repeats are looked at any closer.
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.array_sort(
        F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    sorted_windows = counted.withColumn("__placed", F.when(repeats, placed)).drop("__windows")
    return sorted_windows.withColumn(
        "n_repeat_words", F.coalesce(_covered_by_repeats("__placed"), F.lit(0).cast("long"))
    ).drop("__placed")


def _covered_by_repeats(placed: str) -> Column:
    """How many words lie in windows of three that occur more than once.

    ``placed`` holds (h, i), hash and place of each window, sorted: equal ones are neighbours.
    """

    def hash_at(k: Column) -> Column:
        return F.get(placed, k)["h"]

    def repeated(k: Column) -> Column:
        h = hash_at(k)
        again = F.coalesce(h == hash_at(k - 1), F.lit(False)) | F.coalesce(
            h == hash_at(k + 1), F.lit(False)
        )
        return F.when(again, F.get(placed, k)["i"])

    places = F.filter(
        F.transform(F.sequence(F.lit(0), F.size(placed) - 1), repeated), lambda i: i.isNotNull()
    )
    return F.aggregate(
        F.array_sort(places),
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("next")),
        lambda s, i: F.struct(
            (s["total"] + i + 3 - F.greatest(i, s["next"])).cast("long").alias("total"),
            (i + 3).alias("next"),
        ),
    )["total"]


def _rounded(value: str) -> Column:
    """The value with all but its five leading binary digits cleared."""
    drop = f"greatest(length(bin({value})) - 5, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {drop}), {drop})")


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, measure, value, n): mergeable, as ``n`` adds up."""
    each = F.array(
        *[F.struct(F.lit(m.name).alias("measure"), F.expr(m.value).alias("v")) for m in MEASURES]
    )
    rows = counts.select(*GROUP, F.explode(each).alias("m")).select(*GROUP, "m.measure", "m.v")
    return (
        rows.groupBy(*GROUP, "measure", _rounded("v").alias("value"))
        .agg(F.count("*").alias("n"))
    )


def _quartiles(sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and measure: rows, lower and upper quartile of the merged sketch."""
    merged = sketch.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "measure")
    upto = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    summed = merged.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(whole))
    return summed.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("value"))).alias("low"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("value"))).alias("high"),
    )


def cutoffs(sketch: DataFrame) -> DataFrame:
    """One row per language and source: ``<measure>_most`` and ``<measure>_least``."""

    def level(keys: Sequence[str], suffix: str) -> DataFrame:
        found = _quartiles(sketch, keys)
        return found.select(
            *[F.col(k).alias(f"{k}_{suffix}") for k in keys],
            F.col("measure").alias(f"measure_{suffix}"),
            *[F.col(c).alias(f"{c}_{suffix}") for c in ("total", "low", "high")],
        )

    groups = sketch.select(*GROUP, "measure").distinct()
    own, language, overall = level(GROUP, "own"), level(["lang"], "lang"), level([], "all")
    same = F.col("measure")
    chosen = (
        groups.join(
            own,
            F.col("lang").eqNullSafe(F.col("lang_own"))
            & F.col("source").eqNullSafe(F.col("source_own"))
            & (same == F.col("measure_own")),
        )
        .join(language, F.col("lang").eqNullSafe(F.col("lang_lang")) & (same == F.col("measure_lang")))
        .join(overall, same == F.col("measure_all"))
    )

    def pick(column: str) -> Column:
        return (
            F.when(F.col("total_own") >= LEAST_ROWS, F.col(f"{column}_own"))
            .when(F.col("total_lang") >= LEAST_ROWS, F.col(f"{column}_lang"))
            .otherwise(F.col(f"{column}_all"))
        )

    quartiles = chosen.select(*GROUP, "measure", pick("low").alias("low"), pick("high").alias("high"))
    out = []
    for m in MEASURES:
        spread = F.greatest(F.col("high") - F.col("low"), F.lit(m.least_range))
        mine = F.col("measure") == m.name
        out.append(F.max(F.when(mine, F.col("high") + FENCE * spread)).alias(f"{m.name}_most"))
        out.append(F.max(F.when(mine, F.col("low") - FENCE * spread)).alias(f"{m.name}_least"))
    return quartiles.groupBy(*GROUP).agg(*out)


def judged(
    documents: DataFrame,
    keep: Sequence[str],
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """Per row: ``row`` (a struct of ``keep``), the counts, ``base_failed`` and ``kept``."""
    given = documents.select(
        F.struct(*keep).alias("row"),
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
        F.col(text).alias("__text"),
    )
    counts = materialize(with_counts(given, "__text"), "quality-counts")
    cuts = materialize(
        cutoffs(materialize(sketches(counts), "quality-sketches")), "quality-cutoffs"
    ).select(
        F.col("lang").alias("__lang"),
        F.col("source").alias("__source"),
        *[f"{m.name}_{side}" for m in MEASURES for side in ("most", "least")],
    )
    joined = counts.join(
        cuts,
        F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")),
    )
    base_failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    passes = F.lit(True)
    for m in MEASURES:
        value = F.expr(m.value)
        passes = passes & (value <= F.col(f"{m.name}_most"))
        if m.lower:
            passes = passes & (value >= F.col(f"{m.name}_least"))
    return joined.withColumn("base_failed", base_failed).select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & passes).alias("kept"),
    )


def op7_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for all documents."""
    found = judged(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", *found.columns[1:])


def _oracle() -> str:
    most = " AND ".join(f"{m.value.replace(' div ', ' // ')} <= {m.name}_most" for m in MEASURES)
    least = " AND ".join(
        f"{m.value.replace(' div ', ' // ')} >= {m.name}_least" for m in MEASURES if m.lower
    )
    sides = ", ".join(
        f"max(CASE WHEN measure = '{m.name}' THEN high + {FENCE} * greatest(high - low, {m.least_range}) END) AS {m.name}_most, "
        f"max(CASE WHEN measure = '{m.name}' THEN low - {FENCE} * greatest(high - low, {m.least_range}) END) AS {m.name}_least"
        for m in MEASURES
    )
    measured = " UNION ALL ".join(
        f"SELECT lang, source, '{m.name}' AS measure, {m.value.replace(' div ', ' // ')} AS v FROM counts"
        for m in MEASURES
    )

    def quartiles(keys: str) -> str:
        comma = f"{keys}, " if keys else ""
        return f"""
  SELECT {comma}measure, max(total) AS total,
    min(CASE WHEN upto * 4 >= total THEN value END) AS low,
    min(CASE WHEN upto * 4 >= total * 3 THEN value END) AS high
  FROM (
    SELECT {comma}measure, value,
      sum(n) OVER (PARTITION BY {comma}measure ORDER BY value ROWS UNBOUNDED PRECEDING) AS upto,
      sum(n) OVER (PARTITION BY {comma}measure) AS total
    FROM (SELECT {comma}measure, value, sum(n) AS n FROM sketch GROUP BY ALL)
  ) GROUP BY ALL"""

    return rf"""
WITH given AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM given)
),
windows AS (
  SELECT r, i, CASE WHEN lead(word, 2) OVER w IS NOT NULL
    THEN word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w END AS g
  FROM words WINDOW w AS (PARTITION BY r ORDER BY i)
),
marked AS (
  SELECT r, i, g IS NOT NULL AND count(*) OVER (PARTITION BY r, g) > 1 AS twice FROM windows
),
covered AS (
  SELECT r, twice OR coalesce(lag(twice, 1) OVER w, false) OR coalesce(lag(twice, 2) OVER w, false) AS c
  FROM marked WINDOW w AS (PARTITION BY r ORDER BY i)
),
repeats AS (SELECT r, count(*) FILTER (WHERE c) AS n_repeat_words FROM covered GROUP BY r),
counts AS (
  SELECT given.r, doc_id, lang, source,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM given LEFT JOIN repeats ON given.r = repeats.r
),
measured AS ({measured}),
sketch AS (
  SELECT lang, source, measure,
    (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) AS value, count(*) AS n
  FROM measured GROUP BY ALL
),
own AS ({quartiles("lang, source")}),
language AS ({quartiles("lang")}),
overall AS ({quartiles("")}),
chosen AS (
  SELECT own.lang, own.source, own.measure,
    CASE WHEN own.total >= {LEAST_ROWS} THEN own.low WHEN language.total >= {LEAST_ROWS} THEN language.low ELSE overall.low END AS low,
    CASE WHEN own.total >= {LEAST_ROWS} THEN own.high WHEN language.total >= {LEAST_ROWS} THEN language.high ELSE overall.high END AS high
  FROM own JOIN language ON own.lang IS NOT DISTINCT FROM language.lang AND own.measure = language.measure
  JOIN overall ON own.measure = overall.measure
),
cuts AS (SELECT lang, source, {sides} FROM chosen GROUP BY ALL),
judged AS (
  SELECT counts.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    {most} AND {least} AS passes
  FROM counts JOIN cuts ON counts.lang IS NOT DISTINCT FROM cuts.lang AND counts.source IS NOT DISTINCT FROM cuts.source
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND passes AS kept
FROM judged
"""


ORACLE_OP7 = _oracle()
