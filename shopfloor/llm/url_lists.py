"""Filtering captures by dated URL lists: validity intervals and an as-of join.

List events (list, pattern, day, added or removed) become half-open validity intervals. A
pattern is a host, a parent domain, or either with a path prefix. Each capture asks for all
patterns that could cover its URL and is matched with the entries that were active on its
fetch day; the longest matching pattern decides, and of equally long ones an allow list
outweighs a block list.

A pattern's events are first reduced to one per day, so its history is bounded by days, and an
interval appears once in each period of ``PERIOD_DAYS`` it touches. Captures join on
(pattern, period), which spreads a hot host over its periods, and skewed join splitting cuts
what is still large. No pair outside a period is formed. Where the captures' days span more than
``FAN`` periods, ``FAN`` of them make one of the next level, and so on: an interval becomes at
most ``2 * FAN`` rows a level, of the largest periods that fit, and a capture asks at each level.

A capture asks for patterns no deeper than the deepest entry, in labels of the host and in steps
of the path, so a very long URL costs no more than its length.

Edge cases: a null URL or one without host matches nothing and is not blocked; a null day
likewise; events with a null field are left out; of several events on a day removal wins;
equal captures are one row; very long URLs and far days are bounded as above; empty lists block nothing; an empty table gives an empty result.
Only named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor.llm.layout import table
from shopfloor.scratch import materialize

PERIOD_DAYS = 32
# Periods of one level that make one of the next.
FAN = 64
# Half-open intervals without an end close here.
NEVER = 1 << 30
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)"


def intervals(events: DataFrame) -> DataFrame:
    """(list, action, pattern, starts, ends): when each entry was active, in days, end excluded.

    ``events`` has list, action ("block" or "allow"), pattern, day and added.
    """
    key = ["list", "action", "pattern"]
    known = events.dropna(subset=[*key, "day", "added"])
    daily = known.groupBy(*key, "day").agg(F.min("added").alias("added"))
    history = Window.partitionBy(*key).orderBy("day")
    changes = daily.withColumn("was", F.lag("added", 1, False).over(history)).where("added <> was")
    ends = F.coalesce(F.lead("day").over(history), F.lit(NEVER))
    return (
        changes.withColumn("ends", ends)
        .where("added")
        .select(*key, F.col("day").alias("starts"), "ends")
    )


def host(url: str) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def patterns(url: str, labels: Column, steps: Column) -> Column:
    """The host and its parent domains of at most ``labels`` labels, each alone and with every
    leading part of the path up to ``steps`` steps."""
    own = F.split(host(url), r"\.")
    n = F.size(own)
    first = F.greatest(F.lit(1), n - labels + 1)
    domains = F.when(
        (host(url) != "") & (labels > 0),
        F.transform(
            F.sequence(first, n), lambda i: F.array_join(F.slice(own, i, n - i + 1), ".")
        ),
    ).otherwise(F.array().cast("array<string>"))
    parts = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")
    paths = F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts), steps)),
        lambda i: F.when(i == 0, "").otherwise(
            F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))
        ),
    )
    return F.flatten(
        F.transform(domains, lambda d: F.transform(paths, lambda p: F.concat(d, p)))
    )


def deepest(entries: DataFrame) -> DataFrame:
    """One row: the most ``labels`` and path ``steps`` of a pattern; zeros without patterns."""
    parts = F.split("pattern", "/")
    return entries.agg(
        F.coalesce(F.max(F.size(F.split(parts[0], r"\."))), F.lit(0)).alias("labels"),
        F.coalesce(F.max(F.size(parts) - 1), F.lit(0)).alias("steps"),
    )


def levels(first: int, last: int) -> int:
    """How many levels of periods days from ``first`` to ``last`` need."""
    span, found = last // PERIOD_DAYS - first // PERIOD_DAYS + 1, 1
    while span > FAN:
        span, found = span // FAN + 1, found + 1
    return found


def _blocks(low: Column, high: Column, level: int) -> Column:
    return F.when(
        low <= high,
        F.transform(
            F.sequence(low, high),
            lambda x: F.struct(F.lit(level).alias("level"), x.cast("long").alias("period")),
        ),
    ).otherwise(F.array().cast("array<struct<level: int, period: bigint>>"))


def with_periods(valid: DataFrame, first: int, last: int) -> DataFrame:
    """``valid`` once for each (``level``, ``period``) that makes up its days in [first, last]."""
    count = levels(first, last)
    rows = valid.withColumn(
        "low", F.floor(F.greatest("starts", F.lit(first)) / PERIOD_DAYS)
    ).withColumn("high", F.floor(F.least(F.col("ends") - 1, F.lit(last)) / PERIOD_DAYS))
    made = [f"made{level}" for level in range(count)]
    for level, name in enumerate(made):
        low, high = F.col("low"), F.col("high")
        if level == count - 1:
            rows = rows.withColumn(name, _blocks(low, high, level))
            continue
        # The whole periods of the next level, and what is left on either side of them.
        up, down = F.ceil(low / FAN), F.floor((high + 1) / FAN) - 1
        whole = up <= down
        own = F.when(
            whole,
            F.concat(_blocks(low, up * FAN - 1, level), _blocks((down + 1) * FAN, high, level)),
        ).otherwise(_blocks(low, high, level))
        rows = rows.withColumn(name, own).withColumns(
            {"low": F.when(whole, up).otherwise(F.lit(1)), "high": F.when(whole, down).otherwise(F.lit(0))}
        )
    every = F.concat(*made) if len(made) > 1 else F.col(made[0])
    return rows.select(*valid.columns, F.inline(every))


def evaluated(captures: DataFrame, events: DataFrame, *, url: str = "url", day: str = "day", key: str = "page_id") -> DataFrame:
    """Per capture: id, url, day, ``active`` (how many entries), ``matched``, ``blocked``."""
    dated = captures.select(
        F.col(key).alias("capture"), F.col(url).alias("url"), F.col(day).cast("int").alias("day")
    ).distinct()
    valid = intervals(events)
    first, last = dated.agg(F.min("day"), F.max("day")).first()
    first, last = (0, 0) if last is None else (int(first), int(last))
    active = valid.where((F.col("starts") <= last) & (F.col("ends") > first))
    entries = materialize(with_periods(active, first, last), "intervals")
    deep = deepest(entries).first()
    wanted = F.array_distinct(patterns("url", F.lit(deep["labels"]), F.lit(deep["steps"])))
    own = F.floor(F.col("day") / PERIOD_DAYS)
    periods = F.array(
        *[
            F.struct(F.lit(level).alias("level"), F.floor(own / FAN**level).alias("period"))
            for level in range(levels(first, last))
        ]
    )
    asked = dated.where(F.col("day").isNotNull()).withColumn("pattern", F.explode(wanted)).select(
        "capture", "url", "day", "pattern", F.inline(periods)
    )
    met = (
        asked.join(entries, ["pattern", "level", "period"])
        .where((F.col("starts") <= F.col("day")) & (F.col("day") < F.col("ends")))
        .select("capture", "url", "day", "list", "action", "pattern")
    )
    allows = F.when(F.col("action") == "allow", 1).otherwise(0)
    verdict = met.groupBy("capture", "url", "day").agg(
        F.count("*").alias("active"),
        F.max(
            F.struct(F.length("pattern").alias("length"), allows.alias("allows"), "pattern", "list")
        ).alias("best"),
    )
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"v.{c}")) for c in ("capture", "url", "day")]
    joined = dated.alias("d").join(verdict.alias("v"), same[0] & same[1] & same[2], "left")
    return joined.select(
        F.col("d.capture").alias(key),
        F.col("d.url").alias("url"),
        F.col("d.day").alias("day"),
        F.coalesce("active", F.lit(0)).cast("long").alias("active"),
        F.col("best.pattern").alias("matched"),
        F.col("best.list").alias("list"),
        F.coalesce(F.col("best.allows") == 0, F.lit(False)).alias("blocked"),
    )


def _number(text: Column, salt: str, modulus: int) -> Column:
    """A number below ``modulus`` that follows from a text alike in Spark and in SQL."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), text)), 1, 7)
    return F.conv(digits, 16, 10).cast("long") % modulus


def derived_events(pages: DataFrame) -> DataFrame:
    """Dated entries on hosts, parent domains and first path parts that occur in ``pages``.

    The tables hold no lists, so entries follow from the hash of each pattern.
    """
    hosts = pages.select(host("url").alias("host"), F.regexp_extract("url", PATH, 1).alias("path"))
    first = F.regexp_extract("path", "^(/[^/]+)", 1)
    seen = hosts.where("host <> ''").select(
        F.explode(
            F.array(
                F.struct(F.lit("hosts").alias("list"), F.lit("block").alias("action"), F.col("host").alias("pattern")),
                F.struct(
                    F.lit("domains").alias("list"),
                    F.lit("block").alias("action"),
                    F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("pattern"),
                ),
                F.struct(
                    F.lit("sections").alias("list"),
                    F.lit("allow").alias("action"),
                    F.concat("host", first).alias("pattern"),
                ),
            )
        ).alias("e")
    ).select("e.*").where("pattern <> ''").distinct()
    pattern = F.col("pattern")
    chosen = seen.where(_number(pattern, "in", 3) == 0)
    start, length = _number(pattern, "start", 300), _number(pattern, "length", 90) + 1
    turns = F.array(
        F.struct(start.alias("day"), F.lit(True).alias("added")),
        F.struct((start + length).alias("day"), F.lit(False).alias("added")),
        F.struct((start + length + 30).alias("day"), F.lit(True).alias("added")),
    )
    return chosen.select("list", "action", "pattern", F.explode(turns).alias("t")).select(
        "list", "action", "pattern", "t.day", "t.added"
    )


def fetch_day(page_id: str) -> Column:
    """The tables hold no fetch time: a day of a year that follows from the id."""
    return (F.col(page_id) * 37 % 366).cast("int")


def op2_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries active on its fetch day."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = materialize(derived_events(pages), "list-events")
    captures = pages.withColumn("day", fetch_day("page_id"))
    return evaluated(captures, events)


ORACLE_OP2 = r"""
WITH captures AS (
  SELECT DISTINCT page_id, url, CAST(page_id * 37 % 366 AS INTEGER) AS day,
    lower(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
    regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
seen AS (
  SELECT 'hosts' AS list, 'block' AS action, host AS pattern FROM captures WHERE host <> ''
  UNION SELECT 'domains', 'block', regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) FROM captures WHERE host <> ''
  UNION SELECT 'sections', 'allow', host || regexp_extract(path, '^(/[^/]+)', 1) FROM captures WHERE host <> ''
),
numbered AS (
  SELECT list, action, pattern,
    CAST('0x' || substr(md5('in' || pattern), 1, 7) AS BIGINT) % 3 AS chosen,
    CAST('0x' || substr(md5('start' || pattern), 1, 7) AS BIGINT) % 300 AS start,
    CAST('0x' || substr(md5('length' || pattern), 1, 7) AS BIGINT) % 90 + 1 AS length
  FROM seen WHERE pattern <> ''
),
entries AS (
  SELECT list, action, pattern, start AS starts, start + length AS ends FROM numbered WHERE chosen = 0
  UNION ALL SELECT list, action, pattern, start + length + 30, 1000000 FROM numbered WHERE chosen = 0
),
met AS (
  SELECT page_id, url, day, list, action, pattern
  FROM captures JOIN entries ON starts <= day AND day < ends AND host <> '' AND (
    CASE WHEN contains(pattern, '/') THEN split_part(pattern, '/', 1) ELSE pattern END = host
    OR ends_with(host, '.' || split_part(pattern, '/', 1))
  ) AND (NOT contains(pattern, '/') OR starts_with(regexp_replace(path, '/+', '/', 'g') || '/', substr(pattern, strpos(pattern, '/')) || '/'))
),
ranked AS (
  SELECT *, count(*) OVER w AS active,
    row_number() OVER (PARTITION BY page_id, url, day ORDER BY length(pattern) DESC, action, pattern DESC, list DESC) AS place
  FROM met WINDOW w AS (PARTITION BY page_id, url, day)
)
SELECT captures.page_id, captures.url, captures.day, coalesce(active, 0) AS active, pattern AS matched, list,
  coalesce(action = 'block', false) AS blocked
FROM captures LEFT JOIN ranked ON place = 1 AND captures.page_id = ranked.page_id AND captures.url = ranked.url AND captures.day = ranked.day
"""
