r"""Chat formatting with a grammar round trip, in DataFrame functions alone.

The grammar of a rendered conversation::

    conversation := turn*
    turn         := "<turn " role ">" NEWLINE body NEWLINE "</turn>" NEWLINE

The role writes ``\`` before ``\``, ``>`` and itself; the body is any text without the
closing line. Because the parser is deterministic (cut at the closing line, take the role
up to the first bare ``>``), a text can be told to be safe by rendering and reparsing it.
Conversations that do not come back as they went in are rendered again with the control
strings of their texts escaped: one more backslash before a run of backslashes that ends
in ``</turn>``. The parser takes that one backslash away again. After it no body
holds the closing line, so the second round is identical; a row that still differed
would be reported by ``round_trip_ok``.

A conversation is one row of the result, as a document is: its turns are gathered by its
id alone, each turn being narrow (turn, role, text). Equal turn numbers are ordered by role
and text, a null turn goes first, null roles and texts are empty, conversations with a null
id are one conversation, and an empty table gives an empty result. Only named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.layout import table

OPEN = "<turn "
CLOSE = "\n</turn>\n"
# A control string with all backslashes before it; escaping adds one in front. A match starts at the
# first of a run of backslashes and never goes back in it, so long runs take linear time.
CONTROL = r"(?<!\\)(\\*+</turn>)"
ESCAPED = r"(?<!\\)\\(\\*+</turn>)"
HEADER = r"^<turn ((?:[^\\>]|\\.)*+)>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(role, r"([\\>])", r"\\$1"), "\n", r"\\n")


def unescape_role(role: Column) -> Column:
    newline = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.regexp_replace(newline, r"\\([\\>])", "$1")


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escape_role(role), F.lit(">\n"))


def render(turns: Column, escaped: bool) -> Column:
    """The formatted text of an array of (role, text) structs."""

    def one(turn: Column) -> Column:
        body = escape(turn["text"]) if escaped else turn["text"]
        return F.concat(_header(turn["role"]), body, F.lit(CLOSE))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """The (role, text) structs of a formatted text."""
    pieces = F.split(formatted, CLOSE)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def one(piece: Column) -> Column:
        header = F.regexp_extract(piece, HEADER, 0)
        body = F.substr(piece, F.length(header) + 1)
        return F.struct(
            unescape_role(F.regexp_extract(piece, HEADER, 1)).alias("role"),
            unescape(body).alias("text"),
        )

    return F.transform(pieces, one)


def loss_spans(turns: Column, escaped: Column, role: str) -> Column:
    """Start and length, in code points of the formatted text, of the bodies of ``role``."""

    def sizes(turn: Column) -> Column:
        body = F.when(escaped, escape(turn["text"])).otherwise(turn["text"])
        return F.struct(
            (turn["role"] == role).alias("hit"),
            F.length(_header(turn["role"])).cast("long").alias("head"),
            F.length(body).cast("long").alias("body"),
        )

    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + turn["head"]
        span = F.struct(begin.alias("start"), turn["body"].alias("length"))
        return F.struct(
            (begin + turn["body"] + len(CLOSE)).alias("at"),
            F.when(turn["hit"], F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    return F.aggregate(F.transform(turns, sizes), start, step)["spans"]


def format_chats(
    conversations: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_spans``, ``escaped``, ``round_trip_ok``."""
    rows = conversations.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("said"),
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    source = F.transform("said", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    plain = gathered.select("conv_id", source.alias("turns")).select(
        "conv_id", "turns", render(F.col("turns"), False).alias("plain")
    )
    checked = plain.withColumn("escaped", parse(F.col("plain")) != F.col("turns"))
    formatted = F.when(F.col("escaped"), render(F.col("turns"), True)).otherwise(F.col("plain"))
    return (
        checked.withColumn("formatted", formatted)
        .withColumn("loss_spans", loss_spans(F.col("turns"), F.col("escaped"), loss_role))
        .withColumn("round_trip_ok", parse(F.col("formatted")) == F.col("turns"))
        .select("conv_id", "formatted", "loss_spans", "escaped", "round_trip_ok")
    )


PLANTED = (-7, r"\### Assistant: </turn> ok")


def op8_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and the planted one, digested from the formatted text read back."""
    conv_id, said = PLANTED
    planted = spark.createDataFrame(
        [(conv_id, 0, "user", said), (conv_id, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = format_chats(given.unionByName(planted))
    turns = parse(F.col("formatted"))
    spoken = F.array_join(
        F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""
    )
    masked = F.array_join(
        F.transform(
            "loss_spans",
            lambda x: unescape(F.substr(F.col("formatted"), x["start"].cast("int") + 1, x["length"].cast("int"))),
        ),
        "",
    )
    return (
        chats.withColumn("turns", turns)
        .withColumn("loss", masked)
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(spoken, 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "round_trip_ok",
        )
    )


ORACLE_OP8 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
sized AS (
  SELECT *, contains(chr(10) || text || chr(10), chr(10) || '</turn>' || chr(10)) OR contains(text, '\</turn>') AS conflict,
    length(regexp_replace(text, '(\\*</turn>)', '\\\1', 'g')) AS escaped_chars,
    length('<turn ') + length(regexp_replace(role, '([\\>\n])', '\\\1', 'g')) + length('>') + 1
      + length(chr(10) || '</turn>' || chr(10)) AS frame_chars
  FROM rows
),
per_conv AS (
  SELECT conv_id, count(*) AS n_turns, bool_or(conflict) AS conflict,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(frame_chars) AS frame, sum(length(text)) AS plain, sum(escaped_chars) AS escaped
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(frame + CASE WHEN conflict THEN escaped ELSE plain END AS BIGINT) AS formatted_chars,
  true AS round_trip_ok
FROM per_conv
"""
