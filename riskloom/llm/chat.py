"""Conversations as training text: a template whose output parses back to the same turns.

Layout of a conversation, without line breaks between the parts::

    <s>[ROLE]user[/ROLE]text</s><s>[ROLE]assistant[/ROLE]text</s>

Tags are these and those of common templates ([INST], <<SYS>> and their closing forms). A tag inside a role or text would be read
as layout, so it is escaped by a backslash behind its bracket; a tag that has backslashes there
already gets one more. Reading a body takes one backslash from every such place, which undoes
the escape and nothing else.

Rendering is a round trip. A turn is first written as it is, parsed back and compared with the
source; if it comes back different, or breaks the grammar by a bare tag, it is escaped and
compared again. After one escape it is equal for every text (unescaping reverses escaping), so
there are two passes; a turn that still differed would stop the job instead of being written.
The whole conversation is parsed and compared once more.

Only built-in functions are used. A conversation is one row of the result, so its turns must
meet in one task; they are collected on both sides of the exchange, one record per task and
conversation.

Edge cases. A null role or text is empty. Turns are ordered by (turn, role, text), nulls
first, and repeated rows stay repeated turns. Rows with a null conversation id form one
conversation. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table

_BODY = r"/?s>|<\\*/?SYS>>|/?ROLE\]|/?INST\]"
_TAG = rf"([<\[])(\\*)(?={_BODY})"
_ESCAPED = rf"([<\[])\\(\\*)(?={_BODY})"
_RAW = rf"[<\[](?={_BODY})"

START, END, OPEN, CLOSE = "<s>", "</s>", "[ROLE]", "[/ROLE]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_TAG), F.lit(r"$1\\$2"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2"))


def rendered(role: Column, body: Column) -> Column:
    return F.concat(F.lit(START + OPEN), role, F.lit(CLOSE), body, F.lit(END))


def parsed(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, text, first, chars).

    ``first`` and ``chars`` are place and length of the body inside its turn, escapes
    included, in code points. Role or text are null where they hold a tag as it is, which the
    grammar forbids.
    """
    turns = F.filter(F.split(formatted, f"(?<={END})", -1), lambda t: t != "")
    read = lambda part: F.when(~part.rlike(_RAW), unescape(part))

    def pieces(turn: Column) -> Column:
        head = len(START + OPEN)
        cut = F.instr(turn, CLOSE)
        first = cut - 1 + len(CLOSE)
        chars = F.char_length(turn) - first - len(END)
        return F.struct(
            read(F.substring(turn, head + 1, cut - 1 - head)).alias("role"),
            read(F.substring(turn, first + 1, chars)).alias("text"),
            first.alias("first"),
            chars.alias("chars"),
        )

    return F.transform(turns, pieces)


def _content(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t.role, t.text))


def written(role: Column, text: Column) -> Column:
    """One rendered turn: as it is if it is read back the same, otherwise escaped."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    plain, safe = rendered(role, text), rendered(escape(role), escape(text))
    failed = F.raise_error(F.lit("text does not survive the chat template")).cast("string")
    same = lambda turn: _content(parsed(turn)).eqNullSafe(_content(source))
    return F.when(same(plain), plain).when(same(safe), safe).otherwise(failed)


def format_chats(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """conv_id, formatted, turns (read back) and mask: the bodies of ``learned`` turns.

    A span of the mask is (turn from 0, first, chars), the latter two inside the turn.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    one = F.struct(F.col("turn"), role.alias("role"), text.alias("text"), written(role, text).alias("as_text"))
    grouped = turns.select("conv_id", one.alias("one")).groupBy("conv_id")
    ordered = grouped.agg(F.sort_array(F.collect_list("one")).alias("source"))
    joined = F.array_join(F.transform("source", lambda t: t.as_text), "")
    read = ordered.select("conv_id", "source", joined.alias("formatted"))
    read = read.withColumn("turns", parsed(F.col("formatted")))
    same = _content(F.col("turns")).eqNullSafe(_content(F.col("source")))
    failed = F.raise_error(F.lit("conversation does not survive the chat template"))
    spans = F.transform(
        "turns",
        lambda t, i: F.struct(i.alias("turn"), t["first"].alias("first"), t.chars.alias("chars"), t.role.alias("role")),
    )
    mask = F.transform(
        F.filter(spans, lambda t: t.role == learned),
        lambda t: F.struct(t.turn.alias("turn"), t["first"].alias("first"), t.chars.alias("chars")),
    )
    return read.select(
        "conv_id",
        F.when(same, F.col("formatted")).otherwise(failed.cast("string")).alias("formatted"),
        mask.alias("mask"),
        "turns",
    )


def masked(formatted: Column, mask: Column) -> Column:
    """Unescaped text under the mask."""
    turns = F.split(formatted, f"(?<={END})", -1)
    cut = lambda t: unescape(F.substring(F.get(turns, t.turn), t["first"] + 1, t.chars))
    return F.array_join(F.transform(mask, cut), "")


HOSTILE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HOSTILE).alias("text"),
    )
    chats = format_chats(rows.unionByName(hostile))
    joined = F.array_join(
        F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""
    )
    chats = chats.withColumn("loss", masked(F.col("formatted"), F.col("mask")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


_SQL_TAG = r"([<\[])(\\*)(/?s>|<\\*/?SYS>>|/?ROLE\]|/?INST\])"
ORACLE = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{HOSTILE}' UNION ALL SELECT -1, 1, 'assistant', '{HOSTILE}'
), sized AS (
    SELECT *, len(role) + len(text) + {len(START + OPEN + CLOSE + END)}
        + len(regexp_extract_all(role, '{_SQL_TAG}'))
        + len(regexp_extract_all(text, '{_SQL_TAG}')) AS chars
    FROM turns
), joined AS (
    SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
            FILTER (WHERE role = 'assistant'), '') AS loss
    FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, len(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars
FROM joined
"""
