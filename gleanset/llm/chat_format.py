"""Chat formatting with Spark expressions only.

Turns are collected per conversation, sorted, and merged where neighbours share a
role; each merged block is written between its role's marks, its texts parted by a
mark.  Control strings inside texts are escaped by a backslash after their first
character, one more than they already have there, so escaping can be undone exactly.

Cases: a null or empty text is an empty text; a null role counts as an empty role;
turns with a null number come first, and turns with equal numbers are ordered by
role and text.  Rows without ``conv_id`` form one conversation.  Repeated rows are turns of
their own.  A conversation becomes one row, so it must fit a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of each role; other roles are written as [ROLE]role[SEP]text…[/ROLE].
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]")
PART = "[SEP]"

_CONTROL = r"(<|\[)(\\*)(/?s>|/?(?:SYS|INST|ROLE)\]|SEP\])"
_ESCAPED = r"(<|\[)\\(\\*)(/?s>|/?(?:SYS|INST|ROLE)\]|SEP\])"
_BLOCK = (
    r"(?s)(?:\[SYS\].*?\[/SYS\]|\[INST\].*?\[/INST\]|<s>.*?</s>|\[ROLE\].*?\[/ROLE\])"
)


def escape(text: Column) -> Column:
    """Text in which no control string occurs."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _open(role: Column) -> Column:
    mark = F.concat(F.lit(OTHER[0]), escape(role), F.lit(PART))
    for name, (begin, _) in MARKS.items():
        mark = F.when(role == name, F.lit(begin)).otherwise(mark)
    return mark


def _close(role: Column) -> Column:
    mark = F.lit(OTHER[1])
    for name, (_, end) in MARKS.items():
        mark = F.when(role == name, F.lit(end)).otherwise(mark)
    return mark


def format_chats(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: the id, ``formatted``, ``segments`` and ``n_blocks``.

    ``segments`` are pieces ``(text, loss)`` whose texts make up ``formatted``; the loss
    mask covers the assistant's texts, without marks.
    """
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    sorted_turns = F.array_sort(F.collect_list("one"))
    all_turns = turns.select(F.col(conversation), one.alias("one")).groupBy(conversation).agg(
        sorted_turns.alias("turns")
    )
    at = F.col("turns")
    starts = F.filter(
        F.sequence(F.lit(0), F.size(at) - 1),
        lambda i: (i == 0) | (F.get(at, i)["role"] != F.get(at, i - 1)["role"]),
    )
    blocks = F.transform(
        F.col("starts"),
        lambda i, k: F.struct(
            F.get(at, i)["role"].alias("role"),
            F.transform(
                F.slice(at, i + 1, F.coalesce(F.get("starts", k + 1), F.size(at)) - i),
                lambda x: escape(x["text"]),
            ).alias("texts"),
        ),
    )

    def pieces(block: Column) -> Column:
        spoken = block["role"] == "assistant"
        mark = F.lit(False)
        parted = F.transform(
            block["texts"],
            lambda x, i: F.array(
                F.struct(F.when(i == 0, _open(block["role"])).otherwise(F.lit(PART)).alias("text"),
                         mark.alias("loss")),
                F.struct(x.alias("text"), spoken.alias("loss")),
            ),
        )
        end = F.struct(_close(block["role"]).alias("text"), mark.alias("loss"))
        return F.concat(F.flatten(parted), F.array(end))

    return (
        all_turns.withColumn("starts", starts)
        .withColumn("segments", F.flatten(F.transform(blocks, pieces)))
        .select(
            conversation,
            F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"),
            "segments",
            F.size("starts").cast("bigint").alias("n_blocks"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, in order: an array of ``(role, text)``."""

    def turns_of(block: Column) -> Column:
        inner = F.regexp_replace(block, r"^(?:\[[A-Z]+\]|<s>)|(?:\[/[A-Z]+\]|</s>)$", "")
        named = F.lit(None).cast("string")
        for name, (begin, _) in MARKS.items():
            named = F.when(block.startswith(begin), F.lit(name)).otherwise(named)
        texts = F.split(inner, r"\[SEP\]", -1)
        role = F.coalesce(named, unescape(F.get(texts, F.lit(0))))
        first = F.when(named.isNull(), F.lit(2)).otherwise(F.lit(1))
        return F.transform(
            F.slice(texts, first, F.size(texts)),
            lambda x: F.struct(role.alias("role"), unescape(x).alias("text")),
        )

    blocks = F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(0))
    return F.flatten(F.transform(blocks, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    spoken = F.filter(segments, lambda x: x["loss"])
    return F.array_join(F.transform(spoken, lambda x: unescape(x["text"])), "")
