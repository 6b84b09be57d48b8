"""Chat formatting in Spark expressions only: collect, sort, merge, concatenate, read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opening and closing string of each role with strings of its own; other roles carry their name.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[BOT]", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]")
START, NAMED, NEXT = "<s>", "[TEXT]", "[NEXT]"

#: Control strings, in a text with any number of backslashes after the bracket.
CONTROL = r"(/?s>|/?SYS\]|/?INST\]|BOT\]|/?ROLE\]|TEXT\]|NEXT\])"
_OPENS = r"(?=\[SYS\]|\[INST\]|\[BOT\]|\[ROLE\])"


def escape(text: Column) -> Column:
    """One more backslash after the bracket of everything that reads like a control string."""
    return F.regexp_replace(text, r"(<|\[)(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The inverse of escape()."""
    return F.regexp_replace(text, r"(<|\[)\\(\\*)" + CONTROL, r"$1$2$3")


def _by_role(role: Column, at: int, other: Column) -> Column:
    out = F.when(role == "system", MARKS["system"][at])
    return out.when(role == "user", MARKS["user"][at]).when(role == "assistant", MARKS["assistant"][at]).otherwise(other)


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: (conv, formatted, loss), loss being (start, length) spans of the assistant texts.

    A conversation's turns are collected as structs and sorted by turn, then
    role and text, so ties have one order; repeated rows are repeated turns.
    Adjacent turns of one role become one block `open text [NEXT] text close`.
    Control strings in texts and role names are escaped reversibly. Offsets
    count code points. Null texts and roles are empty, null turns come
    first; a row with a null key is a conversation of its own, so they are
    never gathered; no rows, no result. Other columns are ignored. A conversation is one output row and has to
    fit in a task; its rows are combined before the shuffle.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    alone = F.when(F.col(conv).isNull(), F.monotonically_increasing_id())
    turns = rows.groupBy(F.col(conv).alias("__conv"), alone.alias("__alone")).agg(F.array_sort(F.collect_list(one)).alias("turns"))

    # Merging: the turns at which the role changes, and what lies between two of them.
    starts = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (i == 1) | (F.get("turns", i - 1)["role"] != F.get("turns", i - 2)["role"]))
    blocks = turns.withColumn("starts", starts).select(
        "__conv",
        F.transform(
            "starts",
            lambda s, k: F.struct(
                F.get("turns", s - 1)["role"].alias("role"),
                F.transform(F.slice("turns", s, F.coalesce(F.get("starts", k + 1), F.size("turns") + 1) - s), lambda t: escape(t["text"])).alias("texts"),
            ),
        ).alias("blocks"),
    )

    def opened(b: Column) -> Column:
        return _by_role(b["role"], 0, F.concat(F.lit(OTHER[0]), escape(b["role"]), F.lit(NAMED)))

    def closed(b: Column) -> Column:
        return _by_role(b["role"], 1, F.lit(OTHER[1]))

    written = blocks.select(
        "__conv",
        F.transform("blocks", lambda b: F.struct((b["role"] == "assistant").alias("loss"), opened(b).alias("open"), b["texts"].alias("texts"), closed(b).alias("close"))).alias("blocks"),
    )
    zero = F.struct(F.lit(len(START)).cast("long").alias("at"), F.expr("cast(array() as array<struct<start: bigint, length: bigint>>)").alias("spans"))

    def put(acc: Column, b: Column) -> Column:
        inner = F.aggregate(
            b["texts"],
            F.struct((acc["at"] + F.length(b["open"])).alias("at"), acc["spans"].alias("spans")),
            lambda a, t: F.struct(
                (a["at"] + F.length(t) + len(NEXT)).alias("at"),
                F.when(b["loss"], F.array_append(a["spans"], F.struct(a["at"].alias("start"), F.length(t).cast("long").alias("length")))).otherwise(a["spans"]).alias("spans"),
            ),
        )
        return F.struct((inner["at"] - len(NEXT) + F.length(b["close"])).alias("at"), inner["spans"].alias("spans"))

    return written.select(
        F.col("__conv").alias(conv),
        F.concat(F.lit(START), F.array_join(F.transform("blocks", lambda b: F.concat(b["open"], F.array_join(b["texts"], NEXT), b["close"])), "")).alias("formatted"),
        F.aggregate("blocks", zero, put, lambda a: a["spans"]).alias("loss"),
    )


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns, loss_text, formatted) parsed from the output of format_conversations() alone."""

    def parse(block: Column) -> Column:
        kind = F.regexp_extract(block, r"^\[(\w+)\]", 1)
        name = F.when(kind == "SYS", "system").when(kind == "INST", "user").when(kind == "BOT", "assistant")
        name = name.otherwise(unescape(F.regexp_extract(block, r"(?s)^\[ROLE\](.*?)\[TEXT\]", 1)))
        inner = F.regexp_replace(block, r"^(?:\[ROLE\](?s:.*?)\[TEXT\]|\[\w+\])|(?:\[/\w+\]|</s>)\z", "")
        return F.transform(F.split(inner, r"\[NEXT\]", -1), lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))

    body = F.substring("formatted", len(START) + 1, 2**31 - 1)
    blocks = F.filter(F.split(body, _OPENS), lambda b: b != "")
    return formatted.select(
        conv,
        F.flatten(F.transform(blocks, parse)).alias("turns"),
        F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "").alias("loss_text"),
        "formatted",
    )
