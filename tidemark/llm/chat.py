"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are merged by slices of
that array; markers and escaped texts are concatenated. Places in the output are running sums of a window on the same
shuffle, so the work is in proportion to the turns. Control strings inside texts are escaped, so the output can
be read back exactly. A merged turn keeps its parts apart by a marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that steer a model or this template; none of them is left in an escaped text. None overlaps itself.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
LOSS_ROLE = "assistant"
#: Code points of a page in which a formatted conversation is read back.
PAGE = 4096


def escaped(text: Column) -> Column:
    """A backslash doubles itself and breaks each control string behind its first character."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row for each conversation: ``conv_id, formatted, loss_spans``.

    Rows of a conversation are taken by ``turn``, then role and text; a null turn comes first. Null roles and texts
    count as empty; rows with a null ``conv_id`` are one conversation. Repeated rows are turns of their own. An
    empty table gives an empty result; other columns are unread. A conversation is one row of the result, so its
    turns meet in one task.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    number = lambda c: F.col(c).cast("long").alias(c)
    rows = conversations.select(number("conv_id"), number("turn"), text("role"), text("text"))
    rows = rows.withColumns({"_role": escaped(F.col("role")), "_text": escaped(F.col("text"))})
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before = F.lag("role").over(order)
    rows = rows.withColumns({"_first": before.isNull(), "_new": before.isNull() | (before != F.col("role"))})
    # what stands in front of a text: the end of the run before and the head of its own, if it begins one
    head = F.when(F.col("_new"), F.length("_role") + len(TURN) + F.when(F.col("_first"), 0).otherwise(len(END))).otherwise(0)
    rows = rows.withColumns({"_n": F.length("_text").cast("long"), "_lead": (head + len(TEXT)).cast("long")})
    start = F.sum(F.col("_lead") + F.col("_n")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    turn = F.struct(
        start.alias("start"), F.col("_n").alias("n"), F.col("_new").alias("new"), F.col("_role").alias("role"), F.col("_text").alias("text"),
        (F.col("role") == LOSS_ROLE).alias("loss"),
    )
    turns = rows.select("conv_id", turn.alias("_turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    starts = F.filter(F.sequence(F.lit(0), F.size("_turns") - 1), lambda k: F.get("_turns", k)["new"])
    runs = turns.select("conv_id", "_turns", starts.alias("_starts"))

    def run(first: Column, k: Column) -> Column:
        """The turns from a run's first one up to the next run's, merged."""
        behind = F.coalesce(F.get("_starts", k + 1), F.size("_turns"))
        own = F.slice("_turns", first + 1, behind - first)
        texts = F.array_join(F.transform(own, lambda t: F.concat(F.lit(TEXT), t["text"])), "")
        return F.concat(F.lit(TURN), F.get("_turns", first)["role"], texts, F.lit(END))

    spans = F.transform(
        F.filter("_turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].cast("int").alias("start"), (t["start"] + t["n"]).cast("int").alias("end"))
    )
    return runs.select("conv_id", F.array_join(F.transform("_starts", run), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as structs of ``role`` and ``text``."""
    pattern = lambda marker: marker.replace("|", r"\|")
    blocks = F.split(formatted, pattern(END), -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        parts = F.split(block, pattern(TEXT), -1)
        role = unescaped(F.substr(F.element_at(parts, 1), F.lit(len(TURN) + 1)))
        texts = F.slice(parts, F.lit(2), F.size(parts) - 1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def chat_digests(chats: DataFrame) -> DataFrame:
    """What is read back from ``format_chats``: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    # a place in a long string is found by counting from its beginning, so it is read in pages
    pages = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))
    paged = chats.select("conv_id", "formatted", "loss_spans", pages.alias("_pages"))

    def under(span: Column) -> Column:
        one, last = F.floor(span["start"] / PAGE).cast("int"), F.floor(F.greatest(span["end"] - 1, span["start"]) / PAGE).cast("int")
        near = F.when(one == last, F.get("_pages", one)).otherwise(F.array_join(F.slice("_pages", one + 1, last - one + 1), ""))
        return unescaped(F.substr(near, span["start"] % PAGE + 1, span["end"] - span["start"]))

    loss = F.array_join(F.transform("loss_spans", under), "")
    read = paged.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("_turns"), loss.alias("_loss"))
    line = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(line, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
