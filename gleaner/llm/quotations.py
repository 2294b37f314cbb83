"""Quotation linking: replies are ordered by the messages they quote, and the quotes removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from ..session import cut_lineage

# a line's quote marks, however they are spaced; \G goes on where the last mark ended
MARKS = r"(?md)(?:^|\G)[ \t]*>"
PASSAGE = r"(?md)^(>+)(?!>)[^\n]*+(?:\n\1(?!>)[^\n]*+)*+"


def with_plain_marks(text: Column) -> Column:
    """``> > a`` and ``>>a`` alike: quote marks in front of a line without white space between them."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), MARKS, ">")


def passages(marked: Column) -> Column:
    """The quoted passages of a text with plain marks: runs of lines of one quote level, in order."""
    return F.regexp_extract_all(marked, F.lit(PASSAGE), F.lit(0))


def level_of(passage: Column) -> Column:
    return F.length(F.regexp_extract(passage, "^>+", 0))


def normalised(text: Column) -> Column:
    """Lower-cased, quote marks gone, white space as single spaces."""
    bare = F.regexp_replace(text, r"(?md)^>+ ?", "")
    return F.trim(F.regexp_replace(F.lower(bare), r"\s+", " "))


def own_text(marked: Column) -> Column:
    """The lines without quote marks; blank lines at either end go."""
    unquoted = F.regexp_replace(marked, r"(?md)^>[^\n]*\n?", "")
    return F.regexp_replace(unquoted, r"^\s+|\s+$", "")


def quote(text: Column, level: int = 1) -> Column:
    """A text as a mail program quotes it."""
    return F.regexp_replace(text, r"(?md)^", "> " * level)


def _threads(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, thread, depth``: the first message above each one, and the steps to it.

    Every round joins a message with what the message it points at points at, so the distance known
    doubles and a chain of n replies takes log2(n) rounds. A parent is always earlier, so there are no cycles.
    """
    state = cut_lineage(parents.select(
        "conv_id", "turn", F.coalesce("reply_to", "turn").alias("thread"),
        F.when(F.col("reply_to").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("reply_to").isNull().alias("done"),
    ))
    while not state.filter("not done").isEmpty():
        above = state.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"),
                             F.col("depth").alias("more"), F.col("done").alias("ends"))
        ended = state.filter("done")
        moved = state.filter("not done").join(above, ["conv_id", "thread"]).select(
            "conv_id", "turn", F.col("next").alias("thread"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done")
        )
        state = cut_lineage(ended.unionByName(moved))
    return state.drop("done")


def reply_conversations(messages: DataFrame) -> DataFrame:
    """One row per message of ``messages`` (``conv_id``, ``turn``, ``role``, ``text``), in reply order.

    ``conv_id, turn, role, reply_to, thread, depth, reply_order, n_quotes, n_linked, deepest, text, formatted``.
    A quoted passage is a run of lines with the same number of quote marks. Its normalised hash is looked up among the
    messages' own texts and their paragraphs: first earlier in the conversation (the first occurrence), else
    the first occurrence in any other conversation, which counts as linked but gives no parent. ``reply_to`` is the turn that
    the outermost, then first, passage found in the conversation came from; without one a message opens a thread.
    ``reply_order`` (from 0) sorts by thread, depth and turn, so a reply follows what it answers.
    ``text`` has no quotes, ``formatted`` puts the role in front.

    Texts are looked up by their first occurrence only, so a text that a third of all messages share is one
    row on that side; positions come from range partitions, not from a window over a conversation. Rows with a null
    conv_id or turn are left out; of rows with the same conv_id and turn the one with the smallest text
    counts; a null text is empty; an empty passage is not looked up. Other columns are ignored.
    """
    rows = messages.filter("conv_id is not null and turn is not null").groupBy(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")
    ).agg(F.min(F.struct(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("role").cast("string").alias("role"))).alias("m"))
    marked = rows.select("conv_id", "turn", "m.role", with_plain_marks(F.col("m.text")).alias("marked"))
    parsed = cut_lineage(marked.select("conv_id", "turn", "role", own_text(F.col("marked")).alias("text"), passages(F.col("marked")).alias("quotes")))

    units = F.array_distinct(F.concat(F.array(F.col("text")), F.split("text", r"\n[ \t]*\n")))
    said = parsed.select("conv_id", "turn", F.explode(units).alias("unit")).select("conv_id", "turn", normalised(F.col("unit")).alias("unit"))
    said = said.filter("unit != ''").select("conv_id", "turn", F.md5("unit").alias("hash"))
    here = said.groupBy("conv_id", "hash").agg(F.min("turn").alias("first_turn"))
    anywhere = here.groupBy("hash").agg(F.min(F.struct("conv_id", "first_turn")).alias("first"))

    quotes = parsed.select("conv_id", "turn", F.posexplode("quotes").alias("at", "passage"))
    hashed = quotes.select("conv_id", "turn", "at", level_of(F.col("passage")).alias("level"), normalised(F.col("passage")).alias("unit"))
    hashed = hashed.withColumn("hash", F.when(F.col("unit") != "", F.md5("unit"))).drop("unit")
    found = hashed.join(here, ["conv_id", "hash"], "left").join(anywhere, "hash", "left").select(
        "conv_id", "turn", "at", "level",
        F.when(F.col("first_turn") < F.col("turn"), F.col("first_turn")).alias("from_turn"),
        (F.col("first.conv_id") != F.col("conv_id")).alias("elsewhere"),
    )
    summary = found.groupBy("conv_id", "turn").agg(
        F.count("*").alias("n_quotes"),
        F.count_if(F.col("from_turn").isNotNull() | F.coalesce("elsewhere", F.lit(False))).alias("n_linked"),
        F.max("level").alias("deepest"),
        F.min(F.when(F.col("from_turn").isNotNull(), F.struct("level", "at", "from_turn"))).alias("parent"),
    )
    linked = cut_lineage(parsed.drop("quotes").join(summary, ["conv_id", "turn"], "left").withColumn("reply_to", F.col("parent.from_turn")).drop("parent"))
    placed = cut_lineage(linked.join(_threads(linked), ["conv_id", "turn"]))
    ordered = numbered(placed, ["conv_id", "thread", "depth", "turn"], "place")
    starts = ordered.groupBy("conv_id").agg(F.min("place").alias("start"))
    return ordered.join(starts, "conv_id").select(
        "conv_id", "turn", "role", "reply_to", "thread", "depth", (F.col("place") - F.col("start")).alias("reply_order"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.coalesce("deepest", F.lit(0)).alias("deepest"), "text",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), "text", F.lit("\n")).alias("formatted"),
    )
