"""Chat formatting with quotation linking.

A line's quote level is the number of ``>`` marks it begins with. A passage is a
run of lines of one level, blank ones apart, as words in lower case: where its
lines break does not matter, so a quote wrapped anew is still found. Its keys are
the hashes of its windows of five words, or of all its words if they are fewer.
The keys of quoted passages are joined to those of unquoted ones (where short
single lines are keys too) of earlier messages of the conversation; each takes
the latest message that holds it. A message replies to the message that holds
most keys of its quotes of the lowest level with any match, the later one on a
tie; if nothing matches, to the message of the turn before, if there is one.
Depths follow by pointer doubling, and sorting a conversation by (depth, turn)
puts every message after the one it replies to.

The result has one row a message, never one a conversation: its text without
quoted lines and as a chat turn, so a conversation of any length is no large
row. Work is spread by (conversation, key) and (conversation, turn).

Null texts stay null and quote nothing. Rows of one (conv_id, turn) count as
one message for links and each keep their own text. Rows with a null conv_id or
turn reply to nothing, at depth 0. Other columns stay, but for those named like
an added one (reply_to, depth, n_quoted, chat), which the added one replaces. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablezones.llm.staging import staged

MARKS = r"^[ \t]*(?:>[ \t]*)*"


#: Words of a window.
WINDOW = 5
ADDED = ("reply_to", "depth", "n_quoted", "chat")


def _key(words):
    return F.unhex(F.md5(words))


def _passages(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``level`` and the normalised ``lines`` of each passage."""

    def parsed(line):
        plain = F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[ \t]+", " ")))
        return F.struct(F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", "")).alias("level"), plain.alias("plain"))

    every = messages.select("conv_id", "turn", F.filter(F.transform(F.split("text", "\n"), parsed), lambda x: x["plain"] != "").alias("every")).where("size(every) > 0")
    level = lambda i: F.get("every", i)["level"]
    starts = every.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size("every") - 1), lambda i: (i == 0) | (level(i) != level(i - 1))))
    until = lambda j: F.coalesce(F.get("starts", j + 1), F.size("every"))
    block = lambda s, j: F.struct(level(s).alias("level"), F.transform(F.slice("every", s + 1, until(j) - s), lambda x: x["plain"]).alias("lines"))
    return starts.select("conv_id", "turn", F.inline(F.transform("starts", block)))


def _keys(passages: DataFrame, short_lines: bool = False) -> DataFrame:
    """The distinct keys of each message's passages, with ``short_lines`` those of its short lines too."""
    words = passages.withColumn("words", F.split(F.array_join("lines", " "), " "))
    windows = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - WINDOW, F.lit(0))), lambda i: _key(F.array_join(F.slice("words", i + 1, WINDOW), " ")))
    if short_lines:
        short = F.filter("lines", lambda x: F.size(F.split(x, " ")) < WINDOW)
        windows = F.concat(windows, F.transform(short, _key))
    return words.select("conv_id", "turn", "level", F.explode(windows).alias("passage")).distinct()


def reply_links(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn`` and ``reply_to`` of the messages whose quotes were found."""
    messages = messages.where("text IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", "text")
    quoted = staged(_keys(_passages(messages.where("text LIKE '%>%'")).where("level > 0")), "quoted")
    # Only conversations that quote at all are searched for originals.
    quoting = staged(quoted.select("conv_id").distinct(), "quoting")
    own = _keys(_passages(messages.join(quoting, "conv_id", "left_semi")).where("level = 0"), short_lines=True).drop("level")
    own = own.join(quoted.select("conv_id", "passage").distinct(), ["conv_id", "passage"], "left_semi")
    events = own.select("conv_id", "turn", "passage", F.lit(0).alias("level")).unionByName(quoted.select("conv_id", "turn", "passage", "level"))
    earlier = Window.partitionBy("conv_id", "passage").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = events.withColumn("origin", F.max(F.when(F.col("level") == 0, F.col("turn"))).over(earlier)).where("level > 0 AND origin IS NOT NULL")
    votes = found.groupBy("conv_id", "turn", "level", "origin").agg(F.count("*").alias("hits"))
    best = votes.groupBy("conv_id", "turn").agg(F.min(F.struct("level", (-F.col("hits")).alias("hits"), (-F.col("origin")).alias("origin"))).alias("best"))
    return best.select("conv_id", "turn", (-F.col("best.origin")).alias("reply_to"))


def _depths(parents: DataFrame) -> DataFrame:
    """Each message's distance from the start of its thread, by pointer doubling.

    A step moves only the messages that have not reached the start, so short
    threads cost little beside one long one."""
    start = F.when(F.col("reply_to").isNull(), 0).otherwise(1).cast("long")
    at = parents.select("conv_id", "turn", F.col("reply_to").alias("up"), start.alias("depth"))
    settled, moving = at.where("up IS NULL"), at.where("up IS NOT NULL")
    while not moving.isEmpty():
        over = settled.unionAll(moving).select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        moved = moving.join(over, ["conv_id", "up"]).select("conv_id", "turn", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        moved = staged(moved, "depths")
        settled, moving = settled.unionAll(moved.where("up IS NULL")), moved.where("up IS NOT NULL")
    return settled.select("conv_id", "turn", "depth")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Every message with reply_to, depth, n_quoted, its unquoted ``text`` and its ``chat`` turn."""
    messages = messages.drop(*ADDED).withColumns({"conv_id": F.col("conv_id").cast("long"), "turn": F.col("turn").cast("long")})
    keys = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    before = keys.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("before"))
    parents = keys.join(before, ["conv_id", "turn"], "left").join(reply_links(messages), ["conv_id", "turn"], "left")
    parents = staged(parents.select("conv_id", "turn", F.coalesce("reply_to", "before").alias("reply_to")), "replies")
    placed = parents.join(_depths(parents), ["conv_id", "turn"])
    lines = F.split("text", "\n")
    own = F.filter(lines, lambda x: ~F.regexp_extract(x, MARKS, 0).contains(">"))
    out = messages.join(placed, ["conv_id", "turn"], "left").withColumn("n_quoted", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines) - F.size(own)).cast("long"))
    text = F.when(F.col("n_quoted") == 0, F.col("text")).otherwise(F.trim(F.array_join(own, "\n")))
    out = out.withColumn("text", text).withColumn("depth", F.coalesce("depth", F.lit(0)).cast("long"))
    return out.withColumn("chat", F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n")))
