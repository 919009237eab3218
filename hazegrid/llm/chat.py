"""Conversations rebuilt from event logs and rendered for training, in native expressions.

An event belongs to a conversation, a message (an integer that orders the messages) and a place in the log (seq):

* `message` gives a whole text and begins a message; a repeated one under the same number is a message of its own
* `delta` adds its text, as a streamed answer comes in
* `edit` replaces the text so far
* `regenerate` drops the text so far; what follows builds it anew

Events are sorted by seq, then kind, role and text, so equal places have one outcome. Null text is empty. The role is
the last one given, empty if none is. A message whose events are all null is an empty message.

A turn is rendered as OPEN role newline text CLOSE newline. Inside roles and texts a backslash is doubled and every
control string gets a backslash after its first character, so none is left, and dropping one backslash of each escape
gives the text back. In a role a line end is escaped as well.

A conversation becomes one row, as its text is one string. Before that its messages are folded apart, and joined in
blocks of BLOCK messages, so a conversation of very many turns isn't sorted row by row in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Messages joined at once before a conversation's blocks are.
BLOCK = 64
#: Marks of a turn; further control strings of common templates.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ROLE = "assistant"
#: All control strings, as patterns: where a backslash goes in.
_CONTROL = r"<(?=\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>)|\[(?=INST\]|/INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, said array<struct<role, text>>) from events (conv_id, message, seq, kind, role, text)."""
    log = F.array_sort(F.collect_list(F.struct("seq", "kind", "role", "text")))
    grouped = events.groupBy("conv_id", "message").agg(log.alias("log"))

    def final(part: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(part))
        reset = F.coalesce(F.array_max(F.filter(at, lambda k: F.coalesce(F.element_at(part, k)["kind"], F.lit("")).isin("message", "edit", "regenerate"))), F.lit(1))
        roles = F.filter(F.transform(part, lambda e: e["role"]), lambda r: r.isNotNull())
        text = F.array_join(F.transform(F.slice(part, reset, F.size(part)), lambda e: F.coalesce(e["text"], F.lit(""))), "")
        return F.struct(F.coalesce(F.get(roles, F.size(roles) - 1), F.lit("")).alias("role"), text.alias("text"))

    # A message begins at its first event and at each further `message` event.
    begins = F.filter(F.sequence(F.lit(1), F.size("log")), lambda k: (k == 1) | (F.coalesce(F.element_at("log", k)["kind"], F.lit("")) == "message"))
    ends = F.concat(F.slice("begins", 2, F.size("begins")), F.array(F.size("log") + 1))
    parts = F.zip_with("begins", "ends", lambda a, b: F.slice("log", a, b - a))
    return grouped.withColumn("begins", begins).withColumn("ends", ends) \
        .select("conv_id", "message", F.transform(parts, final).alias("said"))


def rendered(events: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, formatted, and its parts array<struct<text, loss>> in order, loss for what an assistant says."""
    role, text = escaped(F.col("one.role")), escaped(F.col("one.text"))
    role = F.replace(role, F.lit("\n"), F.lit("\\\n"))
    part = lambda value, loss: F.struct(value.alias("text"), loss.alias("loss"))
    turns = messages(events).select("conv_id", "message", F.posexplode("said").alias("place", "one")).select(
        "conv_id", "message", "place", F.array(
            part(F.concat(F.lit(OPEN), role, F.lit("\n")), F.lit(False)),
            part(text, F.col("one.role") == ROLE),
            part(F.lit(CLOSE + "\n"), F.lit(False))).alias("parts"))

    def joined(items: Column) -> Column:
        return F.flatten(F.transform(F.array_sort(items), lambda x: x["parts"]))

    blocks = turns.groupBy("conv_id", F.floor(F.col("message") / BLOCK).alias("block")) \
        .agg(joined(F.collect_list(F.struct("message", "place", "parts"))).alias("parts"))
    whole = blocks.groupBy("conv_id").agg(joined(F.collect_list(F.struct("block", "parts"))).alias("parts"))
    return whole.select("conv_id", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"), "parts")


def read_back(formatted: Column) -> Column:
    """The turns array<struct<role, text>> of a rendered conversation."""
    turns = F.split(formatted, r"<\|im_start\|>", -1)
    turns = F.slice(turns, 2, F.greatest(F.size(turns) - 1, F.lit(0)))

    def turn(one: Column) -> Column:
        role = F.regexp_extract(one, r"(?s)^((?:[^\\\n]++|\\.)*+)\n", 1)
        size = F.length(one) - F.length(role) - 1 - len(CLOSE + "\n")
        return F.struct(unescaped(role).alias("role"), unescaped(F.substring(one, F.length(role) + 2, size)).alias("text"))

    return F.transform(turns, turn)


def learned(parts: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["loss"]), lambda p: unescaped(p["text"])), "")
