"""Chat formatting: every assistant turn becomes an example with all turns before it as context.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``.  In roles and texts ``<|`` is written
``<||`` (and a line feed of a role ``<|n``), so no text can contain a mark, and reading back is exact.
Only the reply's text is trainable.  A conversation that does not end with an assistant turn gets
one more example without a trainable part, so that no turn is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<|n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|n"), F.lit("\n")))


def rendered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and turns (array of role, text) in order of turn, then role, then text; null turns first."""
    one = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    return conversations.select(F.col(f"`{conv_id}`").alias("conv_id"), one.alias("one")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("one")).alias("turns")  # a conversation has to fit a task, as its examples do
    )


def examples(conversations: DataFrame, **names: str) -> DataFrame:
    """One row per example: conv_id, target (index of the reply, null without one), formatted, loss_start, loss_length.

    loss_start is the 0-based code point in ``formatted`` where the trainable reply starts; loss_length is
    0 without a target.  ``last`` marks the conversation's last example, which holds all its turns.
    Null roles and texts count as empty; rows with one turn number are ordered by role and text;
    repeated rows are turns of their own; rows with a null conv_id are one conversation; an empty
    table gives no examples.
    """
    parts = F.transform(
        "turns",
        lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END)),
    )
    # offset of the end of each turn in the whole rendering
    ends = F.aggregate(
        "parts",
        F.array(F.lit(0).cast("long")),
        lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.char_length(p))),
    )
    targets = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (F.element_at("turns", i)["role"] == "assistant") | (i == F.size("turns")))
    whole = rendered(conversations, **names).withColumn("parts", parts)
    whole = whole.select("conv_id", "turns", F.array_join("parts", "").alias("whole"), ends.alias("ends"))
    rows = whole.select("conv_id", "turns", "whole", "ends", F.explode(targets).alias("i"))
    reply = F.element_at("turns", F.col("i"))
    taught = reply["role"] == "assistant"
    length = F.when(taught, F.char_length(escape(reply["text"])).cast("long")).otherwise(F.lit(0).cast("long"))
    end = F.element_at("ends", F.col("i") + 1)
    return rows.select(
        "conv_id",
        F.when(taught, F.col("i") - 1).alias("target"),
        F.substring("whole", F.lit(1), end.cast("int")).alias("formatted"),
        F.when(taught, end - len(END) - length).otherwise(end).alias("loss_start"),
        length.alias("loss_length"),
        (F.col("i") == F.size("turns")).alias("last"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns (array of role, text) read back from a formatted example."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)

    def read(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        at = F.char_length(role) + 2
        text = F.substring(part, at, F.char_length(part) - at + 1 - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, read)


def loss_of(formatted: Column, start: Column, length: Column) -> Column:
    """The trainable text, unescaped."""
    return unescape(F.substring(formatted, start.cast("int") + 1, length.cast("int")))


def digest(found: DataFrame) -> DataFrame:
    """Per conversation what its examples hold, read back from them."""
    turns = turns_of(F.col("formatted"))
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = found.select(
        "conv_id",
        F.when(F.col("last"), F.size(turns).cast("long")).alias("n_turns"),
        F.when(F.col("last"), F.sha2(lines.cast("binary"), 256)).alias("turns_sha256"),
        F.struct(
            F.col("target").alias("target"), loss_of(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("text")
        ).alias("loss"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    joined = F.array_join(F.transform(F.array_sort("losses"), lambda x: x["text"]), "")
    return (
        read.groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
            F.collect_list(F.when(F.col("loss.target").isNotNull(), F.col("loss"))).alias("losses"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id", "n_turns", "turns_sha256",
            F.char_length(joined).cast("long").alias("loss_chars"),
            F.sha2(joined.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
        )
    )
