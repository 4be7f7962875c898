"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted, merged where neighbours have the same
role, and concatenated to one training string. A second output says which pieces carry loss.
Control strings inside roles and texts are escaped reversibly, so that the string can be read back.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks of the template; `reserved` are further control strings that no text may form."""

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    also: str = "<|also|>"
    end: str = "</s>"
    loss_role: str = "assistant"
    reserved: tuple[str, ...] = ("<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.turn, self.text, self.also, self.end, *self.reserved)


DEFAULT = Template()


def escape(col: Column, template: Template = DEFAULT) -> Column:
    r"""A backslash is doubled, and one is put after the first character of each control string."""
    firsts = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in template.controls)
    return F.regexp_replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), firsts, r"\\")


def unescape(col: Column) -> Column:
    return F.regexp_replace(col, r"(?s)\\(.)", "$1")


def format_conversations(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """(conv_id, turn, role, text) -> (conv_id, formatted, segments).

    `segments` is an array of (text, loss) whose texts concatenate to `formatted`; loss is true for
    the escaped texts of the loss role. Turns are ordered by (turn, role, text), nulls first, so ties
    and repeated rows have one order and all stay. A null role or text counts as empty, rows with a
    null conv_id form one conversation, an empty table gives no rows, further columns are ignored.
    """
    rows = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    ordered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ordered"))  # by the texts as they are, not as they are escaped
    turns = ordered.select("conv_id", F.transform("ordered", lambda t: F.struct(escape(t["role"], template).alias("role"), escape(t["text"], template).alias("text")))
        .alias("turns"))

    def piece(x: Column, i: Column) -> Column:
        """A turn opens a block unless its neighbour before has its role, and closes it likewise."""
        before, after = F.get("turns", i - 1)["role"], F.get("turns", i + 1)["role"]
        head = F.when(before.eqNullSafe(x["role"]), F.lit(template.also)).otherwise(F.concat(F.lit(template.turn), x["role"], F.lit(template.text)))
        tail = F.when(after.eqNullSafe(x["role"]), F.lit("")).otherwise(F.lit(template.end))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(x["text"].alias("text"), (x["role"] == template.loss_role).alias("loss")),
            F.struct(tail.alias("text"), F.lit(False).alias("loss")),
        )

    merged = turns.select("conv_id", F.filter(F.flatten(F.transform("turns", piece)), lambda s: s["text"] != "").alias("segments"))
    return merged.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_back(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns (role, text) inside a formatted string, one for each input row, merged ones apart again."""
    blocks = F.filter(F.split(formatted, re.escape(template.end)), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(F.replace(block, F.lit(template.turn), F.lit("")), template.text, 1)
        texts = F.split(F.substring_index(block, template.text, -1), re.escape(template.also))
        return F.transform(texts, lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digest(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Counts and hashes read back from the output of format_conversations."""
    read = formatted.select("conv_id", "formatted", read_back(F.col("formatted"), template).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
