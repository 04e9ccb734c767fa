"""Preference formatting: pairs of a chosen and a rejected conversation as prompt and completions.

The longest common turn prefix of the two conversations, turns being equal in role and text,
is rendered once as prompt. What follows it is each side's completion, with a mask of the same
number of segments: 1 for text to be learned (what the assistant says), 0 for the rest
(headers and the other roles).

Turns are ordered by ``turn``; equal numbers by role and text. Null roles and texts render as
empty and equal each other. Turns without a conversation are left out; turns without a number
come first. A pair with a missing side has an empty completion there. Repeated rows are turns
like any other. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED_ROLE = "assistant"


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the ordered turns of each conversation."""
    text = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return (
        conversations.where("conv_id is not null")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(text)).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )


def _render(turns: Column) -> Column:
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n"))), ""
    )


def _segments(turns: Column) -> Column:
    """Two segments per turn: its header, and its text."""
    pairs = F.transform(
        turns,
        lambda t: F.array(F.concat(F.lit("<|"), t["role"], F.lit("|>\n")), F.concat(t["text"], F.lit("\n"))),
    )
    return F.flatten(pairs)


def _mask(turns: Column) -> Column:
    return F.flatten(
        F.transform(turns, lambda t: F.array(F.lit(0), F.when(t["role"] == LEARNED_ROLE, 1).otherwise(0)))
    )


def preference_pairs(conversations: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """One row per pair: its prompt, and both completions as segments with masks.

    ``pair`` numbers the pairs by ``conv_id``, and ``chosen`` is true for the preferred side. A
    pair has one conversation of each side; of more, the least number counts.
    """
    sides = _turns(conversations).select(pair.alias("pair_id"), chosen.alias("_chosen"), "conv_id", "turns")
    least = lambda wanted: F.min(F.when(F.col("_chosen") == wanted, F.struct("conv_id", "turns")))
    both = sides.groupBy("pair_id").agg(least(True).alias("yes"), least(False).alias("no"))
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = both.select(
        "pair_id",
        F.col("yes.conv_id").alias("chosen_id"),
        F.col("no.conv_id").alias("rejected_id"),
        F.coalesce("yes.turns", none).alias("yes"),
        F.coalesce("no.turns", none).alias("no"),
    )
    equal = F.transform(F.arrays_zip(F.col("yes").alias("a"), F.col("no").alias("b")), lambda t: t["a"].eqNullSafe(t["b"]))
    shorter = F.least(F.size("yes"), F.size("no"))
    differs = F.array_position(F.slice(equal, F.lit(1), shorter), False).cast("int")
    both = both.withColumn("shared", F.when(differs > 0, differs - 1).otherwise(shorter))
    rest = {side: F.slice(side, F.col("shared") + 1, F.size(side)) for side in ("yes", "no")}
    both = both.withColumns({"_yes": rest["yes"], "_no": rest["no"]})
    return both.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.col("shared").cast("bigint").alias("prompt_turns"),
        _render(F.slice("yes", F.lit(1), F.col("shared"))).alias("prompt"),
        _segments(F.col("_yes")).alias("chosen"),
        _mask(F.col("_yes")).alias("chosen_mask"),
        _segments(F.col("_no")).alias("rejected"),
        _mask(F.col("_no")).alias("rejected_mask"),
    )
