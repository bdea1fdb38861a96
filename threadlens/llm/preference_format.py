"""Preference formatting, in DataFrame functions only.

A chosen and a rejected conversation share a prefix of turns (same role and text). It is rendered once
as the prompt; what follows on each side is rendered as a completion with a mask: the spans of characters that
training may learn from, which are the assistant's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|", "|>"


def gathered(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of a conversation in order of turn, then role and text; repeated rows count once.

    Null roles and texts count as empty. A conversation is one row, as its turns are one training example.
    """
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_set(one)).alias("turns"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE + "\n"), t["text"], F.lit("\n"))), "")


def mask(turns: Column) -> Column:
    """``start:end`` of the assistant's texts in the rendered turns (code points, end exclusive), joined by commas."""
    head = len(OPEN) + len(CLOSE) + 1

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["role"]) + head
        stop = start + F.length(t["text"])
        own = F.when(t["role"] == "assistant", F.array(F.concat_ws(":", start, stop))).otherwise(F.array().cast("array<string>"))
        return F.struct((stop + 1).alias("at"), F.concat(state["out"], own).alias("out"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda s: F.array_join(s["out"], ","))


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask).

    One row per row of ``pairs(pair_id, chosen_id, rejected_id)`` whose two conversations exist in
    ``turns(conv_id, turn, role, text)``; equal conversations give empty completions. A conversation may be in many
    pairs. Other columns are ignored.
    """
    talks = gathered(turns)
    sides = pairs.select("pair_id", "chosen_id", "rejected_id")
    sides = sides.join(talks.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("a")), "chosen_id")
    sides = sides.join(talks.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("b")), "rejected_id")
    differs = F.zip_with("a", "b", lambda x, y: ~F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    n = F.when(F.array_position(differs, True) > 0, F.array_position(differs, True) - 1).otherwise(F.size(differs)).cast("int")
    cut = sides.select("pair_id", "chosen_id", "rejected_id", n.alias("n"), "a", "b")
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    return cut.select(
        "pair_id", "chosen_id", "rejected_id", F.col("n").cast("long").alias("n_prompt_turns"), render(F.slice("a", F.lit(1), F.col("n"))).alias("prompt"),
        render(rest("a")).alias("chosen"), mask(rest("a")).alias("chosen_mask"), render(rest("b")).alias("rejected"), mask(rest("b")).alias("rejected_mask"))
