"""Preference pairs for chat models: prompt and two masked completions.

A pair has a chosen and a rejected conversation. The turns they begin with alike, the longest common
prefix, are rendered once as the prompt; what follows in each is a completion. Only the words of the
assistant are trained on: each completion lists the characters of its assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def render(turn: Column) -> Column:
    """A turn as text: its role in a mark of its own, and its text. Null roles show as ``unknown``."""
    return F.concat(_head(turn), F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("unknown")), F.lit("|>\n"))


def _text(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, render))


def _trained(turns: Column) -> Column:
    """``(begin, end)`` of the assistant's texts, with the mark that ends each, in the rendered turns."""
    size = lambda turn: F.length(render(turn))
    step = lambda state, turn: F.struct(
        (state["at"] + size(turn)).alias("at"),
        F.when(turn["role"] == ASSISTANT, F.concat(state["spans"], F.array(F.struct(
            (state["at"] + F.length(_head(turn))).alias("begin"), (state["at"] + size(turn)).alias("end"))))).otherwise(state["spans"]).alias("spans"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))
    return F.aggregate(turns, start, step, lambda state: state["spans"])


def conversations(turns: DataFrame, key: str, name: str) -> DataFrame:
    """``(key, name)``: the turns ``(turn, role, text)`` of each conversation in order. Rows that repeat a
    turn in all of it count once; turns of one number are ordered by role and text, null numbers last."""
    turn = F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "text")
    return turns.where(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(turn)).alias(name))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``(pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans)`` for each row of
    ``pairs(pair_id, chosen_turns, rejected_turns)``, arrays of turns with ``role`` and ``text``.

    Turns are alike if role and text are equal or both null. If one conversation begins with all of the
    other, the other's completion is empty; alike conversations have two empty ones. An array that is
    null is empty. A conversation is one training example and so one row; it never meets another.
    """
    turn = "array<struct<role:string,text:string>>"
    plain = lambda name: F.coalesce(F.transform(name, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))), F.array().cast(turn))
    pairs = pairs.select("pair_id", plain("chosen_turns").alias("c"), plain("rejected_turns").alias("r"))
    n = F.least(F.size("c"), F.size("r"))
    alike = F.zip_with(F.slice("c", 1, n), F.slice("r", 1, n), lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    differ = F.array_position(alike, F.lit(False)).cast("int")
    pairs = pairs.withColumn("n", F.when(differ > 0, differ - 1).otherwise(n))
    rest = lambda name: F.slice(F.col(name), F.col("n") + 1, F.greatest(F.size(name) - F.col("n"), F.lit(0)))
    return pairs.select(
        "pair_id", F.col("n").alias("n_prompt_turns"), _text(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _text(rest("c")).alias("chosen"), _text(rest("r")).alias("rejected"),
        _trained(rest("c")).alias("chosen_spans"), _trained(rest("r")).alias("rejected_spans"))


def sibling_pairs(turns: DataFrame) -> DataFrame:
    """Pairs from conversations without ratings, as ``(pair_id, chosen_turns, rejected_turns)``.

    The chosen conversation is the real one. The rejected one has, in place of the last answer, the last
    answer that its sibling got, an answer to another question; siblings are the ids 2n and 2n + 1. If
    there is no sibling, or none with an answer, the rejected one has no last answer; a conversation
    without answers is its own rejected one. Every conversation with an id gives one pair.
    """
    whole = conversations(turns, "conv_id", "turns")
    answers = lambda state, x: F.when(x["role"] == ASSISTANT, x).otherwise(state)
    kind = whole.schema["turns"].dataType.elementType.simpleString()
    whole = whole.withColumn("answer", F.aggregate("turns", F.lit(None).cast(kind), answers))
    place = F.array_position("turns", F.col("answer")).cast("int")
    sibling = whole.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("answer").alias("other"))
    joined = whole.join(sibling, "conv_id", "left").withColumn("place", F.coalesce(place, F.lit(0)))
    swapped = F.when(F.col("other").isNull(), F.array().cast(f"array<{kind}>")).otherwise(F.array(F.struct(
        F.col("answer.last").alias("last"), F.col("answer.turn").alias("turn"), F.col("answer.role").alias("role"), F.col("other.text").alias("text"))))
    before = F.slice("turns", F.lit(1), F.greatest(F.col("place") - 1, F.lit(0)))
    after = F.slice("turns", F.col("place") + 1, F.size("turns"))
    rejected = F.when(F.col("place") == 0, F.col("turns")).otherwise(F.concat(before, swapped, after))
    return joined.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen_turns"), rejected.alias("rejected_turns"))
