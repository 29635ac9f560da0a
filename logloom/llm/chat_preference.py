"""Preference formatting: shared prompt and paired masked completions.

The longest common turn prefix of a chosen and a rejected conversation is
rendered once as the prompt; what follows in either becomes a completion whose
mask trains on assistant bodies only.

Rows without conv_id belong to no conversation and are left out. Null roles and
texts count as empty. Turns are ordered by (turn, role, text), null turns
first; identical rows of one conversation count once. Extra columns are
dropped. A conversation is one row, as long as its turns together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What surrounds a turn when it is rendered (fixed values).
OPEN, BREAK, CLOSE = "<|", "|>\n", "<|end|>\n"


_TURN = "struct<role:string,text:string>"


def reply_pairs(turns: DataFrame) -> DataFrame:
    """conv_id, chosen, rejected: each conversation, and the same with its last
    reply exchanged for the last reply of its neighbour (ids 2k and 2k + 1 are
    neighbours).

    Turns after the last reply stay on both sides. Without a neighbour's reply the
    rejected reply is empty; a conversation without a reply is its own rejected one.
    Neighbours are gathered together, in one shuffle.
    """
    one = F.struct("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    both = turns.filter(F.col("conv_id").isNotNull()).groupBy(F.shiftright("conv_id", 1).alias("pair")).agg(F.sort_array(F.collect_set(one)).alias("all"))
    ids = F.array_distinct(F.transform("all", lambda t: t["conv_id"]))
    bare = lambda of: F.transform(F.filter("all", of), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    each = both.select("all", F.explode(ids).alias("conv_id"))
    own = each.select("conv_id", bare(lambda t: t["conv_id"] == F.col("conv_id")).alias("turns"), bare(lambda t: (t["conv_id"] != F.col("conv_id")) & (t["role"] == "assistant")).alias("others"))
    last = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: t["role"])), "assistant").cast("int") + 1
    has = F.exists("turns", lambda t: t["role"] == "assistant")
    placed = own.select("conv_id", "turns", F.when(has, last).alias("last"), F.coalesce(F.try_element_at("others", F.lit(-1))["text"], F.lit("")).alias("other"))
    reply = F.array(F.struct(F.lit("assistant").alias("role"), F.col("other").alias("text")).cast(_TURN))
    before = F.slice("turns", F.lit(1), F.col("last") - 1)
    after = F.slice("turns", F.col("last") + 1, F.size("turns"))
    return placed.select("conv_id", F.col("turns").alias("chosen"), F.when(F.col("last").isNotNull(), F.concat(before, reply, after)).otherwise(F.col("turns")).alias("rejected"))


def _segments(turns: Column) -> Column:
    """array<struct<text, train>>: head and body of each turn."""
    return F.flatten(
        F.transform(
            turns,
            lambda t: F.array(
                F.struct(F.concat(F.lit(OPEN), t["role"], F.lit(BREAK)).alias("text"), F.lit(0).alias("train")),
                F.struct(F.concat(t["text"], F.lit(CLOSE)).alias("text"), (t["role"] == "assistant").cast("int").alias("train")),
            ),
        )
    )


def _text(segments: Column | str) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def _mask(segments: Column | str) -> Column:
    """Run lengths in code points, each with 1 where the loss counts."""
    return F.array_join(F.transform(segments, lambda s: F.concat_ws(":", F.length(s["text"]), s["train"])), ",")


def preference_format(pairs: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Render pairs (id, chosen, rejected) as prompt and completions.

    Returns id, n_prompt_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask, trainable. A pair without a difference has empty completions
    and isn't trainable. Null conversations count as empty.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    both = pairs.select(id_col, F.coalesce("chosen", empty).alias("_c"), F.coalesce("rejected", empty).alias("_r"))
    # zip_with pads the shorter one with nulls, so a mere prefix differs at its end.
    first = F.array_position(F.zip_with("_c", "_r", lambda a, b: a.eqNullSafe(b)), False)
    both = both.withColumn("_n", F.when(first > 0, first - 1).otherwise(F.size("_c")).cast("int"))
    rest = lambda c: _segments(F.slice(c, F.col("_n") + 1, F.greatest(F.size(c) - F.col("_n"), F.lit(0))))
    both = both.select(id_col, "_n", _segments(F.slice("_c", F.lit(1), F.col("_n"))).alias("_p"), rest("_c").alias("_cs"), rest("_r").alias("_rs"))
    return both.select(
        id_col,
        F.col("_n").cast("long").alias("n_prompt_turns"),
        _text("_p").alias("prompt"),
        _text("_cs").alias("chosen"),
        _text("_rs").alias("rejected"),
        _mask("_cs").alias("chosen_mask"),
        _mask("_rs").alias("rejected_mask"),
        ((F.size("_cs") > 0) & (F.size("_rs") > 0)).alias("trainable"),
    )
