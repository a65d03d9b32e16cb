"""Preference formatting: chosen and rejected conversations as prompt and completions.

The two conversations of a pair share a prefix of equal turns (role and text).
That longest common prefix is rendered once, as the prompt; what follows on
either side is rendered as its completion, with a mask that says which
characters are to be learned: the text and end mark of the assistant's turns.
Masks are run lengths, "count:flag" joined by commas, over the completion.

Turns are ordered by (turn, role, text); exact repeats of a turn row count once.

Defined cases: a null text is an empty text, a null role an empty role; null
turn numbers come first; rows without a pair id are left out. A side without
turns renders as the empty text. When one side is a prefix of the other, its
completion is empty. Pairs that occur on one side only are kept, with the other
side empty. Empty tables give an empty table; other columns are ignored.

A conversation is one row of the result, so a pair's turns meet in one task:
that group is bounded by the length of a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def turns_of(turns: DataFrame, key: str, name: str) -> DataFrame:
    """pair_id and an ordered array of (role, text)."""
    rows = turns.filter(F.col(key).isNotNull()).select(F.col(key).alias("pair_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = F.array_sort(F.collect_set(F.struct("turn", "role", "text")))
    return rows.groupBy("pair_id").agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE))), "")


def _mask(turns: Column) -> Column:
    """Run lengths: the mark and role of a turn aren't learned; its text and end are, if it is the assistant's."""
    run = lambda t: F.concat((F.length(t["role"]) + F.lit(len(OPEN) + 1)).cast("string"), F.lit(":0,"), (F.length(t["text"]) + F.lit(len(CLOSE))).cast("string"), F.when(t["role"] == "assistant", F.lit(":1")).otherwise(F.lit(":0")))
    return F.array_join(F.transform(turns, run), ",")


def format_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask."""
    both = turns_of(chosen, key, "a").join(turns_of(rejected, key, "b"), "pair_id", "full")
    return render_pairs(both)


def render_pairs(pairs: DataFrame) -> DataFrame:
    """``format_pairs`` from arrays of (role, text) ``a`` and ``b``."""
    none = F.expr("cast(array() as array<struct<role: string, text: string>>)")
    rows = pairs.select("pair_id", F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))
    shorter = F.least(F.size("a"), F.size("b"))
    # the first position where the two differ
    differ = F.expr("filter(sequence(0, least(size(a), size(b))), i -> i < least(size(a), size(b)) and not (get(a, i) <=> get(b, i)))")
    rows = rows.withColumn("n", F.coalesce(F.array_min(differ), shorter))
    rest = lambda c: F.slice(F.col(c), F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    return rows.select(
        "pair_id", F.col("n").cast("bigint").alias("n_prompt_turns"), _render(F.slice("a", F.lit(1), F.col("n"))).alias("prompt"),
        _render(rest("a")).alias("chosen"), _mask(rest("a")).alias("chosen_mask"), _render(rest("b")).alias("rejected"), _mask(rest("b")).alias("rejected_mask"),
    )


def echo_negatives(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs from plain conversations: rejected is the conversation up to its last assistant turn, which then only echoes the turn before it.

    Conversations without an assistant turn are left out, as nothing in them can be preferred.
    """
    rows = turns_of(turns, key, "a")
    rows = rows.withColumn("last", F.expr("array_max(filter(sequence(0, size(a) - 1), i -> a[i].role = 'assistant'))")).filter("last is not null")
    echo = F.expr("named_struct('role', 'assistant', 'text', if(last > 0, get(a, last - 1).text, ''))")
    return rows.select("pair_id", "a", F.concat(F.slice("a", F.lit(1), F.col("last")), F.array(echo)).alias("b"))
