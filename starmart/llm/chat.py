"""Preference pairs rendered for training: one prompt, two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Around each turn: <|role|> newline text newline. Only the text of an assistant's turn is trained on.
TRAINED_ROLE = "assistant"


def _escaped(text: Column) -> Column:
    """A backslash after each < before a bar or backslash: no text holds what opens a turn, and each can be had back."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<([|\\])", r"<\\$1")


def _role(role: Column) -> Column:
    return F.regexp_replace(F.coalesce(role, F.lit("")), r"[|\n]", "_")


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def _render(turns: Column) -> Column:
    parts = F.transform(turns, lambda t: F.concat(_head(t["role"]), t["text"], F.lit("\n")))
    return F.array_join(parts, "")


def _mask(turns: Column) -> Column:
    """Character spans [begin, end) of the trained text, in order, empty texts too."""
    empty = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))

    def add(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(_head(t["role"]))
        end = begin + F.length(t["text"])
        span = F.struct(begin.alias("begin"), end.alias("end"))
        spans = F.when(t["role"] == TRAINED_ROLE, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda s: s["spans"])


def swapped_answers(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation, and a variant whose last answer is that of the next one.

    ``turns`` has ``conv_id, turn, role, text``. The last answer is the assistant's row with the
    largest turn (then text), repeated rows of it included; it takes the text of the last answer
    of conversation ``conv_id + 1``, or none if there is no such. Rows without ``conv_id`` take no part; a
    conversation without an answer stays as it is. Two equi-joins on the conversation.
    """
    turns = turns.where("conv_id IS NOT NULL")
    text = F.coalesce("text", F.lit(""))
    answer = F.max(F.struct("turn", text.alias("text")))
    last = turns.where(F.col("role") == TRAINED_ROLE).groupBy("conv_id").agg(answer.alias("_last"))
    # The largest id has no next one; adding would overflow.
    other = last.where(F.col("conv_id") > -(1 << 63)).select(
        (F.col("conv_id").cast("long") - 1).alias("conv_id"), F.col("_last.text").alias("_other")
    )
    both = last.join(other, "conv_id", "left")
    same = (F.col("role") == TRAINED_ROLE) & F.col("turn").eqNullSafe(F.col("_last.turn")) & (text == F.col("_last.text"))
    swapped = F.when(same, F.coalesce("_other", F.lit(""))).otherwise(F.col("text"))
    columns = [swapped.alias(c) if c == "text" else F.col(c) for c in turns.columns]
    return turns, turns.join(both, "conv_id", "left").select(*columns)


def preference_pairs(turns: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """One row per pair of conversations, from one row per turn.

    ``turns`` has ``turn, role, text``; ``pair`` names the pair of a turn's
    conversation (NULL: the turn belongs to none and takes no part) and ``chosen``
    tells whether the conversation is the chosen one (NULL: it is not). NULL role
    and text count as empty. A text that holds ``<|`` is written with ``<\\|``, so
    that it opens no turn (and ``<\\`` with ``<\\\\``, so that it can be read back); bars and line breaks
    of a role become underscores.

    ``prompt`` is the longest common prefix of both lists of turns, rendered once;
    ``chosen``/``rejected`` are the rest of each, ``chosen_mask``/``rejected_mask`` the
    character spans of the assistant's words in them. Where one conversation is
    missing its side has no turns, and the prompt is empty; equal conversations
    are all prompt. Turns are ordered by number, then role and text, so repeated
    numbers have a fixed order; repeated rows are repeated turns.

    One shuffle, by pair; a group is two conversations. All built-in expressions.
    """
    turn = F.struct(
        "turn",
        _role(F.col("role")).alias("role"),
        _escaped(F.col("text")).alias("text"),
    )
    sided = turns.select(pair.alias("pair_id"), F.coalesce(chosen, F.lit(False)).alias("c"), turn.alias("t"))
    both = (
        sided.where("pair_id IS NOT NULL")
        .groupBy("pair_id")
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("c"), F.col("t")))).alias("c"),
            F.sort_array(F.collect_list(F.when(~F.col("c"), F.col("t")))).alias("r"),
        )
    )
    shorter = F.least(F.size("c"), F.size("r"))
    differ = F.filter(
        F.sequence(F.lit(1), shorter),
        lambda i: (F.get("c", i - 1)["role"] != F.get("r", i - 1)["role"])
        | (F.get("c", i - 1)["text"] != F.get("r", i - 1)["text"]),
    )
    # sequence(1, 0) counts down, so no turns on one side must be told apart.
    common = F.when(shorter == 0, 0).otherwise(F.coalesce(F.get(differ, F.lit(0)) - 1, shorter))
    split = both.withColumn("n", common)
    rest = {side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0))) for side in "cr"}
    return split.select(
        "pair_id",
        F.col("n").alias("prompt_turns"),
        _render(F.slice("c", 1, F.col("n"))).alias("prompt"),
        _render(rest["c"]).alias("chosen"),
        _render(rest["r"]).alias("rejected"),
        _mask(rest["c"]).alias("chosen_mask"),
        _mask(rest["r"]).alias("rejected_mask"),
    )
