"""Preference pairs of conversations as one prompt and two masked completions.

The longest common prefix of turns of the chosen and the rejected conversation is rendered once, as
the prompt. What follows is rendered for each side, with the spans of characters that count in a loss:
the texts of assistant turns and the mark that ends them. All steps are DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_TURNS = "array<struct<role:string,text:string>>"


def turns_of(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and ``turns`` (role, text) in the order of ``turn``.

    Rows without conversation are left out. Turns of equal number are ordered by role and text, a
    NULL number comes first, and a NULL role or text is empty. A conversation is one row, as it has
    to become one text.
    """
    fields = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = F.transform(
        F.sort_array(F.collect_list(fields)),
        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")),
    )
    return (
        conversations.where("conv_id IS NOT NULL").groupBy("conv_id").agg(turns.alias("turns"))
    )


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that two arrays share."""
    places = F.sequence(F.lit(0), F.least(F.size(a), F.size(b)))
    return F.aggregate(
        places,
        F.lit(0),
        lambda n, i: F.when((i == n) & (F.get(a, i) == F.get(b, i)), n + 1).otherwise(n),
    )


def render(turns: Column) -> Column:
    """Turns as text: an opening mark and the role, a line break, the text, a closing mark."""
    parts = F.transform(
        turns,
        lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE + "\n")),
    )
    return F.array_join(parts, "")


def loss_spans(turns: Column) -> Column:
    """Spans [start, end) of characters of ``render(turns)`` that the assistant has to produce."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + len(OPEN) + F.length(turn["role"]) + 1
        end = start + F.length(turn["text"]) + len(CLOSE)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], span)).otherwise(
            state["spans"]
        )
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, empty, step, lambda s: s["spans"])


_RESULTS = ("n_common", "prompt", "chosen", "rejected", "chosen_spans", "rejected_spans")


def format_preferences(pairs: DataFrame) -> DataFrame:
    """Columns ``n_common``, ``prompt``, ``chosen``, ``rejected``, ``chosen_spans`` and
    ``rejected_spans`` in place of the arrays of turns ``chosen`` and ``rejected``.

    Other columns are kept, but for those named like a result (``prompt``, say; upper and lower case
    are one): the result takes their place. A column must be left that names the pairs. Two equal conversations leave empty completions; if nothing is shared the
    prompt is empty. A NULL array counts as no turns. A role or text in a turn that is NULL counts as
    empty. Repeated pairs are kept, and an empty table gives no rows.
    """

    def plain(name: str) -> Column:
        turns = F.coalesce(F.col(name).cast(_TURNS), F.array().cast(_TURNS))
        filled = F.filter(turns, lambda t: t.isNotNull())
        return F.transform(
            filled,
            lambda t: F.struct(
                F.coalesce(t["role"], F.lit("")).alias("role"),
                F.coalesce(t["text"], F.lit("")).alias("text"),
            ),
        )

    others = [c for c in pairs.columns if c.lower() not in _RESULTS]
    if not others:
        raise ValueError("pairs need a column that names them")
    n = F.col("_n")
    rest = lambda name: F.slice(F.col(name), n + 1, F.greatest(F.size(F.col(name)), F.lit(1)))
    kept = [F.col(f"`{c.replace('`', '``')}`") for c in others]
    return (
        pairs.select(F.struct(*kept).alias("_others"), plain("chosen").alias("_chosen"), plain("rejected").alias("_rejected"))
        .withColumn("_n", common_prefix(F.col("_chosen"), F.col("_rejected")))
        .select(
            "_others.*",
            n.cast("long").alias("n_common"),
            render(F.slice(F.col("_chosen"), F.lit(1), n)).alias("prompt"),
            render(rest("_chosen")).alias("chosen"),
            render(rest("_rejected")).alias("rejected"),
            loss_spans(rest("_chosen")).alias("chosen_spans"),
            loss_spans(rest("_rejected")).alias("rejected_spans"),
        )
    )


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Preference pairs from conversations alone: ``conv_id``, ``chosen``, ``rejected``.

    Chosen is a conversation up to its last assistant turn. Rejected is the same with that turn
    replaced by the last assistant turn of its neighbour (ids 2k and 2k + 1 are neighbours), or
    without it where the neighbour has none. Conversations without assistant turn give no pair. Ids
    are whole numbers; of replies with equal turn numbers the one of the largest text counts.
    """
    convs = turns_of(conversations)
    replies = F.filter(
        F.transform(F.col("turns"), lambda t, i: F.when(t["role"] == "assistant", i)),
        lambda i: i.isNotNull(),
    )
    last = convs.select(
        "conv_id", "turns", F.try_element_at(replies, F.lit(-1)).alias("_last")
    ).where("_last IS NOT NULL")
    # Found apart from the turns: each task sends one reply per conversation, not all texts again.
    reply = (
        conversations.where("conv_id IS NOT NULL AND role = 'assistant'")
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("_best"))
        .select(
            F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"),
            F.array(F.struct(F.lit("assistant").alias("role"), F.col("_best.text").alias("text")))
            .cast(_TURNS)
            .alias("_reply"),
        )
    )
    nothing = F.array().cast(_TURNS)
    return last.join(reply, "conv_id", "left").select(
        "conv_id",
        F.slice("turns", F.lit(1), F.col("_last") + 1).alias("chosen"),
        F.concat(
            F.slice("turns", F.lit(1), F.col("_last")), F.coalesce(F.col("_reply"), nothing)
        ).alias("rejected"),
    )
