"""Preference pairs of conversations as one prompt and two masked completions.

DataFrame functions only. Turns of both sides are laid over each other by turn number; a
turn that only one side has ends the common prefix. No turn is numbered by a window and no
two conversations of a pair are joined: it costs a partial aggregation and a join on its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.tables import kept

TRAINED_ROLE = "assistant"
CLOSING = "<|end|>\n"


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def segments(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """Rows ``(pair_id, part, turn, role, body, head, rendered, trained)`` of preference pairs.

    ``turns`` has ``pair_id, chosen (boolean), turn, role, text``. The longest prefix of
    turns equal on both sides is given once, as part ``prompt``; what follows is part
    ``chosen`` or ``rejected``. ``rendered`` is ``head``, the text and a closing mark;
    ``trained`` tells whether the text and mark bear loss: completion turns of ``trained_role``.

    Null role or text equals null and renders as empty; a row repeated on one side counts
    once; two different rows of one turn are both kept, by role and text. Rows without pair
    or turn, or without a side, are no part of a conversation and are left out. A pair with
    only one side has no prompt. No task ever needs all turns of a pair. Marks inside a text
    stay as they are: turns and losses go by the masks and rows, not by marks in the string.
    """
    rows = turns.filter(
        F.col("pair_id").isNotNull() & F.col("turn").isNotNull() & F.col("chosen").isNotNull()
    )
    laid = rows.groupBy("pair_id", "turn", "role", "text").agg(
        F.max("chosen").alias("in_chosen"), F.max(~F.col("chosen")).alias("in_rejected")
    )
    only_one = ~(F.col("in_chosen") & F.col("in_rejected"))
    cuts = laid.filter(only_one).groupBy("pair_id").agg(F.min("turn").alias("cut"))
    split = laid.join(cuts.withColumnRenamed("pair_id", "_pair"), F.col("pair_id") == F.col("_pair"), "left")
    before = F.col("cut").isNull() | (F.col("turn") < F.col("cut"))
    parts = F.when(before, F.array(F.lit("prompt"))).otherwise(
        F.filter(
            F.array(
                F.when(F.col("in_chosen"), F.lit("chosen")),
                F.when(F.col("in_rejected"), F.lit("rejected")),
            ),
            lambda x: x.isNotNull(),
        )
    )
    head = header(F.col("role"))
    body = F.concat(F.coalesce(F.col("text"), F.lit("")), F.lit(CLOSING))
    return split.select(
        "pair_id", F.explode(parts).alias("part"), "turn", "role", F.col("text").alias("body"),
        head.alias("head"),
        F.concat(head, body).alias("rendered"),
        (F.coalesce(F.col("role") == trained_role, F.lit(False)) & ~before).alias("trained"),
    )


def examples(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per pair: ``prompt``, ``chosen`` and ``rejected`` strings with their masks.

    ``chosen_mask`` and ``rejected_mask`` hold a string of ``1`` (bears loss) and ``0`` per
    run: an array of structs ``(trained, n_chars)`` that covers the completion from its
    start; the prompt bears no loss at all. ``prompt_turns`` counts the turns rendered once.
    A side without turns of its own is an empty string with an empty mask. The row is as
    long as the conversation; :func:`segments` gives the same turn by turn.
    """
    turn = F.struct("turn", "role", "body", "head", "rendered", "trained")
    gathered = (
        segments(turns, trained_role)
        .groupBy("pair_id")
        .agg(*[
            F.sort_array(F.collect_list(F.when(F.col("part") == part, turn))).alias(part)
            for part in ("prompt", "chosen", "rejected")
        ])
    )

    def text(part: str) -> Column:
        return F.array_join(F.transform(part, lambda t: t["rendered"]), "")

    def mask(part: str) -> Column:
        def runs(t: Column) -> Column:
            first = F.length(t["head"]).cast("bigint")
            rest = F.length(t["rendered"]).cast("bigint") - first
            return F.array(
                F.struct(F.lit(False).alias("trained"), first.alias("n_chars")),
                F.struct(t["trained"].alias("trained"), rest.alias("n_chars")),
            )

        return F.flatten(F.transform(part, runs))

    return gathered.select(
        "pair_id",
        F.size("prompt").cast("bigint").alias("prompt_turns"),
        text("prompt").alias("prompt"),
        text("chosen").alias("chosen"),
        mask("chosen").alias("chosen_mask"),
        text("rejected").alias("rejected"),
        mask("rejected").alias("rejected_mask"),
    )


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Preference pairs made of ``conversations (conv_id, turn, role, text)``.

    Chosen is the conversation as it is. Rejected is the same with its last turn's text
    taken from the last turn of the next conversation (the next id there is, whatever the
    gap), which answers something else; the last conversation's rejected side just lacks
    that turn. Ids are integers; rows without id or turn are on the chosen side only, where
    :func:`segments` leaves them out. An empty table gives no rows.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    last = (
        rows.filter(F.col("turn").isNotNull())
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "role", "text")).alias("last"))
    )
    ends = last.select(F.col("conv_id").alias("_conv"), F.col("last.turn").alias("_last"))
    follows = _followers(rows.filter(F.col("turn").isNotNull() & F.col("conv_id").isNotNull()))
    answer = last.select(F.col("conv_id").alias("_donor"), F.col("last.text").alias("_text"))
    donors = follows.join(answer, F.col("_next") == F.col("_donor"))
    same = F.col("conv_id") == F.col("_conv")
    with_last = rows.join(ends, same)
    chosen = rows.select(F.col("conv_id").alias("pair_id"), F.lit(True).alias("chosen"), "turn", "role", "text")
    shared = with_last.filter(F.col("turn") < F.col("_last")).select(
        F.col("conv_id").alias("pair_id"), F.lit(False).alias("chosen"), "turn", "role", "text"
    )
    answers = last.join(donors, F.col("conv_id") == F.col("_at")).select(
        F.col("conv_id").alias("pair_id"), F.lit(False).alias("chosen"),
        F.col("last.turn").alias("turn"), F.col("last.role").alias("role"), F.col("_text").alias("text"),
    )
    return chosen.unionByName(shared).unionByName(answers)


def _followers(rows: DataFrame) -> DataFrame:
    """``(_at, _next)``: each ``conv_id`` but the last, and the least greater one.

    Distinct ids are dealt into ranges of about equal size, which are written once; the next
    id is found inside a range, or is the least of the next one. Nothing here can fail on a
    row, so it does not matter where the optimizer puts a filter.
    """
    ids = rows.select(F.col("conv_id").cast("bigint").alias("id")).distinct()
    ranged = kept(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "conversation_ids")
    inside = Window.partitionBy("part").orderBy("id")
    firsts = ranged.groupBy("part").agg(F.min("id").alias("first"))  # a row per range
    edges = firsts.select("part", F.lead("first").over(Window.orderBy("part")).alias("beyond"))
    placed = ranged.withColumn("follows", F.lead("id").over(inside)).join(edges, "part")
    found = placed.select(F.col("id").alias("_at"), F.coalesce("follows", "beyond").alias("_next"))
    return found.filter(F.col("_next").isNotNull())
