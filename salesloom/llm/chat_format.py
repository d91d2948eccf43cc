"""Chat formatting: training samples of a dialogue from every participant's view.

For each participant the whole dialogue is rendered from that speaker's view: its own turns as
assistant, all others as named users, system turns as system. The mask marks the characters of the
assistant's turns, which alone are learned.

A sample holds ``SEGMENT`` turns; a longer dialogue goes on in further segments, so that no task gathers
a conversation of any length. Places within a conversation come from range partitions of the turns and
counts per partition: a very long conversation is spread over many tasks.

A turn becomes ``<|role|>name: text<|end|>`` and a newline; markers that occur inside a text or a
speaker's name are broken by a zero-width space after their first character, so that they cannot pose as
markers; ``participant`` keeps the name as it is.

Cases: a null text counts as empty; a null speaker is the participant "unknown"; a null turn number
sorts first; turns that share a number are ordered by speaker and text, repeated rows stay repeated
turns; a conversation with system turns only gives no sample; texts are taken whole; a null conv_id is a
conversation of its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.session import stage

SYSTEM = "system"
#: Turns of a sample.
SEGMENT = 512


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, who, text) with ``place``, from 0 within each conversation."""
    keys = ["conv_id", "turn", "who", "text"]
    spread = stage(
        turns.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "turns"
    )
    before = (
        spread.groupBy("conv_id", "part")
        .agg(F.count("*").alias("rows"))
        .withColumn(
            "before",
            F.coalesce(
                F.sum("rows").over(
                    Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .select(F.col("conv_id").alias("of"), F.col("part").alias("of_part"), "before")
    )
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*keys[1:])) - 1
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
    return (
        spread.withColumn("local", local)
        .join(before, same)
        .select(*keys, (F.col("before") + F.col("local")).alias("place"))
    )


def perspectives(turns: DataFrame, speaker: str = "role") -> DataFrame:
    """conv_id, participant, segment, n_turns, n_own_turns, rendered, mask of every view.

    ``speaker`` names the column that tells participants apart. ``mask`` lists the spans start:end of
    the assistant's texts in code points, end exclusive.
    """
    clean = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"<(?=\|)", "<\u200b")
    named = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col(speaker).cast("string"), F.lit("unknown")).alias("who"),
        clean.alias("text"),
    )
    participants = (
        named.filter(F.col("who") != SYSTEM)
        .select(F.col("conv_id").alias("of"), F.col("who").alias("participant"))
        .distinct()
    )
    turn = F.struct("place", "who", "text")
    segments = (
        numbered(named)
        .groupBy("conv_id", F.floor(F.col("place") / SEGMENT).cast("long").alias("segment"))
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    )
    views = segments.join(participants, F.col("conv_id").eqNullSafe(F.col("of")))
    parts = views.withColumn(
        "parts",
        F.expr(
            f"""transform(turns, t -> named_struct(
                'own', t.who = participant,
                'head', CASE WHEN t.who = participant THEN '<|assistant|>'
                             WHEN t.who = '{SYSTEM}' THEN '<|system|>'
                             ELSE concat('<|user|>', replace(t.who, '<|', '<\u200b|'), ': ') END,
                'text', t.text))"""
        ),
    )
    spans = F.expr(
        """aggregate(parts, named_struct('at', 0, 'spans', cast(array() AS array<string>)),
            (a, p) -> named_struct(
                'at', a.at + length(p.head) + length(p.text) + 8,
                'spans', CASE WHEN p.own THEN concat(a.spans, array(concat_ws(':',
                    a.at + length(p.head), a.at + length(p.head) + length(p.text)))) ELSE a.spans END),
            a -> array_join(a.spans, ','))"""
    )
    return parts.select(
        "conv_id",
        "participant",
        "segment",
        F.size("turns").cast("long").alias("n_turns"),
        F.expr("cast(size(filter(parts, p -> p.own)) AS long)").alias("n_own_turns"),
        F.expr("array_join(transform(parts, p -> concat(p.head, p.text, '<|end|>\\n')), '')").alias("rendered"),
        spans.alias("mask"),
    )
