"""Multi-party perspective rotation of dialogues.

Every speaker other than the system is once the assistant while the others are named users. The result
is one row per segment, with its place in the rendered dialogue, so that a dialogue of any length is
spread over many rows and tasks; `dialogues` joins those of dialogues that fit a row. Offsets come from
sums over spans of turns and then within a span, never from one window over a whole conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def segments(turns: DataFrame) -> DataFrame:
    """(conv_id, participant, turn, speaker, segment, start, mask_start, mask_end) for each participant and turn.

    start: code points before the segment; the mask (end exclusive, both null if there is nothing to learn)
    covers the assistant's words and closing mark. Turns go in order of turn, then role, then text; a null
    turn goes last, a null role is "unknown", a null text is empty, rows of a null conv_id belong to no
    dialogue and are left out. Repeated rows are repeated segments. "<|" in a text or a role is written
    "< |", and line ends in a role are spaces, so that neither can forge a mark. Extra columns are left
    aside. A conversation of system turns only has no participant and no rows; an empty table gives none.
    """
    safe = lambda x: F.replace(x, F.lit("<|"), F.lit("< |"))
    t = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("speaker"), safe(F.coalesce("text", F.lit(""))).alias("body"))
    who = t.filter("speaker <> 'system'").select(F.col("conv_id"), F.col("speaker").alias("participant")).distinct()
    own = F.col("speaker") == F.col("participant")
    name = F.translate(safe(F.col("speaker")), "\n\r", "  ")
    head = F.concat(F.lit(OPEN), F.when(F.col("speaker") == "system", F.lit("system")).when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), name)), F.lit("\n"))
    span = F.coalesce(F.expr(f"turn div {SPAN}"), F.lit(1 << 62)).alias("span")
    after = len(CLOSE) + 1
    # Sums come from lengths alone; texts are joined and ordered once.
    lengths = t.select("conv_id", "speaker", span, F.length("body").cast("long").alias("c")).join(who, "conv_id")
    sums = lengths.groupBy("conv_id", "participant", "span").agg(F.sum(F.length(head) + F.col("c") + after).alias("s"))
    before = sums.select("conv_id", "participant", "span", (F.sum("s").over(Window.partitionBy("conv_id", "participant").orderBy("span")) - F.col("s")).alias("before"))
    made = t.join(who, "conv_id").select(
        "conv_id", "participant", "turn", "speaker", span, "body", F.length(head).alias("h"), (F.length(head) + F.length("body").cast("long") + after).alias("n"), own.alias("own"), head.alias("head")
    )
    inner = Window.partitionBy("conv_id", "participant", "span").orderBy(F.col("turn").asc_nulls_last(), "speaker", "body").rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumn("within", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    start = F.col("before") + F.col("within")
    return placed.join(before, ["conv_id", "participant", "span"]).select(
        "conv_id", "participant", "turn", "speaker", F.concat("head", "body", F.lit(CLOSE + "\n")).alias("segment"), start.alias("start"),
        F.when(F.col("own"), start + F.col("h")).alias("mask_start"), F.when(F.col("own"), start + F.col("n") - 1).alias("mask_end"),
    )


def dialogues(parts: DataFrame) -> DataFrame:
    """(conv_id, participant, text, masks) from segments of dialogues that each fit a row."""
    listed = F.array_sort(F.collect_list(F.struct("start", "segment", "mask_start", "mask_end")))
    return parts.groupBy("conv_id", "participant").agg(listed.alias("x")).select(
        "conv_id", "participant", F.array_join(F.transform("x", lambda s: s["segment"]), "").alias("text"),
        F.transform(F.filter("x", lambda s: s["mask_start"].isNotNull()), lambda s: F.struct(s["mask_start"].alias("start"), s["mask_end"].alias("end"))).alias("masks"),
    )
