"""Preference examples from pairs of conversations. Built-ins only.

The chosen and the rejected conversation of a pair share their first turns; the longest common prefix is rendered
once as the prompt, and what follows in either becomes a completion whose mask keeps the reply apart from the rest.
The result stays one row per rendered turn, so that no conversation, however long, has to fit into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers around a turn.
OPEN, CLOSE = "<|{role}|>\n", "<|end|>\n"


def rendered(role: Column, text: Column) -> Column:
    """A turn between its markers; a null role is unknown, a null text empty."""
    before, after = OPEN.split("{role}")
    return F.concat(F.lit(before), F.coalesce(role, F.lit("unknown")), F.lit(after), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def paired(turns: DataFrame) -> DataFrame:
    """(pair_id, turn, chosen, rejected): what either side says at a turn (role, text), null where it has no such turn. Of
    several rows for one turn of a side, the smallest (role, text) counts, null first. Rows with a null pair_id or turn,
    or of another side, belong to no conversation and are left out."""
    named = turns.where("pair_id is not null and turn is not null and side in ('chosen', 'rejected')")
    said = lambda side: F.min(F.when(F.col("side") == side, F.struct("role", "text"))).alias(side)
    return named.groupBy("pair_id", "turn").agg(said("chosen"), said("rejected"))


def preference_turns(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """(pair_id, segment, turn, role, rendered, n_chars, loss_start, loss_end, status) per rendered turn.

    `turns`: (pair_id, side, turn, role, text), side chosen or rejected. segment is prompt for turns of the common
    prefix (rendered once), else chosen or rejected. A turn belongs to the prefix if both sides have the same turn
    number, role and text there and at all earlier turn numbers; null equals null. Loss counts on characters
    loss_start to loss_end (exclusive) of a rendered turn: text and closing marker of completion turns of
    `trained_role`, nothing (both 0) elsewhere. status: paired, identical (no completion differs), chosen_only or
    rejected_only (one side has no turns). Other columns are ignored.

    Rows that repeat a turn count once, a null role is trained on like any other that isn't `trained_role`, and an empty
    table gives an empty result. Turns meet by pair and turn number and the cut is a minimum per pair, so a conversation of
    any length spreads over tasks; from then on a text that both sides share travels once.
    """
    both = paired(turns)
    c, r = F.col("chosen"), F.col("rejected")
    same = c.isNotNull() & r.isNotNull() & c["role"].eqNullSafe(r["role"]) & c["text"].eqNullSafe(r["text"])
    both = both.withColumn("same", same)
    cut = both.groupBy("pair_id").agg(
        F.min(F.when(~F.col("same"), F.col("turn"))).alias("cut"), F.max(c.isNotNull()).alias("any_chosen"), F.max(r.isNotNull()).alias("any_rejected"),
    )
    # One more key, always 0, puts an exchange under the grouped side too: Spark splits a hot pair only there.
    zero = F.pmod(F.xxhash64("pair_id"), F.lit(1).cast("long")).alias("zero")
    lean = both.select("pair_id", "turn", "same", "chosen", F.when(~F.col("same"), r).alias("rejected"), zero)
    marked = lean.join(cut.select("pair_id", "cut", "any_chosen", "any_rejected", zero), ["pair_id", "zero"])
    prompt = F.col("cut").isNull() | (F.col("turn") < F.col("cut"))
    # A turn after the cut that both sides share is a completion of either.
    other = F.when(F.col("same"), c).otherwise(r)
    turn = lambda name, said: F.when(said.isNotNull(), F.struct(F.lit(name).alias("segment"), said["role"].alias("role"), said["text"].alias("text")))
    completions = F.array_compact(F.array(turn("chosen", c), turn("rejected", other)))
    status = F.when(~F.col("any_rejected"), "chosen_only").when(~F.col("any_chosen"), "rejected_only")
    status = status.when(F.col("cut").isNull(), "identical").otherwise("paired")
    lines = marked.select("pair_id", "turn", status.alias("status"), F.explode(F.when(prompt, F.array(turn("prompt", c))).otherwise(completions)).alias("t"))
    lines = lines.select("pair_id", "turn", "status", "t.segment", "t.role", "t.text").withColumn("rendered", rendered(F.col("role"), F.col("text")))
    trained = (F.col("segment") != "prompt") & F.col("role").eqNullSafe(F.lit(trained_role))
    n = F.char_length("rendered")
    start = F.char_length(F.concat(F.lit(OPEN.replace("{role}", "")), F.coalesce("role", F.lit("unknown"))))
    return lines.select(
        "pair_id", "segment", "turn", "role", "rendered", n.cast("long").alias("n_chars"),
        F.when(trained, start).otherwise(0).cast("long").alias("loss_start"), F.when(trained, n - 1).otherwise(0).cast("long").alias("loss_end"), "status",
    )
