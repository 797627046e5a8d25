"""Preference formatting of conversations.

A pair has a chosen and a rejected conversation. The turns both begin with are rendered
once, as prompt; what follows is rendered for either side as completion. The result has
one row per rendered turn with its place in the rendered text, so a mask is a set of
character ranges and no conversation has to fit into one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquay.llm.common import running_sum

#: Turns that are ordered together; only spreads long conversations, results do not change.
TURNS_PER_PART = 512


def render_turn(role: Column, text: Column) -> Column:
    """A turn between role markers; a null role or text counts as empty."""
    return F.concat(
        F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"),
        F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"),
    )


def preference_turns(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Rows ``pair_id, part, place, role, rendered, trained, start, end`` of every pair.

    ``turns`` has ``pair_id, side`` (``chosen`` or ``rejected``), ``turn, role, text``; other
    columns are not looked at. Turns of a side are ordered by ``turn``, then role and text; a null
    ``turn`` comes first. The prompt is the longest run of first turns whose role and text
    (null equals null) agree; it may be empty or, for equal conversations, everything.
    ``part`` is ``prompt``, ``chosen`` or ``rejected``; a side that ends with the prompt has no row.
    ``place`` counts the turns of a side from 0, ``start`` and ``end`` are characters of the
    rendered side, prompt included. ``trained`` holds for completion turns of ``trained_role``;
    everything else is masked. Rows with another side, or none, are left out.
    """
    rows = turns.select("pair_id", "side", "turn", "role", "text")
    rows = rows.where(F.col("side").isin("chosen", "rejected"))
    rows = rows.withColumn("rendered", render_turn(F.col("role"), F.col("text")))
    rows = rows.withColumn("size", F.char_length("rendered").cast("long"))
    rows = rows.withColumn("one", F.lit(1).cast("long"))
    coarse = F.coalesce(F.floor(F.col("turn") / TURNS_PER_PART), F.lit(-(1 << 62)))
    rows = rows.withColumn("__coarse", coarse.cast("long"))
    order = ["turn", "role", "text"]
    group = ["pair_id", "side"]
    rows = running_sum(rows, group, "__coarse", order, "one", "place")
    rows = running_sum(rows, group, "__coarse", [*order, "place"], "size", "start")

    # Turns of both sides at the same place agree if both are there and equal.
    content = F.struct("role", "text")
    places = rows.groupBy("pair_id", "place").agg(
        (
            (F.count_if(F.col("side") == "chosen") == 1)
            & (F.count_if(F.col("side") == "rejected") == 1)
            & F.max(F.when(F.col("side") == "chosen", content)).eqNullSafe(
                F.max(F.when(F.col("side") == "rejected", content))
            )
        ).alias("agree")
    )
    shared = places.groupBy("pair_id").agg(
        F.coalesce(
            F.min(F.when(~F.col("agree"), F.col("place"))), F.max("place") + 1
        ).alias("shared")
    )
    same = F.col("l.pair_id").eqNullSafe(F.col("r.pair_id"))
    rows = rows.alias("l").join(shared.alias("r"), same).select("l.*", "r.shared")
    prompt = F.col("place") < F.col("shared")
    rows = rows.where(~prompt | (F.col("side") == "chosen"))
    return rows.select(
        "pair_id",
        F.when(prompt, F.lit("prompt")).otherwise(F.col("side")).alias("part"),
        "place", "role", "rendered",
        (~prompt & F.col("role").eqNullSafe(F.lit(trained_role))).alias("trained"),
        "start", (F.col("start") + F.col("size")).alias("end"),
    )


def preference_pairs(parts: DataFrame) -> DataFrame:
    """One row per pair with its texts whole: ``prompt, chosen, rejected`` and the masks.

    For pairs that fit into a row each. ``chosen_mask`` and ``rejected_mask`` are the trained
    ``(start, end)`` ranges, in characters of prompt and completion together.
    """

    def text(part: str) -> Column:
        rows = F.collect_list(F.when(F.col("part") == part, F.struct("place", "rendered")))
        return F.array_join(F.transform(F.array_sort(rows), lambda x: x["rendered"]), "").alias(part)

    def mask(part: str) -> Column:
        own = (F.col("part") == part) & F.col("trained")
        rows = F.collect_list(F.when(own, F.struct("start", "end")))
        return F.array_sort(rows).alias(f"{part}_mask")

    return parts.groupBy("pair_id").agg(
        text("prompt"), text("chosen"), text("rejected"), mask("chosen"), mask("rejected")
    )
