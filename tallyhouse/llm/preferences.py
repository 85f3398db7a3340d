"""Preference pairs as text with masks, in DataFrame functions alone.

The turns that a chosen and a rejected conversation share from the start are rendered once, as the prompt;
what follows in either is rendered as its completion, with the characters that a model is to learn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a turn is rendered.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"
#: The role whose text is learnt.
LEARNT = "assistant"

_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def rendered(turns: Column) -> Column:
    """One string of turns; a null role or text is empty."""
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(
                F.lit(OPEN), F.coalesce(t["role"], F.lit("")), F.lit(MIDDLE), F.coalesce(t["text"], F.lit("")), F.lit(CLOSE)
            ),
        ),
        "",
    )


def learnt_spans(turns: Column, role: str = LEARNT) -> Column:
    """(start, end) of the characters of `rendered(turns)` that are learnt: text and end mark of the role."""
    head = lambda t: F.length(F.coalesce(t["role"], F.lit(""))) + len(OPEN) + len(MIDDLE)
    tail = lambda t: F.length(F.coalesce(t["text"], F.lit(""))) + len(CLOSE)
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")
    )
    return F.aggregate(
        turns,
        start,
        lambda done, t: F.struct(
            (done["at"] + head(t) + tail(t)).alias("at"),
            F.when(
                t["role"] == role,
                F.concat(
                    done["spans"],
                    F.array(
                        F.struct(
                            (done["at"] + head(t)).alias("start"), (done["at"] + head(t) + tail(t)).alias("end")
                        )
                    ),
                ),
            )
            .otherwise(done["spans"])
            .alias("spans"),
        ),
        lambda done: done["spans"],
    )


def shared_turns(one: Column, other: Column) -> Column:
    """How many turns two conversations share from the start: equal in role and text, null equal to null."""
    least = F.least(F.size(one), F.size(other))
    same = F.zip_with(
        F.slice(one, 1, least),
        F.slice(other, 1, least),
        lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]),
    )
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first.cast("int") - 1).otherwise(least)


def format_pairs(turns: DataFrame, pair: Column, chosen: Column, role: str = LEARNT) -> DataFrame:
    """One row for each pair of `turns(turn, role, text)`.

    `pair` says which pair a turn belongs to and `chosen` (true or false) which side; turns without either
    are left out. Turns are in order of their number, then role and text (nulls first). Returns `pair`,
    `shared` (turns), `prompt`, `chosen`, `rejected`, `chosen_mask` and `rejected_mask` (arrays of start and
    end in characters of the completion, end exclusive) and `complete`: whether both sides have something to
    learn. A side without turns is an empty conversation; if one conversation begins the other, or both are
    equal, the shorter completion is empty. One exchange brings the turns of a pair together.
    """
    side = lambda flag: F.array_sort(F.collect_list(F.when(flag, F.col("said")))).cast(_TURNS)
    sides = (
        turns.select(
            pair.alias("pair"),
            chosen.alias("is_chosen"),
            F.struct(F.col("turn").cast("long").alias("turn"), F.col("role"), F.col("text")).alias("said"),
        )
        .where(F.col("pair").isNotNull() & F.col("is_chosen").isNotNull())
        .groupBy("pair")
        .agg(side(F.col("is_chosen")).alias("one"), side(~F.col("is_chosen")).alias("other"))
        .withColumn("shared", shared_turns(F.col("one"), F.col("other")))
    )
    rest = lambda name: F.slice(F.col(name), F.col("shared") + 1, F.size(name))
    return (
        sides.withColumn("start", F.slice("one", F.lit(1), F.col("shared")))
        .withColumn("one", rest("one"))
        .withColumn("other", rest("other"))
        .select(
            "pair",
            "shared",
            rendered(F.col("start")).alias("prompt"),
            rendered(F.col("one")).alias("chosen"),
            rendered(F.col("other")).alias("rejected"),
            learnt_spans(F.col("one"), role).alias("chosen_mask"),
            learnt_spans(F.col("other"), role).alias("rejected_mask"),
        )
        .withColumn("complete", (F.size("chosen_mask") > 0) & (F.size("rejected_mask") > 0))
    )
