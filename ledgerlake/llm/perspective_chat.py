"""Chat formatting by perspective rotation, in DataFrame functions alone.

For every participant of a conversation the dialogue is rendered with that speaker as
the assistant and the others as named users; the mask lists the character ranges to
train on, which are the speaker's own turns.  Turns of ``system`` roles open no
perspective and stay system messages.

A conversation is rendered in parts of ``part_turns`` turn numbers, so that one of any
length is never gathered into one task: the parts of a perspective, in order of
``part``, are its whole text, and mask ranges count from the start of their part.

Defined results: a null text is an empty message; a null role is the speaker ``unknown``;
null turns come first, as part -1; turns with one number are ordered by role and text;
repeated rows are rendered as often as they occur; a conversation with a null id is one
conversation; one with system turns alone has no perspective; an empty table gives an
empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 32
START, END = "<|im_start|>", "<|im_end|>\n"


def rotate_perspectives(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    system: tuple[str, ...] = ("system",),
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """Return conv_id, speaker, part, n_turns, text, mask (array of start, end)."""
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long"))
    parts = rows.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    speakers = (
        rows.filter(~F.col("role").isin(*system)) if system else rows
    ).select("conv_id", F.col("role").alias("speaker")).distinct()

    same = parts["conv_id"].eqNullSafe(speakers["conv_id"])
    each = parts.join(speakers, same).select(parts["conv_id"], "speaker", "part", "turns")

    def head(t: Column) -> Column:
        who = (
            F.when(t["role"] == F.col("speaker"), F.lit("assistant"))
            .when(t["role"].isin(*system) if system else F.lit(False), t["role"])
            .otherwise(F.concat(F.lit("user name="), t["role"]))
        )
        return F.concat(F.lit(START), who, F.lit("\n"))

    message = F.transform(
        "turns",
        lambda t: F.struct(
            head(t).alias("head"),
            t["text"].alias("text"),
            (t["role"] == F.col("speaker")).alias("own"),
        ),
    )
    sized = F.transform(
        "messages",
        lambda m: F.struct(
            (F.length(m["head"]) + F.length(m["text"]) + F.lit(len(END))).cast("long").alias("size"),
            F.length(m["head"]).cast("long").alias("head"),
            F.length(m["text"]).cast("long").alias("text"),
            m["own"].alias("own"),
        ),
    )

    def ranges(sizes: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            at = acc["at"] + s["head"]
            one = F.array(F.struct(at.alias("start"), (at + s["text"]).alias("end")))
            return F.struct(
                (acc["at"] + s["size"]).alias("at"),
                F.when(s["own"], F.concat(acc["mask"], one)).otherwise(acc["mask"]).alias("mask"),
            )

        zero = F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<start:bigint,end:bigint>>").alias("mask"),
        )
        return F.aggregate(sizes, zero, step, lambda a: a["mask"])

    return (
        each.withColumn("messages", message)
        .withColumn("sizes", sized)
        .select(
            "conv_id",
            "speaker",
            "part",
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(
                F.transform("messages", lambda m: F.concat(m["head"], m["text"], F.lit(END))), ""
            ).alias("text"),
            ranges(F.col("sizes")).alias("mask"),
        )
    )


def mask_text(mask: str = "mask") -> Column:
    """The mask as ``start-end`` pairs joined by commas."""
    return F.array_join(
        F.transform(mask, lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"))), ","
    )
