"""Perspective rotation of dialogues: each participant in turn speaks as the assistant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Roles that set the scene and are nobody's part.
SCENE = ("system",)


def rotate_perspectives(turns: DataFrame, block: int = 1024) -> DataFrame:
    """Every dialogue from the view of each of its participants, as segments in order.

    A participant is a distinct role of a conversation other than ``system``. From its view its own turns are the
    assistant's and carry the training mask; the turns of all others are a user's, under their names; system turns stay
    system turns. The rendering is the concatenation of the segments: ``<|assistant|>\\n``, ``<|user|> name\\n`` or
    ``<|system|>\\n`` before each text and a line feed after it. Only the text of the assistant's turns is masked in.

    Result, one row per conversation, participant and turn: conv_id, perspective, turn, place (0, 1, ... in the
    dialogue), role, name, segment, seg_start and seg_end (code points in the rendering), mask_start and mask_end (the
    trained part; null where nothing is trained).

    Null texts are empty; turns without role are spoken by ``unknown``; turns without number come first; ties of a turn
    number are ordered by role and text; a conversation of system turns alone gives no row; a null conv_id is a
    conversation of its own. Places and offsets are running sums over blocks of ``block`` turn numbers, so that a long
    conversation is spread over many groups, and no dialogue is ever held in one row.
    """
    clean = turns.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", F.floor(F.col("turn") / block))
    views = clean.where(~F.col("speaker").isin(*SCENE)).select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    seen = clean.join(views, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker").isin(*SCENE), "system").when(own, "assistant").otherwise("user")
    head = F.when(role == "user", F.concat(F.lit("<|user|> "), "speaker", F.lit("\n"))).otherwise(F.concat(F.lit("<|"), role, F.lit("|>\n")))
    segments = seen.select(
        "conv_id", "perspective", "turn", "block", role.alias("role"), F.when(role == "user", F.col("speaker")).alias("name"),
        F.length(head).cast("long").alias("head"), F.concat(head, "text", F.lit("\n")).alias("segment"), own.alias("own"), "speaker", "text",
    ).withColumn("size", F.length("segment").cast("long"))
    key = ["conv_id", "perspective"]
    sums = segments.groupBy(*key, "block").agg(F.sum("size").alias("block_size"), F.count(F.lit(1)).alias("block_rows"))
    before = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        *(F.col(k).alias(f"_{k}") for k in (*key, "block")),
        F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("base"), F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("base_rows"))
    inside = Window.partitionBy(*key, "block").orderBy("turn", "speaker", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = segments.withColumn("upto", F.sum("size").over(inside)).withColumn("nth", F.row_number().over(Window.partitionBy(*key, "block").orderBy("turn", "speaker", "text")))
    same = F.lit(True)
    for k in (*key, "block"):
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    out = placed.join(bases, same)
    start = F.col("base") + F.col("upto") - F.col("size")
    return out.select(
        *key, "turn", (F.col("base_rows") + F.col("nth") - 1).cast("long").alias("place"), "role", "name", "segment",
        start.alias("seg_start"), (start + F.col("size")).alias("seg_end"),
        F.when(F.col("own"), start + F.col("head")).alias("mask_start"), F.when(F.col("own"), start + F.col("size") - 1).alias("mask_end"))
