"""Chat formatting by perspective rotation: every participant in turn is the assistant, all others are named users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable
from .common import row_count, small

# Turns of one rendered part. Longer dialogues are several parts in a row, nothing is dropped.
PART_TURNS = 256
# Distinct turns of hot parts that one task numbers.
RANGE_ROWS = 50_000


def parts(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """``(conv, part, piece, pos, speaker, content, times)``: turns cut into parts of ``part_turns`` consecutive turn numbers.

    A part of more rows, because numbers repeat or are null, is cut further into pieces of ``part_turns`` rows in
    order of turn number, speaker and content: every piece is a consecutive stretch of the dialogue. A turn that
    repeats stands once in a piece, with its ``times`` there.
    """
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("pos"), F.coalesce(F.trim(F.col(role).cast("string")), F.lit("")).alias("speaker"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"))
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("pos") / part_turns), F.lit(-1)))
    sizes = durable(rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_turns).select(F.col("conv").alias("_c"), F.col("part").alias("_p")))
    hot = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p"))
    names, one = ["conv", "part", "pos", "speaker", "content"], F.lit(1).cast("long")
    cold = rows.join(small(sizes), hot, "left_anti").select("conv", "part", F.lit(0).cast("long").alias("piece"), "pos", "speaker", "content", one.alias("times"))
    if not sizes.limit(1).count():
        return cold
    # Row numbers by range: the counts of the ranges before, and a running sum inside each range. Prefixes bound what
    # the sample of range bounds holds; contents that share one are one range.
    packed = durable(rows.join(small(sizes), hot, "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("times")))
    packed = durable(packed.repartitionByRange(-(-row_count(packed) // RANGE_ROWS), "conv", "part", "pos", "speaker", F.left("content", F.lit(256))).withColumn("_range", F.spark_partition_id()))
    ahead = lambda by, order, c: F.coalesce(F.sum(c).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = packed.groupBy(F.col("conv").alias("_c"), F.col("part").alias("_p"), F.col("_range").alias("_r")).agg(F.sum("times").alias("_n"))
    before = before.select("_c", "_p", "_r", ahead(["_c", "_p"], ["_r"], "_n").alias("_before"))
    packed = packed.withColumn("_at", ahead(["_range", "conv", "part"], ["pos", "speaker", "content"], "times"))
    packed = packed.join(small(durable(before)), hot & (F.col("_range") == F.col("_r"))).withColumn("_at", F.col("_at") + F.col("_before"))
    last = F.col("_at") + F.col("times")
    packed = packed.withColumn("piece", F.explode(F.sequence(F.floor(F.col("_at") / part_turns), F.floor((last - 1) / part_turns))))
    times = F.least(last, (F.col("piece") + 1) * part_turns) - F.greatest("_at", F.col("piece") * part_turns)
    return cold.union(packed.select("conv", "part", "piece", "pos", "speaker", "content", times.alias("times")))


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """``(conv, assistant, part, piece, n_turns, n_own, text, mask_starts, mask_ends)``: each part from each participant's side.

    A turn renders as ``<|assistant|>\\ncontent<|end|>\\n`` or ``<|user name=NAME|>\\ncontent<|end|>\\n``; the masks are the
    code point ranges of the assistant's contents with their end mark, on which a loss is taken. Every participant of a
    conversation gets every part, also those in which they are silent (empty masks). Turns stand in order of turn number,
    then speaker, then content; a null number makes a part of its own, before all others. Null speakers are
    the speaker without name, null contents are empty; rows without conversation are one conversation; repeated turns
    stay repeated. An empty table gives an empty result.
    """
    rows = durable(parts(turns, conv, turn, role, text, part_turns))
    whole = rows.groupBy("conv", "part", "piece").agg(F.sort_array(F.collect_list(F.struct("pos", "speaker", "content", "times"))).alias("turns"))
    whole = whole.withColumn("turns", F.flatten(F.transform("turns", lambda t: F.array_repeat(t, t["times"].cast("int")))))
    people = rows.select(F.col("conv").alias("_c"), F.col("speaker").alias("assistant")).distinct()
    sides = whole.join(people, F.col("conv").eqNullSafe(F.col("_c")))
    own = lambda t: t["speaker"] == F.col("assistant")
    head = lambda t: F.when(own(t), F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), t["speaker"], F.lit("|>\n")))
    pieces = F.transform("turns", lambda t: F.struct(own(t).alias("own"), head(t).alias("head"), F.concat(t["content"], F.lit("<|end|>")).alias("body")))
    sides = sides.withColumn("_pieces", pieces)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("masks"))
    step = lambda s, p: F.struct(
        (s["at"] + F.length(p["head"]) + F.length(p["body"]) + 1).alias("at"),
        F.when(p["own"], F.concat(s["masks"], F.array(F.struct((s["at"] + F.length(p["head"])).alias("s"), (s["at"] + F.length(p["head"]) + F.length(p["body"])).alias("e"))))).otherwise(s["masks"]).alias("masks"))
    masks = F.aggregate("_pieces", start, step)["masks"]
    return sides.withColumn("_masks", masks).select(
        F.col("conv").alias(conv), "assistant", "part", "piece", F.size("turns").cast("long").alias("n_turns"), F.size("_masks").cast("long").alias("n_own"),
        F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        F.col("_masks.s").alias("mask_starts"), F.col("_masks.e").alias("mask_ends"))
