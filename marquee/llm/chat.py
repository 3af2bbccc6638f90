"""Chat formatting by collapse of cumulative snapshots.

A log that is written after every turn holds each conversation many times, as prefixes of itself. Rolling hashes of the turn
prefixes find the conversations that begin a longer one; an anti-join keeps the maximal ones, which are then rendered.

A turn is its role and text (NULL counts as empty). Turns are ordered by ``turn``, then role, then text; NULL turns come first. Rows that repeat a
whole turn count once. Of equal conversations the smallest ``conv_id`` stays. A NULL ``conv_id`` is a conversation like any other.
Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.session import staged

#: Turns summed in one window before blocks are put together, so that no task holds a long conversation.
BLOCK = 1024
PARTS = 4


def _numbered(turns: DataFrame) -> DataFrame:
    """Place of each turn in its conversation (``k`` from 1) by two windows: inside blocks of turn numbers, and over blocks."""
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct()
    rows = rows.withColumn("block", F.floor(F.coalesce("turn", F.lit(-(2**62))) / BLOCK))
    inside = W.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    rows = rows.withColumn("r", F.row_number().over(inside))
    return _with_base(rows, [F.count("*").alias("b_n")]).withColumn("k", F.col("r") + F.col("p_n")).drop("p_n", "r")


def _with_base(rows: DataFrame, sums: list) -> DataFrame:
    """Join the sums over all earlier blocks of the conversation as ``p_*``."""
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    per = rows.groupBy("conv_id", "block").agg(*sums)
    names = [c for c in per.columns if c.startswith("b_")]
    per = per.select(F.col("conv_id").alias("c_"), F.col("block").alias("bl_"), *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias("p" + c[1:]) for c in names))
    return rows.join(per, rows["conv_id"].eqNullSafe(per["c_"]) & (rows["block"] == per["bl_"])).drop("c_", "bl_")


def prefixes(numbered: DataFrame) -> DataFrame:
    """conv_id, k and the 128-bit rolling hash of the first ``k`` turns as four running sums of 32-bit parts.

    The hash of a turn is salted by its place, so a sum of them stands for the sequence. Texts are hashed where they are read.
    """
    h = [F.xxhash64(F.lit(s), "k", "role", "text") for s in (1, 2)]
    halves = [h[0].bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h[0], 32), h[1].bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h[1], 32)]
    rows = numbered.select("conv_id", "block", "k", *(x.alias(f"h{i}") for i, x in enumerate(halves)))
    running = W.partitionBy("conv_id", "block").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({f"s{i}": F.sum(f"h{i}").over(running) for i in range(PARTS)})
    rows = _with_base(rows, [F.sum(f"h{i}").alias(f"b_{i}") for i in range(PARTS)])
    return rows.select("conv_id", "k", F.concat_ws(".", F.col("k"), *(F.col(f"s{i}") + F.col(f"p_{i}") for i in range(PARTS))).alias("prefix"))


def maximal(turns: DataFrame) -> DataFrame:
    """The turns (conv_id, k, n, role, text) of conversations that begin no longer one, one of each set of equals."""
    numbered = staged(_numbered(turns), "turns")
    rows = staged(prefixes(numbered), "prefixes")
    last = rows.groupBy("conv_id").agg(F.max_by("prefix", "k").alias("prefix"), F.max("k").alias("n"))
    # Prefixes are counted before they meet: a first turn shared by many conversations is one row for each task.
    longest = rows.join(last.select(F.col("conv_id").alias("c_"), "n"), F.col("conv_id").eqNullSafe(F.col("c_"))).groupBy("prefix").agg(F.max("n").alias("longest"))
    kept = last.groupBy("prefix", "n").agg(F.min("conv_id").alias("conv_id"))
    kept = kept.join(longest.withColumnRenamed("prefix", "p_"), (F.col("prefix") == F.col("p_")) & (F.col("longest") > F.col("n")), "left_anti")
    kept = kept.select(F.col("conv_id").alias("c_"), "n")
    return numbered.join(kept, F.col("conv_id").eqNullSafe(F.col("c_"))).select("conv_id", "k", "n", "role", "text")


def render(turns: DataFrame) -> DataFrame:
    """One row for each turn of the maximal conversations: conv_id, k, n (turns of the conversation), rendered.

    Rows, not one string for each conversation: the pieces of a conversation joined in the order of ``k`` are its text, however long.
    """
    return maximal(turns).select(
        "conv_id",
        F.col("k").cast("long"),
        F.col("n").cast("long"),
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n"), F.when(F.col("k") == F.col("n"), "<|end|>\n").otherwise("")).alias("rendered"),
    )
