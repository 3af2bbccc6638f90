"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length in words. A source's target is met by whole copies of all its documents and, for
what remains, by a number of further documents of each length: an even share of every length first, then a bounded knapsack over
the lengths for the rest. Which documents those are is decided by a seeded hash, length by length.

A word is a run without space, tab, line feed, vertical tab, form feed or carriage return; NULL and empty texts have size 0 and
take nothing. Sources are ordered by code point, NULL last. Repeated rows are documents of their own and are taken as their hash
says: rows with the same id, size and source are taken together as far as their count allows. An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.session import staged

#: No document is taken more often than this.
REPEATS = 3
#: Hash slots of each (source, length) group: only one slot of a group is ever ordered row by row.
SLOTS = 4096


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size; the words are counted on the JVM."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = REPEATS) -> DataFrame:
    """source, source_size, target for each source; sources weigh ``weights`` in turn.

    All sizes are shared by weight; a source's target stops at ``repeats`` times its size, and the excess is shared again until no
    target is above. That is target = min(limit, level * weight) for one level, found by running sums over the sources in the
    order in which they reach their limits. One row for each source is ordered, not one for each document.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(place - 1, F.lit(len(weights))).cast("int") + 1)
    per = per.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(repeats)))
    by_level = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, W.unboundedFollowing)
    per = per.withColumns(
        {
            "total": F.sum("source_size").over(W.partitionBy()),
            "used": F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(after),
        }
    )
    # The level if all before this source have reached their limits; the true one is the first that its own source can bear.
    level = (F.col("total") - F.col("used")) / F.col("open")
    fits = level * F.col("weight") <= F.col("limit")
    everything = by_level.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = per.withColumn("level", F.first(F.when(fits, level), ignorenulls=True).over(everything))
    return per.select("source", "source_size", F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))).alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, at most ``counts``, so that their words come as near to ``budget`` from below as can be found.

    An even share of every length first; the rest by bounded knapsack. The table of the knapsack has as many cells as the rest has
    words, and the rest is brought under about twice the longest length before.
    """
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    take = np.where(lengths > 0, (counts.astype(np.float64) * (budget / total)).astype(np.int64), 0)
    rest = budget - int((lengths * take).sum())
    order = np.argsort(-lengths, kind="stable")
    bound = 2 * int(lengths.max())
    for i in order:
        if rest <= bound:
            break
        more = min(int(counts[i] - take[i]), (rest - bound) // int(lengths[i]) + 1, rest // int(lengths[i])) if lengths[i] > 0 else 0
        take[i] += more
        rest -= more * int(lengths[i])
    return take + _knapsack(lengths, counts - take, rest)


def _knapsack(lengths: np.ndarray, left: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: the sum nearest to ``budget`` from below. Numbers of copies are split in powers of two."""
    take = np.zeros(len(lengths), np.int64)
    reached = np.full(budget + 1, -1, np.int32)  # the piece that first reached a sum
    reached[0] = 0
    pieces: list[tuple[int, int]] = [(-1, 0)]
    for i in np.argsort(lengths, kind="stable"):
        size, n = int(lengths[i]), int(left[i])
        if size <= 0 or size > budget:
            continue
        n, c = min(n, budget // size), 1
        while n > 0:
            c = min(c, n)
            w = c * size
            if w <= budget:
                pieces.append((int(i), c))
                fresh = (reached[:-w] >= 0) & (reached[w:] < 0)
                reached[w:][fresh] = len(pieces) - 1
            n -= c
            c *= 2
        if reached[budget] >= 0:
            break
    at = int(np.flatnonzero(reached >= 0)[-1])
    while at > 0:
        i, c = pieces[reached[at]]
        take[i] += c
        at -= c * int(lengths[i])
    return take


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of everything and further documents by length, for one source."""
    rows = rows.sort_values("size")
    size, target = int(rows["source_size"].iloc[0]), int(rows["target"].iloc[0])
    whole = min(target // size, REPEATS) if size else 0
    extra = fit(rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), target - whole * size if whole < REPEATS else 0)
    return rows.assign(whole=whole, extra=extra)[["source", "size", "source_size", "target", "whole", "extra"]]


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the words that the mix takes from each document, repeats counted."""
    sizes = staged(sized(docs), "sizes")
    hashed = sizes.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn("slot", F.pmod("h", F.lit(SLOTS)).cast("int"))
    by_slot = hashed.groupBy("source", "size", "slot").agg(F.count("*").alias("n"))
    by_size = by_slot.groupBy("source", "size").agg(F.sum("n").alias("n"))
    goals = targets(sizes, weights).withColumnRenamed("source", "s_")
    counted = by_size.join(goals, F.col("source").eqNullSafe(F.col("s_"))).drop("s_")
    plan = counted.groupBy("source").applyInPandas(_plan, "source string, size long, source_size long, target double, whole long, extra long")
    plan = plan.select(F.col("source").alias("s_"), F.col("size").alias("z_"), "source_size", "target", "whole", "extra")
    # Slots that are taken whole, in part, or not at all. Ties in the hash are one slot's matter.
    before = F.coalesce(F.sum("n").over(W.partitionBy("source", "size").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    slots = by_slot.withColumn("before", before).join(plan, F.col("source").eqNullSafe(F.col("s_")) & (F.col("size") == F.col("z_")))
    room = F.least(F.greatest(F.col("extra") - F.col("before"), F.lit(0)), F.col("n"))
    slots = slots.select("s_", "z_", F.col("slot").alias("l_"), "n", "source_size", "target", "whole", room.alias("room"))
    same = F.col("source").eqNullSafe(F.col("s_")) & (F.col("size") == F.col("z_")) & (F.col("slot") == F.col("l_"))
    rows = hashed.join(slots, same).drop("s_", "z_", "l_")
    cut = (F.col("room") > 0) & (F.col("room") < F.col("n"))
    ordered = F.row_number().over(W.partitionBy("source", "size", "slot").orderBy("h", "doc_id"))
    part = rows.where(cut).withColumn("more", (ordered <= F.col("room")).cast("long"))
    rest = rows.where(~cut).withColumn("more", (F.col("room") > 0).cast("long"))
    out = part.unionByName(rest)
    return out.select("doc_id", "source", "size", "source_size", "target", ((F.col("whole") + F.col("more")) * F.col("size")).alias("taken"))
