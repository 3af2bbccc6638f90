"""Consecutive positions over a whole table or within groups of any size, without a one-task window.

The order column is cut into ranges at quantiles that become literals in the plan. Counting rows per range is an ordinary
aggregate; a prefix sum over the (few) ranges of a group gives each range its offset; rows are then numbered inside
(group, range). A group with a third of all rows is therefore spread over all ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


MAX_RANGES = 4096


def _cuts(df: DataFrame, col: str, ranges: int) -> tuple[list[float], list[float]]:
    """Range borders of a numeric column, and its heavy values: those that fill a range on their own."""
    at = df.select(F.col(col).cast("double").alias("_o")).approxQuantile(
        "_o", [i / ranges for i in range(1, ranges)], 0.25 / ranges
    )
    heavy = sorted({a for a, b in zip(at, at[1:]) if a == b})
    borders = set(at) | {math.nextafter(v, math.inf) for v in heavy}
    return [-math.inf, *sorted(borders), math.inf], heavy


def _into_ranges(df: DataFrame, col: str, borders: list[float], out: str) -> DataFrame:
    if len(borders) == 2:
        return df.withColumn(out, F.lit(0.0))
    cast = df.withColumn(f"{out}_in", F.col(col).cast("double"))
    cut = Bucketizer(splits=borders, inputCol=f"{out}_in", outputCol=out, handleInvalid="keep")
    return cut.transform(cast)


def number_rows(
    df: DataFrame,
    order_col: str,
    group_cols: Sequence[str] = (),
    tie_cols: Sequence[str] = (),
    out: str = "pos",
    ranges: int | None = None,
    ranges_of: DataFrame | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in (its group and) the order of the numeric ``order_col``, then ``tie_cols``.

    NULL comes first, as in any ascending order of Spark. A value of ``order_col`` so frequent that it fills whole ranges
    gets ranges of its own, cut by the first of ``tie_cols`` (numeric). ``ranges_of`` gives the borders from a cheaper frame
    with the same columns, such as the input of a join; any borders give the same positions.
    """
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranges = max(2, min(ranges, MAX_RANGES))
    sample = df if ranges_of is None else ranges_of
    borders, heavy = _cuts(sample, order_col, ranges)
    cut = _into_ranges(df, order_col, borders, "_range")
    if heavy and tie_cols:
        tie_borders, _ = _cuts(sample, tie_cols[0], ranges)
        cut = _into_ranges(cut, tie_cols[0], tie_borders, "_tie")
        is_heavy = F.col(order_col).cast("double").isin(heavy)
        cut = cut.withColumn("_sub", F.when(is_heavy, F.col("_tie")).otherwise(F.lit(0.0)))
    else:
        cut = cut.withColumn("_sub", F.lit(0.0))
    groups = list(group_cols)
    slot = [*groups, "_range", "_sub"]
    counts = cut.groupBy(*slot).agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_range", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        *[F.col(c).alias(f"_s{i}") for i, c in enumerate(slot)],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    same: Column = F.lit(True)
    for i, c in enumerate(slot):
        same = same & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    inside = Window.partitionBy(*slot).orderBy(order_col, *tie_cols)
    return (
        cut.join(offsets, same, "left")
        .withColumn(out, F.row_number().over(inside) - 1 + F.col("_offset"))
        .select(*df.columns, F.col(out).cast("bigint").alias(out))
    )


def allocate_ids(
    new_rows: DataFrame,
    existing: DataFrame,
    id_col: str,
    order_col: str,
    tie_cols: Sequence[str] = (),
    ranges_of: DataFrame | None = None,
) -> DataFrame:
    """Give ``new_rows`` consecutive ids after the greatest id of ``existing`` (1 when it is empty)."""
    top = existing.select(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).scalar()
    numbered = number_rows(new_rows.drop(id_col), order_col, tie_cols=tie_cols, out="_pos", ranges_of=ranges_of)
    return numbered.withColumn(id_col, (F.col("_pos") + 1 + top).cast("bigint")).drop("_pos")
