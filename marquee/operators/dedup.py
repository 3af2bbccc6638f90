"""Dedup by key and top-N per group.

Both are ``row_number() <= n``, which Spark runs with a group limit *before* the exchange: a map task sends at most ``n``
rows per key, so a key that holds a third of the table still reaches its reducer as a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each group in ``order``; ``rank`` keeps the 1-based position under that name."""
    name = rank or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def _content_order(df: DataFrame, keys, by, descending: bool) -> list[Column]:
    """The rest of the row as tie-break, so that equal ``by`` values still give one result whatever the partitioning."""
    rest = F.struct(*[c for c in df.columns if c not in keys and c not in by])
    names = [c for c in df.columns if c not in keys and c not in by]
    if not names:
        return []
    return [rest.desc() if descending else rest.asc()]


def dedup_latest(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest ``by``, then the greatest content."""
    order = [F.col(c).desc_nulls_last() for c in by] + _content_order(df, keys, by, True)
    return top_n_per_group(df, keys, order, 1)


def dedup_first(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per key: the smallest ``by``, then the smallest content."""
    order = [F.col(c).asc_nulls_last() for c in by] + _content_order(df, keys, by, False)
    return top_n_per_group(df, keys, order, 1)
