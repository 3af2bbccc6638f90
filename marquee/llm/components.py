"""Connected components by contraction, as joins and groupings; nothing comes to the driver but one count in each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import passing, staged

MAX_ROUNDS = 60


def _rank(node: str, round_: int) -> F.Column:
    order = F.xxhash64(F.lit(round_), node) if round_ else F.lit(0).cast("long")
    return F.struct(order.alias("order"), F.col(node).alias("node"))


def components(edges: DataFrame) -> DataFrame:
    """node, component for each node of ``edges`` (a, b); the component is named by one of its nodes.

    In each round a node moves to the first node within two steps, and edges between nodes that have met are dropped. The first
    round orders nodes by value, so a star around its smallest node is done at once; later rounds order them by a hash that
    changes, so a long chain shrinks by a constant share each time. Every round is written to the scratch folder, which cuts the
    lineage; only the last names stay there. Loops and NULL ends are ignored; without edges there are no rows.
    """
    with passing() as keep:
        names = _contracted(edges)
        if names is not None:
            return keep(names)
    kind = edges.schema["a"].dataType.simpleString()
    return edges.sparkSession.createDataFrame([], f"node {kind}, component {kind}")


def _contracted(edges: DataFrame) -> DataFrame | None:
    """Staged names; None without edges."""
    live = staged(edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "edges")
    names = None
    for round_ in range(MAX_ROUNDS):
        if live.isEmpty():
            break
        both = live.union(live.select("b", "a"))
        near = both.groupBy("a").agg(F.min(_rank("b", round_)).alias("m")).select("a", F.least("m", _rank("a", round_)).alias("m"))
        far = both.join(near.toDF("b", "m"), "b").groupBy("a").agg(F.min("m").alias("f"))
        moved = near.join(far, "a").select(F.col("a").alias("from"), F.least("m", "f").getField("node").alias("to"))
        moved = staged(moved, "moves")
        if names is None:
            names = moved.select(F.col("from").alias("node"), F.col("to").alias("component"))
        else:
            step = names.join(moved, names["component"] == moved["from"], "left")
            names = step.select("node", F.coalesce("to", "component").alias("component"))
        names = staged(names, "names")
        left = live.join(moved, live["a"] == moved["from"]).select(F.col("to").alias("a"), "b")
        right = left.join(moved, left["b"] == moved["from"]).select("a", F.col("to").alias("b"))
        live = staged(right.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    return names
