"""Prefix trie of conversations by an Euler tour.

Every distinct sequence of first turns is a node. The nodes are numbered by parent, so that siblings follow each other; each gets an enter and an exit arc, and
each arc its successor in the walk around the trie. The list of arcs is ranked without walking it: one arc in ``EVERY``, chosen by a hash, is a ruler; all others
double their pointers until they stand at a ruler; the rulers make a list of their own, which is ranked in the same way, down to ``FEW`` rulers at most. With the
positions known, a node's subtree lies between its two arcs, and its sums are differences of prefix sums.

Turns are ordered by ``turn`` (NULL first), then role, then text; NULL role or text is empty, and rows that repeat are turns each. Rows without ``conv_id`` belong to
no conversation and are left out. ``conv_id % 5`` has the sign of ``conv_id``, as in SQL. An empty table has no conversation and no node. Prefixes are named by
128-bit sums of place-salted hashes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.operators.numbering import number_rows
from marquee.session import staged

#: Turns or conversations handled in one window or group.
BLOCK = 1024
IDS = 512
#: Children of one parent that are joined, and arcs that are summed, in one group.
SLOT = 65_536
EVERY = 16
FEW = 16_384
PARTS = 4


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, k (place from 1), role, text: positions over the whole table, whatever the length of a conversation."""
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    ).where("conv_id is not null")
    # The first place of each conversation comes from counts of its turns, so no window holds a conversation.
    placed = staged(number_rows(rows, "conv_id", tie_cols=["turn", "role", "text"]), "trie-turns")
    first = placed.groupBy("conv_id").agg(F.min("pos").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("pos") - F.col("first") + 1).alias("k"), "role", "text")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns (conv_id, k, role, text) and all ids (conv_id, n) of the rebuilt conversations.

    The first ``h`` turns are those of conversation ``conv_id - conv_id % 5``, the others its own; ``h`` is the CRC-32 of the id in decimal, modulo 9.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    plan = sizes.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("h"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    plan = plan.join(base, "base", "left").withColumn("shared", F.least("h", F.coalesce("base_own", F.lit(0))))
    plan = staged(plan.withColumn("n", F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-plan")
    own = turns.join(plan.select("conv_id", "h", "shared"), "conv_id").where("k > h").select("conv_id", (F.col("k") - F.col("h") + F.col("shared")).alias("k"), "role", "text")
    # At most eight turns of a base go to four others and itself.
    firsts = turns.where((F.col("k") <= 8) & (F.col("conv_id") % 5 == 0)).withColumnRenamed("conv_id", "base")
    taken = plan.select("conv_id", "base", "shared").join(firsts, "base").where("k <= shared").select("conv_id", "k", "role", "text")
    return own.unionByName(taken), plan.select("conv_id", "n")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, k, node, parent, bytes: the name of the first ``k`` turns, of the first ``k - 1``, and the bytes of the last text.

    A name is the place and four running sums of 32-bit parts of two hashes of place, role and text. Sums run inside blocks of places; earlier blocks are added.
    """
    h = [F.xxhash64(F.lit(s), "k", "role", "text") for s in (1, 2)]
    halves = [h[0].bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h[0], 32), h[1].bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h[1], 32)]
    rows = turns.select("conv_id", "k", F.floor(F.col("k") / BLOCK).alias("block"), F.octet_length("text").cast("long").alias("bytes"), *(x.alias(f"h{i}") for i, x in enumerate(halves)))
    inside = W.partitionBy("conv_id", "block").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({f"s{i}": F.sum(f"h{i}").over(inside) for i in range(PARTS)})
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(*(F.sum(f"h{i}").alias(f"b{i}") for i in range(PARTS)))
    blocks = blocks.select("conv_id", "block", *(F.coalesce(F.sum(f"b{i}").over(before), F.lit(0)).alias(f"p{i}") for i in range(PARTS)))
    rows = rows.join(blocks, ["conv_id", "block"])

    def name(k: F.Column, less: bool) -> F.Column:
        return F.concat_ws(".", k, *(F.col(f"s{i}") + F.col(f"p{i}") - (F.col(f"h{i}") if less else 0) for i in range(PARTS)))

    parent = F.when(F.col("k") == 1, ROOT).otherwise(name(F.col("k") - 1, True))
    return rows.select("conv_id", "k", name(F.col("k"), False).alias("node"), parent.alias("parent"), "bytes")


ROOT = "root"


def nodes_of(places: DataFrame, ids: DataFrame) -> DataFrame:
    """node, parent, depth, conv_id (smallest member), n_convs, bytes: counted before rows meet, so a shared first turn is a row for each task."""
    inner = places.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("k").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes")
    )
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("bytes"))
    return inner.select("node", "parent", F.col("depth").cast("long").alias("depth"), "conv_id", "n_convs", "bytes").unionByName(root)


def numbered(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``nodes`` with ``id``, and the parents of ``nodes`` (node, first, last, n_children): the children of a node have consecutive ids; the root's id is 0.

    Order: 52 bits of the parent's hash, then the other 12 with 40 of the node's own, so that a parent with most of all children is still cut into ranges.
    Should two parents agree in all 64 bits, other hashes are taken.
    """
    for salt in range(8):
        h = [F.xxhash64(F.lit(salt), c) for c in ("parent", "node")]
        keyed = nodes.withColumn("key", F.when(F.col("parent").isNull(), -1).otherwise(F.shiftrightunsigned(h[0], 12)))
        keyed = keyed.withColumn("own", F.shiftleft(F.coalesce(h[0], F.lit(0)).bitwiseAND(0xFFF), 40).bitwiseOR(F.shiftrightunsigned(h[1], 24)))
        keyed = staged(keyed, "trie-keyed")
        out = staged(number_rows(keyed, "key", tie_cols=["own", "parent", "node"], out="id").drop("key", "own"), "trie-nodes")
        kids = out.where("parent is not null").groupBy("parent").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n_children"))
        kids = staged(kids.withColumnRenamed("parent", "node"), "trie-kids")
        if kids.where("last - first + 1 <> n_children").isEmpty():
            return out, kids
    raise RuntimeError("no hash keeps the children of each node together")


def tour(nodes: DataFrame, kids: DataFrame) -> DataFrame:
    """id, next: enter arc ``2 * id`` and exit arc ``2 * id + 1`` of each node, each with its successor; the root's exit has none.

    ``kids``: node, first and last id of its children. Only first and last children meet their parent, so no join has a hot key.
    """
    inner = nodes.join(kids, "node", "left").select("id", "first", "last")
    enter = inner.select((F.col("id") * 2).alias("id"), F.coalesce(F.col("first") * 2, F.col("id") * 2 + 1).alias("next"))
    up = inner.where("last is not null").select(F.col("last").alias("child"), F.col("id").alias("above"))
    leave = nodes.select("id").join(up, nodes["id"] == up["child"], "left")
    after = F.when(F.col("id") > 0, F.coalesce(F.col("above") * 2 + 1, F.col("id") * 2 + 2))
    return enter.unionByName(leave.select((F.col("id") * 2 + 1).alias("id"), after.alias("next")))


def ranked(arcs: DataFrame, few: int = FEW, every: int = EVERY) -> DataFrame:
    """id, left: how many arcs of the list (id, next, ``steps`` to the next, 1 if there is no such column) stand behind each one, in steps."""
    arcs = arcs if "steps" in arcs.columns else arcs.withColumn("steps", F.when(F.col("next").isNull(), 0).otherwise(1).cast("long"))
    return _ranked(staged(arcs, "tour-0"), few, every, 1)


def _ranked(arcs: DataFrame, few: int, every: int, level: int) -> DataFrame:
    if arcs.count() <= few:
        return arcs.withColumn("list", F.lit(0)).groupBy("list").applyInArrow(_ranked_here, "id long, left long")
    # Rulers, and the end of the list, stay where they are; the others take over the pointer of what they point to until that is a ruler's.
    stays = F.pmod(F.xxhash64(F.lit(level), "id"), F.lit(every)) == 0
    points = F.pmod(F.xxhash64(F.lit(level), "next"), F.lit(every)) == 0
    marked = staged(arcs.select("id", "next", "steps", (stays | F.col("next").isNull()).alias("ruler"), (points | F.col("next").isNull()).alias("there")), f"tour-{level}-marked")
    ends = staged(marked.where("next is null").select(F.col("id").alias("end")), f"tour-{level}-end")
    marked = marked.join(F.broadcast(ends), marked["next"] == ends["end"], "left").withColumn("there", F.col("there") | F.col("end").isNotNull()).drop("end")
    done, live = marked.where("there"), staged(marked.where("not there").select("id", "next", "steps", "ruler"), f"tour-{level}-live")
    done = [staged(done.select("id", "next", "steps", "ruler"), f"tour-{level}-done")]
    round_ = 0
    while not live.isEmpty():
        # A ruler's own pointer moves too, but nobody goes past a ruler.
        ahead = live.withColumn("there", F.lit(False))
        for d in done:
            ahead = ahead.unionByName(d.withColumn("there", F.lit(True)))
        ahead = ahead.where("not ruler").select(F.col("id").alias("at"), F.col("next").alias("to"), F.col("steps").alias("more"), "there")
        moved = live.join(ahead, live["next"] == ahead["at"]).select("id", F.col("to").alias("next"), (F.col("steps") + F.col("more")).alias("steps"), "ruler", "there")
        moved = staged(moved, f"tour-{level}-{round_}")
        done.append(moved.where("there").drop("there"))
        live, round_ = moved.where("not there").drop("there"), round_ + 1
    settled = done[0]
    for d in done[1:]:
        settled = settled.unionByName(d)
    settled = staged(settled, f"tour-{level}-settled")
    rulers = _ranked(staged(settled.where("ruler").select("id", "next", "steps"), f"tour-{level}-rulers"), few, every, level + 1)
    rulers = staged(rulers, f"tour-{level}-ranked")
    others = settled.where("not ruler").join(rulers.select(F.col("id").alias("next"), "left"), "next").select("id", (F.col("left") + F.col("steps")).alias("left"))
    return rulers.unionByName(others)


def _ranked_here(table: pa.Table) -> pa.Table:
    """The rank of a short list, by the same doubling of pointers."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids)
    ids, steps = ids[order], table.column("steps").to_numpy()[order].copy()
    to = table.column("next").to_pandas().to_numpy(np.float64, na_value=-1)[order]
    at = np.where(to < 0, np.arange(len(ids)), np.searchsorted(ids, to.astype(np.int64)))
    while (at[at] != at).any():
        steps = steps + np.where(at[at] != at, steps[at], 0)
        at = at[at]
    return pa.table({"id": ids, "left": steps})


def sums_below(nodes: DataFrame, kids: DataFrame, few: int = FEW, every: int = EVERY) -> DataFrame:
    """id, n_leaves, saved_tokens over the subtree of each node, by prefix sums at the places of its two arcs."""
    left = ranked(tour(nodes, kids), few, every)
    worth = nodes.join(kids.select("node", "n_children"), "node", "left").select(
        (F.col("id") * 2).alias("id"), F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    )
    arcs = left.join(worth, "id", "left").select("id", "left", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("leaf", "saved")))
    # Counted from the end of the tour; a subtree's enter arc stands before its exit arc, so its sum is that of the arcs from the one up to the other.
    arcs = staged(arcs.withColumn("slot", F.expr(f"left DIV {SLOT}")), "tour-arcs")
    inside = W.partitionBy("slot").orderBy("left").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(F.lit(0)).orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    slots = arcs.groupBy("slot").agg(F.sum("leaf").alias("b_leaf"), F.sum("saved").alias("b_saved"))
    slots = slots.select("slot", *(F.coalesce(F.sum(f"b_{c}").over(before), F.lit(0)).alias(f"p_{c}") for c in ("leaf", "saved")))
    sums = arcs.withColumns({f"s_{c}": F.sum(c).over(inside) for c in ("leaf", "saved")}).join(slots, "slot")
    sign = F.when(F.col("id") % 2 == 0, 1).otherwise(-1)
    total = {n: F.sum(sign * (F.col(f"s_{c}") + F.col(f"p_{c}"))).alias(n) for n, c in (("n_leaves", "leaf"), ("saved_tokens", "saved"))}
    return sums.groupBy(F.expr("id DIV 2").alias("id")).agg(*total.values())


def ends_of(places: DataFrame, ids: DataFrame) -> DataFrame:
    """node, ends_sha256 of the conversations that end at each node.

    Ids are joined to strings in chunks of neighbouring ids; a hash takes its bytes in order, so the chunks of one node stream through one task, never held together.
    """
    last = places.join(ids.select("conv_id", F.col("n").alias("k")), ["conv_id", "k"]).select("node", "conv_id")
    last = last.unionByName(ids.where("n = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    chunks = last.groupBy("node", F.floor(F.col("conv_id") / IDS).alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    chunks = chunks.select("node", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for name, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != node:
                    if state:
                        out.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256(part.encode())
                else:
                    state.update(b"," + part.encode())
            yield _digests(out)
        if state:
            yield _digests([(node, state.hexdigest())])

    return chunks.repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids").mapInArrow(run, "node string, ends_sha256 string")


def _digests(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["node", "ends_sha256"])


def prefix_trie(conversations: DataFrame, few: int = FEW, every: int = EVERY) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, ids = rebuilt(turns_of(conversations))
    places = staged(prefixes(turns), "trie-places")
    nodes, kids = numbered(nodes_of(places, ids))
    below = sums_below(nodes, kids, few, every)
    # A parent is sent to each slot of ids that its children fill, so that no key has more than SLOT of them.
    above = kids.join(nodes.select("node", "conv_id"), "node").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.explode(F.sequence(F.expr(f"first DIV {SLOT}"), F.expr(f"last DIV {SLOT}"))).alias("slot")
    )
    out = nodes.withColumn("slot", F.expr(f"id DIV {SLOT}")).join(above, ["parent", "slot"], "left").join(kids.select("node", "n_children"), "node", "left")
    out = out.join(below, "id").join(ends_of(places, ids), "node", "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
