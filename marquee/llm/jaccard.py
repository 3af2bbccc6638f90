"""Exact n-gram Jaccard self-join by grouped prefixes.

Words are runs without white space, A-Z lower-cased; a document's set holds its distinct runs of ``k`` words (hashed to 64 bits), the
whole sequence when it has fewer. Two documents link when 100 * |intersection| >= percent * |union|.

1. Shingles are ordered by how many documents have them, rarest first, those whose hash is below ``EARLY`` before all others. Documents
   that link share a shingle of their prefixes, the first |x| - ceil(t |x|) + 1 in this order. The prefix of nearly all documents lies among the early
   shingles, so only those are counted, and the others just for documents with too few (``blocks.with_counts``). A shingle
   of one document alone links nothing, so most documents have no candidates at all.
2. Equal sets are one class; classes with equal prefix and size are one group. Groups that share a prefix shingle form families:
   stars around the smallest group of each shingle, put together as components.
3. Families are expanded to their sets, which are dealt by size into bands (only neighbouring bands can link), and each set is verified against its
   band's and the next band's first set. What links to a first set is in its component already. Sets are then dealt into blocks of about
   ``BLOCK`` and pairs of blocks that are not yet in one component are verified whole, by one matrix product each. No pair of documents is
   ever a row; what comes out of a pair of blocks is a spanning set of its links.

NULL and empty texts have no set and link with nothing. Rows that repeat a ``doc_id`` are documents of their own and share its
component if equal. Columns beyond ``doc_id`` and ``text`` are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.blocks import buckets, counts_of, in_blocks, with_counts
from marquee.llm.common import WordHashes, doc_columns, in_small_batches, plain_words, shingles
from marquee.llm.components import components
from marquee.session import passing, staged

#: Shingles with a smaller hash come first in the order: two fifths of them.
EARLY = np.uint64(2 * 2**64 // 5)
#: Sets in a block: two blocks of tokens and their product stay within some tens of MB.
BLOCK = 256


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _counted(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The shingles that the prefix is taken from."""
    early = tokens[: np.searchsorted(tokens, EARLY)]
    return early if len(early) >= _prefix_length(len(tokens), percent) else tokens


def _sets(rows: pa.Table, k: int, memo: WordHashes) -> list[np.ndarray]:
    return [np.unique(shingles(memo.of(plain_words(t)), k)) for t in rows.column("text").to_pylist()]


def _signature(tokens: np.ndarray) -> bytes:
    """128 bits and the size: equal for equal sets whatever their order."""
    other = (tokens ^ (tokens >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    other ^= other >> np.uint64(32)
    return len(tokens).to_bytes(6, "big") + int(tokens.sum(dtype=np.uint64)).to_bytes(8, "big") + int(other.sum(dtype=np.uint64)).to_bytes(8, "big")


def shingle_sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n (size), sid (names the set; NULL when empty), and for one document of each set and block that may have
    candidates: ``prefix`` (its shingles that other documents share, by rank) and ``tokens``."""
    blocks = in_blocks(doc_columns(docs), label="jaccard")
    n_buckets = buckets(blocks)
    memo = WordHashes(60_000)  # filled by each task for itself

    def keys_of(rows: pa.Table):
        seen = set()
        for tokens in _sets(rows, k, memo):
            sid = _signature(tokens)
            if sid not in seen:
                seen.add(sid)
                yield _counted(tokens, percent)

    def look_up(block: int, rows: pa.Table, names: np.ndarray, counts: np.ndarray) -> dict:
        sets = _sets(rows, k, memo)
        out: dict = {"doc_id": rows.column("doc_id"), "n": [len(s) for s in sets], "sid": [], "prefix": [], "tokens": []}
        sids = [_signature(s) if len(s) else None for s in sets]
        done = set()
        for sid, s in zip(sids, sets, strict=True):
            prefix = tokens = None
            if sid is not None and sid not in done:
                done.add(sid)
                some = _counted(s, percent)
                times = counts_of(some, names, counts, n_buckets)
                order = np.lexsort((some, times, some >= EARLY))[: _prefix_length(len(s), percent)]
                ranked = some[order[times[order] >= 2]]
                if len(ranked):
                    prefix, tokens = ranked.view(np.int64), s.astype("<u8").tobytes()
            out["sid"].append(sid.hex() if sid is not None else None)
            out["prefix"].append(prefix)
            out["tokens"].append(tokens)
        return out

    return with_counts(blocks, keys_of, look_up, "doc_id long, n long, sid string, prefix array<long>, tokens binary")


def _spanning(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric boolean matrix the smallest node that it reaches."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets link, by counting shared tokens with matrix products over slices of the vocabulary."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    _, inverse, times = np.unique(tokens, return_inverse=True, return_counts=True)
    keep = times[inverse] > 1
    inverse, owner = inverse[keep], owner[keep]
    _, inverse = np.unique(inverse, return_inverse=True)
    shared = np.zeros((m, m), np.float32)
    order = np.argsort(inverse, kind="stable")
    inverse, owner = inverse[order], owner[order]
    width, top = 4096, int(inverse[-1]) + 1 if len(inverse) else 0
    for begin in range(0, top, width):
        lo, hi = np.searchsorted(inverse, [begin, begin + width])
        part = np.zeros((m, min(width, top - begin)), np.float32)
        part[owner[lo:hi], inverse[lo:hi] - begin] = 1
        shared += part @ part.T
    common = shared.astype(np.int64)
    out = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    np.fill_diagonal(out, False)
    return out


def _verify(percent: int):
    """One edge from each set of a group of sets (sid, tokens) to the smallest that it reaches by links inside the group."""

    def run(table: pa.Table) -> pa.Table:
        sids = table.column("sid").to_pylist()
        sets = [np.frombuffer(t, "<u8") for t in table.column("tokens").to_pylist()]
        label = _spanning(_links(sets, percent)) if len(sets) > 1 else np.arange(len(sets))
        ends = [(sids[i], sids[j]) for i, j in enumerate(label.tolist()) if i != j]
        return pa.table({"a": pa.array([a for a, _ in ends], pa.string()), "b": pa.array([b for _, b in ends], pa.string())})

    return run


def _overlap(percent: int):
    """The rows (a, ta, b, tb) whose two sets link."""

    def run(batches):
        for batch in batches:
            a, ta, b, tb = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for i, (x, y) in enumerate(zip(ta, tb, strict=True)):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.string()), pa.array([b[i] for i in keep], pa.string())], names=["a", "b"])

    return run


def set_links(sets: DataFrame, percent: int) -> DataFrame:
    """a, b: edges between linked sets that connect whatever is connected by links. ``sets``: sid, n, prefix, tokens, one row each."""
    grouped = sets.withColumn("gid", F.xxhash64("n", "prefix"))
    postings = staged(grouped.select("gid", F.explode("prefix").alias("key")).distinct(), "postings")
    hubs = postings.groupBy("key").agg(F.min("gid").alias("hub"), F.count("*").alias("c")).where("c > 1").select("key", "hub")
    stars = postings.join(hubs, "key").where("gid <> hub").select(F.col("gid").alias("a"), F.col("hub").alias("b"))
    families = components(stars)
    ratio = math.log(100 / percent)
    # A group of several sets is a family even if no other group shares a shingle with it.
    members = grouped.join(families, F.col("gid") == F.col("node"), "left").select(
        "sid", "n", "tokens", F.coalesce("component", "gid").alias("family"), F.floor(F.log("n") / F.lit(ratio)).alias("band")
    )
    crowds = members.groupBy("family").agg(F.count("*").alias("c")).where("c > 1").select("family")
    members = staged(members.join(crowds, "family"), "members")

    # The first set of each band of a family, against its own band and the one above.
    firsts = members.groupBy("family", "band").agg(F.min("sid").alias("b"))
    firsts = firsts.join(members.select(F.col("sid").alias("b"), F.col("tokens").alias("tb")), "b")
    reach = firsts.select("family", F.explode(F.array("band", F.col("band") + 1)).alias("band"), "b", "tb")
    tried = members.select("family", "band", F.col("sid").alias("a"), F.col("tokens").alias("ta")).join(reach, ["family", "band"]).where("a <> b")
    first_links = staged(in_small_batches(tried.select("a", "ta", "b", "tb")).mapInArrow(_overlap(percent), "a string, b string"), "links")
    met = components(first_links)

    spread = members.join(met, F.col("sid") == F.col("node"), "left").select("family", "band", "sid", "tokens", F.coalesce("component", F.lit("")).alias("met"))
    of = ["family", "band", "met"]
    crowd = spread.groupBy(of).agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("slots"))
    spread = spread.join(crowd, of).withColumn("slot", F.pmod(F.xxhash64("sid"), "slots"))
    cells = spread.groupBy(*of, "slot").agg(F.count("*").alias("c"))
    one = cells.select("family", *(F.col(c).alias(f"{c}1") for c in ("band", "met", "slot", "c")))
    two = cells.select("family", *(F.col(c).alias(f"{c}2") for c in ("band", "met", "slot", "c")), F.explode(F.array("band", F.col("band") - 1)).alias("band1"))
    later = (F.col("band2") > F.col("band1")) | (F.struct("met1", "slot1") <= F.struct("met2", "slot2"))
    apart = (F.col("met1") == "") | (F.col("met1") != F.col("met2"))
    itself = (F.col("band1") == F.col("band2")) & (F.col("met1") == F.col("met2")) & (F.col("slot1") == F.col("slot2"))
    pairs = one.join(two, ["family", "band1"]).where(later & apart & ~(itself & (F.col("c1") < 2)))
    pairs = pairs.withColumn("pair", F.xxhash64("family", "band1", "met1", "slot1", "band2", "met2", "slot2"))
    sides = pairs.select("family", "pair", F.explode(F.array(*(F.struct(*(F.col(f"{c}{i}").alias(c) for c in ("band", "met", "slot"))) for i in (1, 2)))).alias("s"))
    sides = sides.select("family", "pair", "s.*").distinct()
    dealt = spread.join(sides, [*of, "slot"]).select("pair", "sid", "tokens")
    return first_links.union(dealt.groupBy("pair").applyInArrow(_verify(percent), "a string, b string"))


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach), class_id (the smallest doc_id with the same set)."""
    with passing() as keep:
        sets = keep(staged(shingle_sets(docs, k, percent), "sets"))
    # All rows of a set hold the same; min_by would leave out those without a doc_id.
    one = sets.where("prefix is not null").groupBy("sid").agg(F.first(F.struct("n", "prefix", "tokens")).alias("s")).select("sid", "s.*")
    with passing() as keep:
        found = keep(components(staged(set_links(staged(one, "classes"), percent), "links")))
    named = sets.where("sid is not null").select("doc_id", "n", "sid")
    classes = named.groupBy("sid").agg(F.min("doc_id").alias("class_id"))
    classes = classes.join(found, F.col("sid") == F.col("node"), "left").withColumn("component", F.coalesce("component", "sid"))
    smallest = classes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    classes = classes.join(smallest, "component").select("sid", "class_id", "component_id")
    full = named.join(classes, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id")
    none = sets.where("sid is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    return full.unionByName(none)
