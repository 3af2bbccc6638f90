"""Document fingerprints from Lempel-Ziv phrases.

A text's UTF-8 bytes are parsed once from left to right: each phrase is the longest one seen before plus one byte. The hashes of the
phrases are dealt into ``BINS`` bins and the smallest of each bin is kept, so two fingerprints agree in about as many bins as their
texts share phrases; texts that one dictionary compresses well together are alike.

NULL and empty texts have no phrase: they are alike (1) among themselves and unlike (0) all others. A fingerprint is a string of
``BINS`` groups of four hexadecimal digits, ``0000`` for a bin without a phrase.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import doc_columns, mixed, partitions

BINS = 64
MULTIPLIER = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


class Parse:
    """Phrases so far, as a tree: ``tree`` leads from node and byte to a node, ``hashes`` has the hash of each node's phrase."""

    def __init__(self) -> None:
        self.tree: dict[int, int] = {}
        self.hashes: list[int] = [0x243F6A8885A308D3]
        self.node = 0

    def feed(self, data: bytes) -> None:
        tree, hashes, node = self.tree, self.hashes, self.node
        get = tree.get
        for c in data:
            key = node << 8 | c
            node = get(key, 0)
            if not node:
                tree[key] = len(hashes)
                hashes.append((hashes[key >> 8] * MULTIPLIER + c + 1) & MASK)
        self.node = node

    def signature(self) -> np.ndarray:
        """Smallest 16-bit value of each bin, from 1; 0 where a bin is empty. An unfinished last phrase is one that is there already."""
        return _smallest(mixed(np.array(self.hashes[1:], np.uint64)))

    def fork(self) -> Parse:
        other = Parse()
        other.tree, other.hashes, other.node = self.tree.copy(), self.hashes.copy(), self.node
        return other


def _smallest(h: np.ndarray) -> np.ndarray:
    out = np.zeros(BINS, np.uint16)
    if len(h):
        h = np.sort(h)
        bins, first = np.unique(h % np.uint64(BINS), return_index=True)
        # The smallest hash of a bin, seen through 16 bits that played no part in the order.
        out[bins.astype(np.int64)] = (mixed(h[first]) % np.uint64(0xFFFF)).astype(np.uint16) + 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    either = int(((a > 0) | (b > 0)).sum())
    return float(((a == b) & (a > 0)).sum() / either) if either else 1.0


def text_of(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprint(text: str | None) -> np.ndarray:
    p = Parse()
    p.feed((text or "").encode("utf-8", "surrogatepass"))
    return p.signature()


def edited(text: str, following: str) -> tuple[str, str]:
    """What stays of ``text`` and what takes the place of its last third: the beginning of the following text."""
    third = len(text) // 3
    return text[: len(text) - third], following[:third]


def _ranged(docs: DataFrame) -> DataFrame:
    """doc_id, text, key (the id, NULL as the smallest), range, guest: rows dealt into ranges of falling ids.

    Ranges are cut at quantiles of the ids; the driver gets one id for each range. The rows with the largest id of a range are
    guests of the range before it, those of the first range guests of the last, so each range holds what follows its last row.
    """
    n = partitions(docs)
    rows = docs.withColumn("key", F.coalesce("doc_id", F.lit(-(2**63))))
    cuts = np.unique(np.array(rows.stat.approxQuantile("key", [i / n for i in range(1, n)], 0.2 / n), np.int64)) if n > 1 else np.empty(0, np.int64)

    # Looked up in a sorted array: only the key goes to Python, and the plan does not grow with the number of ranges.
    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, key.to_numpy(np.int64), side="right"))

    tops = {r["range"]: r["top"] for r in rows.groupBy(range_of("key").alias("range")).agg(F.max("key").alias("top")).collect()}
    order = sorted(tops)
    hosts = {tops[r]: order[i - 1] for i, r in enumerate(order)}  # largest id of a range: the range before

    @F.pandas_udf("array<int>")
    def places_of(key: pd.Series) -> pd.Series:
        own = len(cuts) - np.searchsorted(cuts, key.to_numpy(np.int64), side="right")
        return pd.Series([[r] if k not in hosts else [r, hosts[k]] for k, r in zip(key.tolist(), own.tolist(), strict=True)])

    out = rows.select("doc_id", "text", "key", F.posexplode(places_of("key")).alias("guest", "range"))
    return out.repartitionById(max(order, default=0) + 1, F.col("range"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of ``docs``.

    The document that follows is the next in the order of falling ``doc_id`` (rows of one id by text, NULL ids last); the first
    follows the last. A single document follows itself.
    """
    rows = _ranged(doc_columns(docs).withColumn("text", F.coalesce("text", F.lit("")))).sortWithinPartitions("range", "guest", F.desc("key"), "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches):
        last = None  # the row whose follower is still to come
        for batch in batches:
            out = []
            for doc_id, text, guest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if guest and last is None:
                    continue
                kept, _ = edited(text, "")
                parse = Parse()
                parse.feed(kept.encode())
                fork = None if guest else parse.fork()
                parse.feed(text[len(kept) :].encode())
                own = parse.signature()
                if last is not None:
                    id_, kept_, third, fork_, sig = last
                    new = text[:third].encode()
                    fork_.feed(new)
                    changed = fork_.signature()
                    sha = hashlib.sha256(kept_.encode() + new).hexdigest()
                    out.append((id_, len(kept_) + third, sha, text_of(sig), text_of(changed), likeness(sig, changed), likeness(sig, own)))
                last = None if guest else (doc_id, kept, len(text) - len(kept), fork, own)
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.select("doc_id", "text", "guest").mapInArrow(run, schema)
