"""Substring dedup by paragraphs.

Two kinds of paragraphs are looked for in more than one document:

* **lines** of at least ``min_words`` words. MinHash signatures of their five-word shingles are cut into ``BANDS`` bands of ``ROWS`` values: two lines
  with a Jaccard similarity of 0.8 share a band in more than 99.6 % of cases. Lines that share one are joined, the exact Jaccard of all that
  were joined is verified (``jaccard.set_links``), and components of links are clusters.
* **windows** of ``min_words`` words across lines, wherever they begin. Anchors are chosen from the words alone (winnowing: of each window the smallest
  hash of its runs of half as many words), so equal windows have equal anchors. The windows whose anchor several documents have are compared by their own
  hashes: a passage goes from its first to its last word, since each of its words lies in such a window.

Of each cluster the paragraph of the smallest ``doc_id`` stays (ties: the first row), those of other documents go. What a document repeats of
itself stays. Each window counts by itself: it stays in the first document that has it. Only lines that may repeat are ever rows of a table; anchors are
counted in blocks (``blocks.with_counts``), and each block sends the first place of each of its windows in packed arrays.

NULL texts stay NULL, empty ones empty. Repeated rows are documents of their own: the second loses what it repeats of the first. A text that is
all repeats becomes empty; its row stays. A NULL ``doc_id`` comes after all others. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.blocks import bucket_of, buckets, counts_of, in_blocks, rows_of, with_counts
from marquee.llm.common import in_small_batches, mixed, shingles, starts_of
from marquee.llm.components import components
from marquee.llm.jaccard import set_links
from marquee.session import passing, staged

BANDS, ROWS = 8, 3
PERCENT = 80
SHINGLE = 5
BASE = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(5).integers(0, 2**64, (2, BANDS * ROWS), np.uint64)
FLIPS, MULTIPLIERS = _RANDOM[0], _RANDOM[1] | np.uint64(1)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


#: Place of a document without an id: after all others.
LAST = 2**63 - 1


class WordCodes(dict):
    """64-bit hash of a word's lower-case form."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 60_000:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word.lower())
        return code


class Powers:
    """Powers of the base of run hashes and of its inverse, as far as a document needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, BASE))])
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, INVERSE))])


def _codes(text: str | None, memo: WordCodes) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words, and the words at which lines begin (one more place at the end)."""
    lines = [line.split() for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]
    words = [w for line in lines for w in line]
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)), np.unique(starts_of(np.array([len(x) for x in lines], np.int64)))


def _hashes(codes: np.ndarray, powers: Powers, *widths: int) -> list[np.ndarray]:
    """The hashes of all runs of so many words, for each width."""
    n = len(codes)
    powers.grow(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(codes) * powers.down[:n], out=sums[1:])
    return [mixed((sums[w:] - sums[: n + 1 - w]) * powers.up[: n + 1 - w] + np.uint64(w) * BASE) for w in widths]


def _anchors(codes: np.ndarray, powers: Powers, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of one document's windows in order, and how many windows in a row have each."""
    if len(codes) < min_words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    width = (min_words + 1) // 2
    (least,) = _hashes(codes, powers, width)
    size, wanted = 1, min_words - width + 1
    while size < wanted:
        step = min(size, wanted - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[first], np.diff(np.append(first, len(least)))


def _lines(codes: list[np.ndarray], lines: list[np.ndarray], min_words: int):
    """Of all documents of a block the lines of ``min_words`` words: document, begin, end, band keys, and their shingles."""
    sizes = np.array([len(at) - 1 for at in lines], np.int64)
    doc = np.repeat(np.arange(len(lines)), sizes)
    begin = np.concatenate([at[:-1] for at in lines]) if len(lines) else np.empty(0, np.int64)
    end = np.concatenate([at[1:] for at in lines]) if len(lines) else np.empty(0, np.int64)
    wide = end - begin >= max(min_words, SHINGLE)
    doc, begin, end = doc[wide], begin[wide], end[wide]
    keys = np.zeros((len(doc), BANDS), np.uint64)
    if not len(doc):
        return doc, begin, end, keys, []
    # Shingles of the whole block at once; those that cross the end of a line are in no line's slice.
    place = starts_of(np.array([len(c) for c in codes], np.int64))[doc]
    every = shingles(np.concatenate(codes), SHINGLE)
    sets = [every[a:b] for a, b in zip((place + begin).tolist(), (place + end - SHINGLE + 1).tolist(), strict=True)]
    starts, all_ = starts_of(end - begin - SHINGLE + 1)[:-1], np.concatenate(sets)
    for band in range(BANDS):
        key = np.full(len(doc), band + 1, np.uint64)
        for row in range(ROWS):
            k = band * ROWS + row
            key = mixed(key * BASE + np.minimum.reduceat((all_ ^ FLIPS[k]) * MULTIPLIERS[k], starts))
        keys[:, band] = key
    return doc, begin, end, keys, sets


def _block(rows: pa.Table, min_words: int, memo: WordCodes):
    powers = Powers()
    pairs = [_codes(t, memo) for t in rows.column("text").to_pylist()]
    codes = [c for c, _ in pairs]
    return codes, [_anchors(c, powers, min_words) for c in codes], _lines(codes, [at for _, at in pairs], min_words)


def _places(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """What documents are ordered by: doc_id, rid."""
    return np.array([LAST if d is None else d for d in rows.column("doc_id").to_pylist()], np.int64), rows.column("rid").to_numpy()


def _first_places(keys: np.ndarray, doc_id: np.ndarray, rid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by key and place, and of each key its begin in that order and its number of entries."""
    order = np.lexsort((rid, doc_id, keys))
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.empty(0, np.int64)
    return order, first, np.diff(np.append(first, len(keys)))


def _repeated(blocks: DataFrame, min_words: int) -> DataFrame:
    """What may stand in several documents. For lines: block, rid, doc_id, begin, end, sid (names the shingle set), n, prefix (band keys
    seen again), tokens. For windows, by block and bucket: keys (sorted), and of each key the place of the block's first document, as ``at`` into
    ``places`` (all doc_ids, then all rids). For each block with such windows: ``rids`` of the documents that have them."""
    n_buckets = buckets(blocks)
    memo = WordCodes()  # filled by each task for itself

    def keys_of(rows: pa.Table):
        _, anchors, (doc, _, _, keys, _) = _block(rows, min_words, memo)
        lo, hi = np.searchsorted(doc, np.arange(len(anchors))), np.searchsorted(doc, np.arange(len(anchors)), side="right")
        for i, (h, _) in enumerate(anchors):
            yield np.unique(np.concatenate([h, keys[lo[i] : hi[i]].ravel()]))

    def look_up(block: int, rows: pa.Table, names: np.ndarray, counts: np.ndarray) -> dict:
        codes, anchors, (doc, begin, end, keys, sets) = _block(rows, min_words, memo)
        out: dict = {k: [] for k in ("block", "rid", "doc_id", "begin", "end", "sid", "n", "prefix", "tokens", "bucket", "keys", "at", "places", "rids")}
        rid, doc_id = rows.column("rid").to_pylist(), rows.column("doc_id").to_pylist()

        def add(**values):
            for k, column in out.items():
                column.append(block if k == "block" else values.get(k))

        again = counts_of(keys.ravel(), names, counts, n_buckets).reshape(keys.shape) >= 2
        for j in np.flatnonzero(again.any(axis=1)).tolist():
            i, tokens = int(doc[j]), np.unique(sets[j])
            add(rid=rid[i], doc_id=doc_id[i], begin=int(begin[j]), end=int(end[j]), sid=xxhash.xxh3_128_hexdigest(tokens.tobytes()), n=len(tokens), prefix=keys[j][again[j]].view(np.int64), tokens=tokens.astype("<u8").tobytes())
        powers = Powers()
        windows, owner = [], []
        for i, (h, times) in enumerate(anchors):
            met = counts_of(h, names, counts, n_buckets) >= 2
            if met.any():
                (w,) = _hashes(codes[i], powers, min_words)
                windows.append(np.unique(w[np.repeat(met, times)]))
                owner.append(i)
        if not owner:
            return out
        docs, rids = _places(rows)
        add(rids=rids[owner].astype("<i8").tobytes())
        w, of = np.concatenate(windows), np.repeat(owner, [len(x) for x in windows])
        order, first, _ = _first_places(w, docs[of], rids[of])
        w, of = w[order[first]], of[order[first]]
        bucket = bucket_of(w, n_buckets)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(n_buckets), side="right")
        start = 0
        for b, stop in enumerate(ends.tolist()):
            if stop > start:
                some, at = np.unique(of[order[start:stop]], return_inverse=True)
                add(bucket=b, keys=w[order[start:stop]].astype("<u8").tobytes(), at=at.astype("<u4").tobytes(), places=np.concatenate([docs[some], rids[some]]).astype("<i8").tobytes())
            start = stop
        return out

    schema = "block long, rid long, doc_id long, begin long, end long, sid string, n long, prefix array<long>, tokens binary, bucket int, keys binary, at binary, places binary, rids binary"
    return with_counts(blocks, keys_of, look_up, schema)


def _kept_elsewhere(table: pa.Table) -> pa.Table:
    """Of one bucket, for each block the windows whose first document is in another block, with that document's id."""
    keys, docs, rids = [], [], []
    for k, at, places in zip(*(table.column(c).to_pylist() for c in ("keys", "at", "places")), strict=True):
        keys.append(np.frombuffer(k, "<u8"))
        both = np.frombuffer(places, "<i8").reshape(2, -1)[:, np.frombuffer(at, "<u4")]
        docs.append(both[0])
        rids.append(both[1])
    source = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    keys, docs, rids = np.concatenate(keys), np.concatenate(docs), np.concatenate(rids)
    order, first, size = _first_places(keys, docs, rids)
    later = np.ones(len(keys), bool)
    later[first] = False
    keeper = np.repeat(docs[order[first]], size)[later]
    order = order[later]
    by = np.argsort(source[order], kind="stable")
    source, keys, keeper = source[order][by], keys[order][by], keeper[by]
    block, rows, start = table.column("block").to_pylist(), [], 0
    for i, stop in enumerate(np.searchsorted(source, np.arange(len(block)), side="right").tolist()):
        if stop > start:
            rows.append((block[i], keys[start:stop].astype("<u8").tobytes(), keeper[start:stop].astype("<i8").tobytes()))
        start = stop
    columns = list(zip(*rows, strict=True)) if rows else [()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["block", "keys", "keepers"])


def _others(found: DataFrame, cluster: str) -> DataFrame:
    """block, rid, begin, end, keeper: the paragraphs of each cluster that are not in the document that keeps it."""
    place = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), F.col("rid").alias("rid"))
    keepers = found.groupBy(cluster).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select(cluster, "first")
    joined = found.join(keepers, cluster).where(F.col("rid") != F.col("first.rid"))
    return joined.select("block", "rid", "begin", "end", F.col("first.doc_id").alias("keeper"))


def _paragraphs(blocks: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Staged: ``windows`` (block, keys, keepers) that a document of another block keeps, ``rids`` (block, rids) of the documents whose windows may repeat,
    ``lines`` (block, rid, doc_id, begin, end, sid) that may repeat, and their distinct ``sets`` (sid, n, prefix, tokens)."""
    with passing() as keep:
        found = staged(_repeated(blocks, min_words), "repeated")
        windows = found.where("bucket is not null").select("bucket", "block", "keys", "at", "places")
        windows = keep(staged(windows.groupBy("bucket").applyInArrow(_kept_elsewhere, "block long, keys binary, keepers binary"), "windows"))
        rids = keep(staged(found.where("rids is not null").select("block", "rids"), "rids"))
        lines = found.where("sid is not null")
        sets = lines.groupBy("sid").agg(F.min("n").alias("n"), F.min("prefix").alias("prefix"), F.min("tokens").alias("tokens"))
        sets = keep(staged(sets, "sets"))
        lines = keep(staged(lines.select("block", "rid", "doc_id", "begin", "end", "sid"), "lines"))
    return windows, rids, lines, sets


def repeats(blocks: DataFrame, min_words: int) -> DataFrame:
    """For each block what goes from it: ``lines`` (rid, begin, end, keeper: the document that keeps the line), ``windows`` (keys, keepers) that
    a document of another block keeps, and ``rids`` of the documents whose windows may repeat."""
    with passing() as keep:
        windows, rids, lines, sets = _paragraphs(blocks, min_words)
        linked = components(staged(set_links(sets, PERCENT), "links"))
        for table in (windows, rids, lines, linked):
            keep(table)
    named = lines.join(linked, F.col("sid") == F.col("node"), "left")
    others = _others(named.withColumn("cluster", F.coalesce("component", "sid")), "cluster")
    parts = others.select("block", F.struct("rid", "begin", "end", "keeper").alias("line"))
    parts = parts.unionByName(windows.select("block", F.struct("keys", "keepers").alias("window")), allowMissingColumns=True)
    parts = parts.unionByName(rids, allowMissingColumns=True)
    return parts.groupBy("block").agg(F.collect_set("line").alias("lines"), F.collect_list("window").alias("windows"), F.first("rids", ignorenulls=True).alias("rids"))


def _cut_windows(rows: pa.Table, rids: bytes | None, elsewhere: list[dict], min_words: int, memo: WordCodes) -> dict[int, list[tuple[int, int, int]]]:
    """By rid the begin, end and keeper of the runs of windows that another document keeps."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    wanted = set(np.frombuffer(rids or b"", "<i8").tolist())
    if not wanted:
        return out
    docs, names = _places(rows)
    mine = [i for i, r in enumerate(names.tolist()) if r in wanted]
    texts, powers = rows.column("text"), Powers()
    hashes = [_hashes(_codes(texts[i].as_py(), memo)[0], powers, min_words)[0] for i in mine]
    keys, owner = np.concatenate(hashes), np.repeat(mine, [len(h) for h in hashes])
    # The first document of the block that has each window, or the one elsewhere that comes before it.
    order, first, size = _first_places(keys, docs[owner], names[owner])
    head = owner[order[first]]
    keeper, stays = docs[head], names[head]
    if elsewhere:
        there = np.concatenate([np.frombuffer(w["keys"], "<u8") for w in elsewhere])
        kept_by = np.concatenate([np.frombuffer(w["keepers"], "<i8") for w in elsewhere])
        by = np.argsort(there)
        there, kept_by = there[by], kept_by[by]
        at = np.minimum(np.searchsorted(there, keys[order[first]]), len(there) - 1)
        gone = there[at] == keys[order[first]]
        keeper, stays = np.where(gone, kept_by[at], keeper), np.where(gone, -1, stays)
    kept = np.empty(len(keys), np.int64)
    kept[order] = np.repeat(keeper, size)
    cut = np.empty(len(keys), bool)
    cut[order] = np.repeat(stays, size) != names[owner[order]]
    start = 0
    for i, h in zip(mine, hashes, strict=True):
        gone, by = np.flatnonzero(cut[start : start + len(h)]), kept[start : start + len(h)]
        if len(gone):
            new = np.flatnonzero(np.concatenate([[True], (np.diff(gone) > 1) | (np.diff(by[gone]) != 0)]))
            last = np.append(new[1:], len(gone)) - 1
            out[int(names[i])] = list(zip(gone[new].tolist(), (gone[last] + min_words).tolist(), by[gone[new]].tolist(), strict=True))
        start += len(h)
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the spans of words (and the white space after each), the number of its words, and of those removed."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    gone = np.zeros(len(words) + 1, bool)
    for b, e in spans:
        gone[b:e] = True
    at, pieces, kept_from = 0, [], 0
    for i, w in enumerate(words):
        begin = data.index(w, at)
        if gone[i] and (i == 0 or not gone[i - 1]):
            pieces.append(data[kept_from:begin])
        elif not gone[i] and i and gone[i - 1]:
            kept_from = begin
        at = begin + len(w)
    if not gone[len(words) - 1]:
        pieces.append(data[kept_from:])
    out = b"".join(pieces)
    return (out.rstrip() if gone[len(words) - 1] else out).decode("utf-8", "surrogatepass"), len(words), int(gone.sum())


def remove_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """All columns of ``docs``, the text without its repeats, and ``n_words`` (before), ``n_removed`` (words), ``repeats_of`` (documents that keep
    what was removed, ascending). Columns of ``docs`` with these names give way."""
    from pyspark.sql.types import StructType

    from marquee.llm.common import arrow_schema

    new = "n_words long, n_removed long, repeats_of array<long>"
    docs = docs.drop("n_words", "n_removed", "repeats_of", "rid")
    blocks = in_blocks(docs.withColumn("rid", F.monotonically_increasing_id()), label="passages")
    cuts = repeats(blocks, min_words)
    memo = WordCodes()  # filled by each task for itself
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(new).fields])
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = rows_of(batch.column(0)[i].as_py())
                by = _cut_windows(rows, batch.column(3)[i].as_py(), batch.column(2)[i].as_py() or [], min_words, memo)
                for s in batch.column(1)[i].as_py() or []:
                    by.setdefault(s["rid"], []).append((s["begin"], s["end"], s["keeper"]))
                texts, words, removed, keepers = rows.column("text").to_pylist(), [], [], []
                for j, rid in enumerate(rows.column("rid").to_pylist()):
                    cut = by.get(rid, [])
                    if cut:
                        texts[j], n, gone = _without(texts[j], [(b, e) for b, e, _ in cut])
                    else:
                        n, gone = len((texts[j] or "").encode("utf-8", "surrogatepass").split()), 0
                    words.append(n)
                    removed.append(gone)
                    keepers.append(sorted({k for _, _, k in cut if k != LAST}))
                rows = rows.drop_columns(["rid"]).combine_chunks()
                columns = {name: rows.column(name).combine_chunks() for name in rows.column_names}
                columns |= {"text": pa.array(texts, target.field("text").type), "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
                columns["repeats_of"] = pa.array(keepers, target.field("repeats_of").type)
                arrays = [columns[f.name].cast(f.type) for f in target]
                yield pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], schema=target)

    joined = blocks.join(cuts, "block", "left").select("data", "lines", "windows", "rids")
    return in_small_batches(joined).mapInArrow(run, schema)
