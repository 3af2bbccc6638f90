"""Counting keys over all documents without a row for each key.

Documents are packed into blocks of bounded text, each one row of a staged table (Arrow, zstd). For every block a task makes the distinct
64-bit keys of its documents with their counts, and deals them as packed arrays into buckets by key. A bucket adds the counts up and
returns to each block those of its keys that are seen at least twice over all documents; the block is then read again beside what
came back. A key in a third of all documents is one entry for each block, whoever holds it. Blocks and buckets are the only units
that a task holds: blocks are bounded by ``BLOCK_CHARS`` (or one document), buckets shrink as shuffle partitions grow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import in_small_batches, partitions
from marquee.session import staged

BLOCK_CHARS = 2_000_000
#: Bucket and low bits name a key in counting; two keys of one name are counted as one, which callers must bear.
BITS = np.uint64(40)
LOW = np.uint64((1 << 40) - 1)


def pack(names: np.ndarray) -> bytes:
    """Sorted 40-bit numbers: how many there are for each of the highest eight bits, then the lower four bytes of each."""
    counts = np.bincount((names >> np.uint64(32)).astype(np.int64), minlength=256).astype("<u4")
    return counts.tobytes() + (names & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()


def unpack(data: bytes) -> np.ndarray:
    counts = np.frombuffer(data, "<u4", 256)
    return np.repeat(np.arange(256, dtype=np.uint64) << np.uint64(32), counts) | np.frombuffer(data, "<u4", offset=1024)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(48)) % np.uint64(n)).astype(np.int64)


def named(keys: np.ndarray, n: int) -> np.ndarray:
    """The name by which a key is counted: its bucket above its low 40 bits."""
    return (bucket_of(keys, n).astype(np.uint64) << BITS) | (keys & LOW)


def in_blocks(rows: DataFrame, text: str = "text", label: str = "blocks") -> DataFrame:
    """Staged table (block, data) of all columns of ``rows``, cut where the texts of a block come to ``BLOCK_CHARS``."""
    place = rows.columns.index(text)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, size
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(pa.Table.from_batches(held).combine_chunks())
            out = pa.RecordBatch.from_arrays([pa.array([(part << 32) | seq]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "data"])
            held.clear()
            seq, size = seq + 1, 0
            return out

        for batch in batches:
            lengths = np.fromiter((len(t) if t is not None else 0 for t in batch.column(place).to_pylist()), np.int64, batch.num_rows)
            begin = 0
            for i, n in enumerate(lengths.tolist()):
                if size and size + n > BLOCK_CHARS:
                    if i > begin:
                        held.append(batch.slice(begin, i - begin))
                    begin = i
                    yield flush()
                size += n
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield flush()

    return staged(in_small_batches(rows).mapInArrow(cut, "block long, data binary"), label)


def rows_of(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def seen_again(blocks: DataFrame, keys_of: Callable[[pa.Table], Iterable[np.ndarray]], n: int) -> DataFrame:
    """(block, bucket, names, counts): for each block those of its keys that at least two documents have, packed, with their
    counts up to 65535.

    ``keys_of`` gives the distinct keys of each document of a block, one array for each.
    """

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lists = list(keys_of(rows_of(data.as_py())))
                keys = np.sort(named(np.concatenate(lists) if lists else np.empty(0, np.uint64), n))
                del lists
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
                counts = np.diff(np.append(first, len(keys)))
                keys = keys[first]
                ends = np.searchsorted(keys, np.arange(1, n + 1, dtype=np.uint64) << BITS)
                out: list[list] = [[], [], [], [], []]
                begin = 0
                for b, end in enumerate(ends.tolist()):
                    if end > begin:
                        c = counts[begin:end]
                        more = np.flatnonzero(c > 1)
                        for o, v in zip(out, (b, block, pack(keys[begin:end] & LOW), more.astype("<u4").tobytes(), c[more].astype("<i8").tobytes()), strict=True):
                            o.append(v)
                    begin = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), *(pa.array(o, pa.binary()) for o in out[2:])], names=["bucket", "block", "keys", "more", "extra"]
                )

    def add_up(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        owner = table.column("block").to_numpy()
        parts = [unpack(x) for x in table.column("keys").to_pylist()]
        counts = []
        for keys, at, extra in zip(parts, table.column("more").to_pylist(), table.column("extra").to_pylist(), strict=True):
            c = np.ones(len(keys), np.int64)
            c[np.frombuffer(at, "<u4")] = np.frombuffer(extra, "<i8")
            counts.append(c)
        lengths = np.array([len(p) for p in parts])
        keys, count = np.concatenate(parts), np.concatenate(counts)
        del parts, counts
        order = np.argsort(keys, kind="stable")
        keys, count = keys[order], count[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        total = np.add.reduceat(count, first)
        size = np.diff(np.append(first, len(keys)))
        again = np.repeat(total >= 2, size)
        keys, total, order = keys[again], np.repeat(total, size)[again], order[again]
        source = np.repeat(np.arange(len(lengths)), lengths)[order]
        by = np.argsort(source, kind="stable")
        keys, total, source = keys[by], np.minimum(total[by], 65535).astype("<u2"), source[by]
        ends = np.searchsorted(source, np.arange(len(lengths)), side="right")
        rows, begin = [], 0
        for i, end in enumerate(ends.tolist()):
            if end > begin:
                rows.append((int(owner[i]), bucket, pack(keys[begin:end]), total[begin:end].tobytes()))
            begin = end
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        types = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["block", "bucket", "names", "counts"])

    dealt = in_small_batches(blocks).mapInArrow(deal, "bucket int, block long, keys binary, more binary, extra binary")
    return dealt.groupBy("bucket").applyInArrow(add_up, "block long, bucket int, names binary, counts binary")


def with_counts(blocks: DataFrame, keys_of: Callable[[pa.Table], Iterable[np.ndarray]], fn: Callable[[int, pa.Table, np.ndarray, np.ndarray], dict | None], schema: str) -> DataFrame:
    """``fn(block, rows, names, counts)`` for each block, with the sorted names and counts of its keys that are seen again; rows of ``schema``.

    ``fn`` looks its keys up by ``named(keys, n)`` with the ``n`` that ``buckets(blocks)`` gives.
    """
    from pyspark.sql.types import StructType

    from marquee.llm.common import arrow_schema, as_array

    n = buckets(blocks)
    target = arrow_schema(StructType.fromDDL(schema))
    pieces = seen_again(blocks, keys_of, n).groupBy("block").agg(F.collect_list(F.struct("bucket", "names", "counts")).alias("pieces"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                got = batch.column(1)[i].as_py() or []
                names = np.concatenate([unpack(p["names"]) | np.uint64(p["bucket"]) << BITS for p in got]) if got else np.empty(0, np.uint64)
                counts = np.concatenate([np.frombuffer(p["counts"], "<u2") for p in got]) if got else np.empty(0, np.uint16)
                order = np.argsort(names)
                out = fn(batch.column(2)[i].as_py(), rows_of(batch.column(0)[i].as_py()), names[order], counts[order])
                if out is not None:
                    yield pa.RecordBatch.from_arrays([as_array(out[f.name], f.type) for f in target], schema=target)

    joined = blocks.join(pieces, "block", "left").select("data", "pieces", "block")
    return in_small_batches(joined).mapInArrow(run, schema)


def buckets(blocks: DataFrame) -> int:
    return min(partitions(blocks), 65536)


def counts_of(keys: np.ndarray, names: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """How many documents have each key: 1 unless it was seen again."""
    if not len(names):
        return np.ones(len(keys), np.int64)
    wanted = named(keys, n)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return np.where(names[at] == wanted, counts[at], 1).astype(np.int64)
