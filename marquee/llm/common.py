"""Shared helpers: reading tables, words and their hashes, Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIX = np.uint64(0xBF58476D1CE4E5B9)
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)

#: Bytes of an Arrow batch: each task holds a few of them on both sides.
BATCH_BYTES = 2 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session: the number of buckets that work is dealt into."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered; forgets everything beyond ``bound`` words so that memory stays bounded."""

    def __init__(self, bound: int = 60_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def plain_words(text: str | None) -> list[bytes]:
    """Words between white space (space, tab to carriage return), A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """One hash per run of ``k`` words, in order; the whole sequence as one when there are fewer words; none without words."""
    k = min(k, len(h))
    if k == 0:
        return np.empty(0, np.uint64)
    n = len(h) - k + 1
    out = np.full(n, 0x9E3779B97F4A7C15 ^ k, np.uint64)
    for i in range(k):
        out = (out ^ mixed(h[i : i + n] + np.uint64(i))) * ODD[i % len(ODD)]
        out ^= out >> np.uint64(32)
    return mixed(out)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on hands rows to Python in Arrow batches of about ``BATCH_BYTES``, whatever the width of a row. Without a
    bound in bytes a batch has 10,000 rows, which for packed blocks is all of a task's input, several times over in the JVM and once more in
    Python. A bound that the session sets itself stays. Plans run later than they are built, so the setting is not taken back."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF, None) is None:
        conf.set(BATCH_CONF, str(BATCH_BYTES))
    return df


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(batch) -> dict of column lists, or None`` for each Arrow batch, with the columns of ``schema``."""
    from pyspark.sql.types import StructType

    target = arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield pa.RecordBatch.from_arrays([as_array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that a task holds few texts as Python objects at a time."""
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def doc_columns(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that further columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
