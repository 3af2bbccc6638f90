"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated probabilities.

* **Word vectors.** A token falls into one of ``TOKENS`` hash slots, each with a fixed sparse vector of -1, 0 and 1. A slot's word vector is
  the sum of the fixed vectors of the tokens up to two places beside its own, over all documents. The sums are whole
  numbers, so they do not depend on the order in which tasks are added up. The table has a fixed size (``TOKENS`` x ``DIM``), whatever the corpus.
* **Pooling.** A document is the mean vector of its tokens, the mean of its distinct tokens, and the share and number of those.
* **Network.** ``DIM`` * 2 + 2 inputs, one hidden layer, one output; fitted by Adam on at most ``sample`` labelled documents, those first in
  the order of a hash of their id. A fifth of them is held back to fit the temperature of the output.

Tokens are runs of letters and digits (case folded; a word all in capitals is marked by a token of its own) and runs of other characters. NULL
and empty texts have a zero vector and a score like all others. Rows that repeat a ``doc_id`` are scored each; several labels of one
document count as their majority (ties: 1). Without two classes of labels every score is the share of label 1 (0.5 without any).
Labels are the only columns that the fit sees besides ``text``; ``lang``, ``source`` and ``doc_id`` are no inputs of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import WordHashes, doc_columns, in_small_batches, slices, starts_of, texts_of

TOKENS = 1 << 15
DIM = 32
SEED = 11
#: Tokens of documents whose vectors are held at once, in several copies of 128 bytes a token.
RUN = 25_000
#: Tokens summed up at once of a document with more than four times as many.
CHUNK = 100_000
SLICES = 32
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
CAPS = "\x00caps"


def _index_vectors() -> np.ndarray:
    """One sparse vector for each slot, eight of its places -1 or 1; the last row, for the edges of documents, is zero."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((TOKENS + 1, DIM), np.float32)
    places = np.argsort(rng.random((TOKENS, DIM)), axis=1)[:, :8]
    out[np.arange(TOKENS)[:, None], places] = rng.choice(np.array([-1, 1], np.float32), (TOKENS, 8))
    return out


class Slots(dict):
    """Hash slot of a token, remembered up to a bound."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes = WordHashes(1)

    def __missing__(self, token: str) -> int:
        if len(self) > 60_000:
            self.clear()
        s = self[token] = self.hashes[token.lower().encode("utf-8", "surrogatepass")] % TOKENS
        return s


def _slots(text: str, memo: Slots) -> np.ndarray:
    tokens = TOKEN.findall(text)
    out = np.fromiter(map(memo.__getitem__, tokens), np.int32, len(tokens))
    caps = sum(1 for t in tokens if len(t) > 1 and t.isupper())
    return np.concatenate([out, np.full(caps, memo[CAPS], np.int32)]) if caps else out


def _chunks(arrays: list[np.ndarray]):
    """Runs of documents with about ``RUN`` tokens, longer documents alone."""
    begin = size = 0
    for i, a in enumerate(arrays):
        if size and size + len(a) > RUN:
            yield begin, i
            begin, size = i, 0
        size += len(a)
    if begin < len(arrays):
        yield begin, len(arrays)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The word vectors, each of length 1 or 0, from all documents."""

    def contexts(batches):
        from pyspark import TaskContext

        index, memo = _index_vectors(), Slots()
        total = np.zeros((TOKENS, DIM), np.float64)
        edge = np.full(2, TOKENS, np.int32)
        for batch in (part for whole in batches for part in slices(whole)):
            arrays = [_slots(t, memo) for t in texts_of(batch)]
            for lo, hi in _chunks(arrays):
                ids = np.concatenate([x for a in arrays[lo:hi] for x in (a, edge)] + [edge])
                for begin in range(0, len(ids), RUN):
                    own = ids[begin : begin + RUN]
                    wide = index[np.concatenate([ids[max(0, begin - 2) : begin] if begin else edge, own, ids[begin + RUN : begin + RUN + 2], edge])[: len(own) + 4]]
                    near = wide[: len(own)] + wide[1 : len(own) + 1] + wide[3 : len(own) + 3] + wide[4 : len(own) + 4]
                    order = np.argsort(own, kind="stable")
                    slots, first = np.unique(own[order], return_index=True)
                    sums = np.add.reduceat(near[order], first, axis=0)
                    real = slots < TOKENS
                    total[slots[real]] += sums[real]
        part = TaskContext.get().partitionId()
        rows = np.split(total, SLICES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([part % 256] * SLICES, pa.int32()), pa.array([r.astype("<f8").tobytes() for r in rows], pa.binary())],
            names=["slice", "branch", "sums"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = None
        for data in table.column("sums"):
            x = np.frombuffer(data.as_buffer(), "<f8")
            total = x.copy() if total is None else total + x
        return table.slice(0, 1).set_column(2, "sums", pa.array([total.tobytes()], pa.binary()))

    schema = "slice int, branch int, sums binary"
    parts = in_small_batches(doc_columns(docs)).mapInArrow(contexts, schema)
    # Added up in two levels, so that no task holds the tables of all others.
    whole = parts.groupBy("slice", "branch").applyInArrow(add, schema).groupBy("slice").applyInArrow(add, schema)
    out = np.zeros((SLICES, TOKENS // SLICES, DIM))
    for row in whole.collect():  # fixed size: TOKENS x DIM numbers
        out[row["slice"]] = np.frombuffer(bytes(row["sums"]), "<f8").reshape(-1, DIM)
    out = out.reshape(TOKENS, DIM)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[str], vectors: np.ndarray, memo: Slots) -> np.ndarray:
    """One row of inputs for each text."""
    out = np.zeros((len(texts), 2 * DIM + 2), np.float32)
    arrays = [_slots(t, memo) for t in texts]
    for lo, hi in _chunks(arrays):
        for col, part in ((0, arrays[lo:hi]), (DIM, [np.unique(a) for a in arrays[lo:hi]])):
            lengths = np.array([len(a) for a in part])
            some = np.flatnonzero(lengths)
            if len(some):
                ids, starts = np.concatenate(part), starts_of(lengths)
                sums = np.zeros((len(part), DIM), np.float32)
                sums[some] = np.add.reduceat(vectors[ids], starts[some], axis=0) if len(ids) <= 4 * CHUNK else _long(vectors, ids, starts[some], starts[some + 1])
                out[lo:hi, col : col + DIM] = sums / np.maximum(lengths, 1)[:, None]
            if col:
                n = np.array([len(a) for a in arrays[lo:hi]])
                out[lo:hi, 2 * DIM] = lengths / np.maximum(n, 1)
                out[lo:hi, 2 * DIM + 1] = np.log1p(n) / 10
    return out


def _long(vectors: np.ndarray, ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return np.stack([sum(vectors[ids[i : min(i + CHUNK, e)]].sum(axis=0) for i in range(b, e, CHUNK)) for b, e in zip(begin, end, strict=True)])


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(np.float64) / self.temperature, -40, 40)))


def _fit(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60) -> Model:
    share = float(y.mean()) if len(y) else 0.5
    width = x.shape[1]
    mean, scale = (x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)) if len(y) else (np.zeros(width), np.ones(width))
    prior = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    model = Model(vectors, mean, scale, np.zeros((width, hidden)), np.zeros(hidden), np.zeros(hidden), prior, 1.0)
    if len(y) < 10 or share in (0.0, 1.0):
        return model
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    held, fit = order[: len(y) // 5], order[len(y) // 5 :]
    z = (x - mean) / scale
    params = [rng.normal(0, 1 / np.sqrt(width), (width, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.array([prior])]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for begin in range(0, len(fit), 128):
            rows = fit[begin : begin + 128]
            h = np.tanh(z[rows] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -40, 40)))
            e = (p - y[rows]) / len(rows)
            back = e[:, None] * params[2] * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * params[0], back.sum(axis=0), h.T @ e + 1e-4 * params[2], np.array([e.sum()])]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] -= 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    model.w1, model.b1, model.w2, model.b2 = params[0], params[1], params[2], float(params[3][0])
    logits, target = model.logits(x[held]), y[held]

    def loss(t: float) -> float:
        q = np.clip(logits / t, -40, 40)
        return float(np.mean(np.log1p(np.exp(-q)) + (1 - target) * q))

    model.temperature = min(np.geomspace(0.5, 10, 60).tolist(), key=loss) if len(held) else 1.0
    return model


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows that no label is learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Model:
    """Word vectors from all ``docs``; the network from at most ``sample`` rows of ``labels`` (doc_id, quality) that are not held out."""
    vectors = word_vectors(docs)
    per = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("doc_id is not null and quality is not null").where(~held_out())
    per = per.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    chosen = per.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def inputs(batches):
        memo = Slots()
        for batch in (part for whole in batches for part in slices(whole)):
            x = pooled(texts_of(batch), shared.value, memo)
            order = [batch.column(0), batch.column(2), pa.array([r.astype("<f4").tobytes() for r in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(order, names=["doc_id", "quality", "x"])

    joined = doc_columns(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")
    # Of the texts of one id the one with the smallest inputs stands, wherever its rows lie.
    one = in_small_batches(joined).mapInArrow(inputs, "doc_id long, quality int, x binary").groupBy("doc_id").agg(F.min("x").alias("x"), F.min("quality").alias("quality"))
    rows = sorted((r["doc_id"], bytes(r["x"]), r["quality"]) for r in one.collect())
    x = np.array([np.frombuffer(r[1], "<f4") for r in rows], np.float64).reshape(len(rows), 2 * DIM + 2)
    return _fit(vectors, x, np.array([r[2] for r in rows], np.float64))


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each row's text."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])

    def run(batches):
        memo = Slots()
        for batch in (part for whole in batches for part in slices(whole)):
            s = shared.value.scores(pooled(texts_of(batch), shared.value.vectors, memo))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[*batch.schema.names, column])

    return in_small_batches(docs).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``threshold`` up) for each row of ``docs``."""
    model = fit(docs, labels, sample)
    out = scored(doc_columns(docs), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
