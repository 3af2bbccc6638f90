"""Vector top-k by cosine similarity: exact scan, and cell-pruned scan over an index.

The index is never shuffled. A size-checked block of query vectors goes to every task as one matrix; a task multiplies its
Arrow batches by it and keeps k rows per query; a second top-k joins the tasks' results. More queries than one block holds
are answered block after block, each an exact pass, so the number of queries has no cap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from marquee.operators.dedup import top_n_per_group
from marquee.session import rows_within, staged

# One block of query vectors: at most this many rows and this many numbers (32 MB as double).
BLOCK_QUERIES = 4096
BLOCK_NUMBERS = 4_194_304
# Similarities held at once in a task.
PRODUCT_CELLS = 2_000_000
# Best rows held at once in a task, over all queries of a block.
BEST_CELLS = 4_194_304


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column without NULLs as a double matrix; any other length than ``dim`` is an error."""
    flat = column.flatten()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != dim).any() or flat.null_count:
        raise ValueError(f"vectors must have {dim} numbers, found lengths {sorted(set(lengths.tolist()))[:5]}")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def unit_rows(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length 1, and which rows have a direction at all."""
    length = np.sqrt((vectors * vectors).sum(axis=1))
    good = length > 0
    return vectors / np.where(good, length, 1.0)[:, None], good


class _Best:
    """The k best (similarity, id) of each query seen by one task; ties go to the smaller id.

    One row of ``sim`` and ``id`` for each query, in no order. A row of the index is compared with each query's k-th best first;
    only queries that it reaches are touched.
    """

    def __init__(self, k: int, queries: int):
        self.k = k
        self.sim = np.full((queries, k), -np.inf)
        self.floor = np.full(queries, -np.inf)
        self.id: np.ndarray | None = None

    def offer(self, which: np.ndarray, sims: np.ndarray, ids: np.ndarray) -> None:
        """``sims`` has a row for each of ``ids`` and a column for each query of ``which``."""
        reached = sims >= self.floor[which]
        cols = np.flatnonzero(reached.any(axis=0))
        if not len(cols):
            return
        rows = np.flatnonzero(reached[:, cols].any(axis=1))
        if self.id is None:
            self.id = np.zeros(self.sim.shape, dtype=ids.dtype)
        q = which[cols]
        both = np.concatenate([self.sim[q], sims[np.ix_(rows, cols)].T], axis=1)
        names = np.concatenate([self.id[q], np.broadcast_to(ids[rows], (len(q), len(rows)))], axis=1)
        best = np.argpartition(-both, self.k - 1, axis=1)[:, : self.k]
        floor = np.take_along_axis(both, best, axis=1).min(axis=1)
        tied = np.flatnonzero(((both >= floor[:, None]).sum(axis=1) > self.k) & (floor > -np.inf))
        for i in tied.tolist():
            above = np.flatnonzero(both[i] > floor[i])
            equal = np.flatnonzero(both[i] == floor[i])
            best[i] = np.concatenate([above, equal[np.argsort(names[i, equal], kind="stable")][: self.k - len(above)]])
        self.sim[q] = np.take_along_axis(both, best, axis=1)
        self.id[q] = np.take_along_axis(names, best, axis=1)
        self.floor[q] = floor

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Numbers of the queries, similarities, ids."""
        if self.id is None:
            return None
        query, place = np.nonzero(self.sim > -np.inf)
        return query, self.sim[query, place], self.id[query, place]


# Two scans may round a similarity differently; a cursor lets rows pass that lie this close before it. ``digits`` must be finer.
CURSOR_MARGIN = 1e-3
# Ids that one query may name as not wanted.
SKIPPED = 1000


@dataclass(frozen=True)
class Resume:
    """Where each query of a block goes on: behind the similarity ``after``, and without the ids it names in ``skip``."""

    after: np.ndarray
    skip: list[np.ndarray]

    def part(self, at: slice) -> Resume:
        return Resume(self.after[at], self.skip[at])

    def hide(self, which: np.ndarray, sims: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        """Take out of ``sims`` what lies before the cursors and the skipped rows; ``named`` are all skipped ids."""
        sims[sims > self.after[which] + CURSOR_MARGIN] = -np.inf
        rows = np.flatnonzero(np.isin(ids, named))
        if len(rows):
            for column, query in enumerate(which.tolist()):
                sims[rows[np.isin(ids[rows], self.skip[query])], column] = -np.inf


def _add_block(
    best: _Best, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, which: np.ndarray, digits: int | None, resume=None, named=None
) -> None:
    """Offer every row to the queries numbered ``which``."""
    step = max(1, PRODUCT_CELLS // max(1, len(which)))
    mine = queries[which].T
    for at in range(0, len(rows), step):
        sims = rows[at : at + step] @ mine
        if digits is not None:
            sims = np.round(sims, digits) + 0.0
        if resume is not None:
            resume.hide(which, sims, ids[at : at + step], named)
        best.offer(which, sims, ids[at : at + step])


def _scan(index: DataFrame, id_col: str, vec_col: str, block: QueryBlock, k: int, digits: int | None, probes=None) -> DataFrame:
    """Top-k per task. ``probes`` maps a cell to the queries that visit it; without it every row meets every query."""
    names = pa.array(block.ids, to_arrow_type(block.id_type))
    if block.resume is not None and digits is not None and 10.0**-digits >= CURSOR_MARGIN:
        raise ValueError("resumed queries need similarities of more digits")
    shared = index.sparkSession.sparkContext.broadcast((names, block.vectors, probes, block.resume))
    dim = block.vectors.shape[1]
    id_type = index.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)
    cols = [id_col, vec_col] + ([] if probes is None else ["cell"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q, visits, resume = shared.value
        named = None if resume is None else np.unique(np.concatenate(resume.skip))
        best = _Best(k, len(q))
        everyone = np.arange(len(q))
        for rb in batches:
            if not rb.num_rows:
                continue
            rows, good = unit_rows(matrix(rb.column(1), dim))
            ids = rb.column(0).to_numpy(zero_copy_only=False)
            if visits is None:
                _add_block(best, ids[good], rows[good], q, everyone, digits, resume, named)
                continue
            cells = rb.column(2).to_numpy(zero_copy_only=False)
            for cell in np.unique(cells[good]):
                inside = good & (cells == cell)
                _add_block(best, ids[inside], rows[inside], q, visits[int(cell)], digits, resume, named)
        if (found := best.rows()) is not None:
            query, sim, ids = found
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(query)), pa.array(ids, arrow_id), pa.array(sim)], names=["query_id", id_col, "similarity"]
            )

    found = index.select(*cols).filter(F.col(vec_col).isNotNull())
    return found.mapInArrow(run, f"query_id {block.id_type.simpleString()}, `{id_col}` {id_type.simpleString()}, similarity double")


@dataclass(frozen=True)
class QueryBlock:
    """Query vectors of unit length that travel to the tasks together, with their ids, and where they go on from an earlier search."""

    ids: list
    vectors: np.ndarray
    id_type: DataType
    resume: Resume | None = None

    def part(self, at: slice) -> QueryBlock:
        return QueryBlock(self.ids[at], self.vectors[at], self.id_type, self.resume and self.resume.part(at))


Queries = DataFrame | QueryBlock


def _block(rows: list[Row], id_type: DataType) -> QueryBlock:
    """Zero vectors match nothing and are left out."""
    width = len(rows[0]["query_vector"]) if rows else 0
    if any(len(r["query_vector"]) != width for r in rows):
        raise ValueError("query vectors differ in dimension")
    vectors, good = unit_rows(np.array([r["query_vector"] for r in rows], dtype=np.float64).reshape(len(rows), width))
    kept = [r for r, ok in zip(rows, good) if ok]
    resume = None
    if kept and "after" in kept[0]:
        resume = Resume(np.array([r["after"] for r in kept], dtype=np.float64), [np.array(r["skip"]) for r in kept])
    return QueryBlock([r["query_id"] for r in kept], vectors[good], id_type, resume)


def _asked(queries: DataFrame) -> DataFrame:
    """Queries that have a vector, with ``after`` and ``skip`` where they go on from an earlier search."""
    more = ["after", "skip"] if {"after", "skip"} <= set(queries.columns) else []
    return queries.select("query_id", "query_vector", *more).filter(F.col("query_vector").isNotNull())


def query_blocks(queries: Queries) -> Iterator[QueryBlock]:
    """``queries`` (query_id, query_vector) in blocks of bounded size, fetched one at a time."""
    if isinstance(queries, QueryBlock):
        if queries.ids:
            yield queries
        return
    queries = _asked(queries)
    id_type = queries.schema["query_id"].dataType

    def fetch(part: DataFrame, depth: int) -> Iterator[list[Row]]:
        rows = rows_within(part, BLOCK_QUERIES)
        if rows is not None:
            width = max((len(r["query_vector"]) for r in rows), default=1)
            step = max(1, BLOCK_NUMBERS // max(1, width))
            yield from (rows[i : i + step] for i in range(0, len(rows), step))
            return
        total = part.count()
        if part.select("query_id").distinct().limit(2).count() < 2:
            raise ValueError(f"{total} queries have one query_id; ids must be unique")
        pieces = -(-total // BLOCK_QUERIES) * 2
        cut = part.withColumn("_piece", F.pmod(F.xxhash64("query_id", F.lit(depth)), F.lit(pieces)))
        for piece in range(pieces):
            yield from fetch(cut.filter(F.col("_piece") == piece).drop("_piece"), depth + 1)

    # Written once: what the queries come from, an embedding model say, is not asked again for each block.
    for rows in fetch(staged(queries, "queries"), 0):
        block = _block(rows, id_type)
        if block.ids:
            yield block


def one_block(queries: DataFrame) -> QueryBlock | None:
    """All of ``queries`` as one block, or None when they do not fit one."""
    rows = rows_within(_asked(queries), BLOCK_QUERIES)
    if rows is None or sum(len(r["query_vector"]) for r in rows) > BLOCK_NUMBERS:
        return None
    return _block(rows, queries.schema["query_id"].dataType)


def _no_hits(index: DataFrame, queries: Queries, id_col: str) -> DataFrame:
    empty = index.select(F.col(id_col)).filter(F.lit(False))
    qtype = queries.id_type if isinstance(queries, QueryBlock) else queries.schema["query_id"].dataType
    return empty.select(F.lit(None).cast(qtype).alias("query_id"), id_col, F.lit(None).cast("double").alias("similarity"))


def _top(parts: list[DataFrame], id_col: str, k: int) -> DataFrame:
    """Top-k of the tasks' rows, in two steps: k rows per (query, share of the ids) first, then k per query.

    Every scan task sends up to k rows per query; with one step a large scan would send all of them to one task.
    """
    merged = reduce(DataFrame.unionByName, parts)
    order = [F.col("similarity").desc(), F.col(id_col).asc()]
    shares = int(merged.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    shared = merged.withColumn("_share", F.pmod(F.xxhash64(id_col), F.lit(shares)))
    some = top_n_per_group(shared, ["query_id", "_share"], order, k).drop("_share")
    return top_n_per_group(some, ["query_id"], order, k, rank="rank")


def _held(queries: Queries, k: int) -> Iterator[QueryBlock]:
    """The blocks of ``queries``, cut so that a task's k best of each stay within ``BEST_CELLS``."""
    step = max(1, BEST_CELLS // k)
    for block in query_blocks(queries):
        for at in range(0, len(block.ids), step):
            yield block.part(slice(at, at + step))


def knn(
    index: DataFrame,
    queries: Queries,
    k: int,
    id_col: str = "movie_id",
    vec_col: str = "embedding_vector",
    digits: int | None = None,
) -> DataFrame:
    """Exact (query_id, id, similarity, rank): the k most similar index rows of each query.

    Order is similarity descending, then id. With ``digits`` similarities are rounded first and rows that round alike are ties, which makes
    results comparable between engines. Rows with a NULL or zero vector are never hits; a vector of another dimension is an error.
    Queries with columns ``after`` (a similarity) and ``skip`` (at most ``SKIPPED`` ids) get the best rows that are no more than
    ``CURSOR_MARGIN`` above that similarity and not among those ids.
    """
    parts = [_scan(index, id_col, vec_col, block, k, digits) for block in _held(queries, k)]
    return _top(parts or [_no_hits(index, queries, id_col)], id_col, k)


def knn_cells(
    index: DataFrame,
    centroids: np.ndarray,
    queries: Queries,
    k: int,
    nprobe: int,
    id_col: str = "movie_id",
    vec_col: str = "embedding_vector",
    digits: int | None = None,
) -> DataFrame:
    """Approximate ``knn``: only the ``nprobe`` cells nearest each query are read, ranked exactly within them. For a table of queries that no block holds
    see ``knn_join``.

    ``index`` has a ``cell`` column its files are partitioned by, so unvisited cells are never opened. With ``nprobe`` equal
    to the number of cells the result is the exact one.
    """
    parts = []
    nprobe = min(nprobe, len(centroids))
    for block in _held(queries, k):
        # Squared distance to each centroid, up to a constant per query.
        away = (centroids * centroids).sum(axis=1)[None, :] - 2.0 * (block.vectors @ centroids.T)
        nearest = np.argpartition(away, nprobe - 1, axis=1)[:, :nprobe]
        visits = {int(c): np.flatnonzero((nearest == c).any(axis=1)) for c in np.unique(nearest)}
        opened = index.filter(F.col("cell").isin([int(c) for c in visits]))
        parts.append(_scan(opened, id_col, vec_col, block, k, digits, visits))
    return _top(parts or [_no_hits(index, queries, id_col)], id_col, k)


def recall(found: DataFrame, truth: DataFrame, id_col: str = "movie_id") -> DataFrame:
    """Share of the true neighbours of each query that were found."""
    hits = truth.join(found.select("query_id", id_col, F.lit(1).alias("_hit")), ["query_id", id_col], "left")
    return hits.groupBy("query_id").agg(F.avg(F.coalesce("_hit", F.lit(0))).alias("recall"))
