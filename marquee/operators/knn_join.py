"""Vector top-k of a table of queries of any size, as a join on cells: no vector comes to the driver.

Each query goes to its nearest cells as rows of a table. A cell's index rows are split into parts by a hash of their id, its queries into parts by a hash of
theirs, both by counts that are known before, and every pair of parts is one group of bounded size: a crowded cell, or one that most queries visit, is many
groups. A group multiplies its two matrices and keeps k rows for each query; those are reduced by key.

Every row is sent once for each part of the queries and every query once for each part of the rows, so the parts of a cell are few: ``SPLIT`` each way, and
more only where a group would pass what a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from marquee.operators import knn as scan

#: Rows of the index, and queries, that meet in one group at most.
GROUP_ROWS = 20_000
GROUP_QUERIES = 2_000
#: Parts each way that a cell is split into for smaller groups than those.
SPLIT = 4


def probed(queries: DataFrame, centroids: np.ndarray, nprobe: int) -> DataFrame:
    """query_id, query_vector (of unit length), cell: a row for each of the ``nprobe`` cells nearest a query; NULL and zero vectors have none."""
    id_type = queries.schema["query_id"].dataType
    nprobe = min(nprobe, len(centroids))
    shared = queries.sparkSession.sparkContext.broadcast((centroids.T, (centroids * centroids).sum(axis=1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        across, size = shared.value
        for rb in batches:
            vectors, good = scan.unit_rows(scan.matrix(rb.column(1), len(across)))
            at = np.flatnonzero(good)
            cells = np.argpartition(size - 2.0 * (vectors[at] @ across), nprobe - 1, axis=1)[:, :nprobe] if len(at) else np.empty((0, nprobe), np.int64)
            rows = np.repeat(at, nprobe)
            flat = pa.array(vectors[rows].reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(across), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([rb.column(0).take(pa.array(rows)), lists, pa.array(cells.reshape(-1), pa.int32())], names=["query_id", "query_vector", "cell"])

    asked = queries.select("query_id", "query_vector").filter(F.col("query_vector").isNotNull())
    return asked.mapInArrow(run, f"query_id {id_type.simpleString()}, query_vector array<double>, cell int")


def _parts(size: int, most: int) -> Column:
    """The parts of a cell by its count: of ``size`` rows up to ``SPLIT`` parts, from there on of ``most`` rows."""
    n = F.count(F.lit(1))
    return F.greatest(F.least(F.ceil(n / size), F.lit(SPLIT)), F.ceil(n / max(size, most))).cast("int")


def knn_join(
    index: DataFrame,
    centroids: np.ndarray,
    queries: DataFrame,
    k: int,
    nprobe: int,
    id_col: str = "movie_id",
    vec_col: str = "embedding_vector",
    digits: int | None = None,
    group_rows: int = GROUP_ROWS,
    group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """``knn.knn_cells`` (query_id, id, similarity, rank) for more queries than a block holds; with all cells probed the exact result.

    Groups are of ``group_rows`` and ``group_queries`` while that splits a cell into ``SPLIT`` parts at most; beyond, groups grow up to ``GROUP_ROWS`` and
    ``GROUP_QUERIES``, or to what was asked for if that is more, before there are more of them.
    """
    id_type, query_type = index.schema[id_col].dataType, queries.schema["query_id"].dataType
    arrow_id, arrow_query = to_arrow_type(id_type), to_arrow_type(query_type)
    dim = centroids.shape[1]
    rows = index.select(id_col, vec_col, "cell").filter(F.col(vec_col).isNotNull())
    asked = probed(queries, centroids, nprobe)
    held = rows.groupBy("cell").agg(_parts(group_rows, GROUP_ROWS).alias("row_parts"))
    met = asked.groupBy("cell").agg(_parts(group_queries, GROUP_QUERIES).alias("query_parts"))
    # One row for each cell, of which there are as many as centroids on the driver.
    parts = F.broadcast(held.join(met, "cell"))

    def part(key: str, n: str):
        return F.pmod(F.xxhash64(key), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = rows.join(parts, "cell").withColumn("row_part", part(id_col, "row_parts")).withColumn("query_part", every("query_parts"))
    right = asked.join(parts, "cell").withColumn("query_part", part("query_id", "query_parts")).withColumn("row_part", every("row_parts"))
    keys = ["cell", "row_part", "query_part"]

    def best_of(found: pa.Table, wanted: pa.Table) -> pa.Table:
        best = None
        if found.num_rows and wanted.num_rows:
            found, wanted = found.combine_chunks(), wanted.combine_chunks()
            vectors, good = scan.unit_rows(scan.matrix(found.column(id_at + 1).chunk(0), dim))
            ids = found.column(id_at).to_numpy()
            names = wanted.column(id_at).chunk(0)
            asked = scan.matrix(wanted.column(id_at + 1).chunk(0), dim)
            state = scan._Best(k, len(asked))
            scan._add_block(state, ids[good], vectors[good], asked, np.arange(len(asked)), digits)
            best = state.rows()
        query, sims, ids = best or (np.empty(0, np.int64), np.empty(0), [])
        taken = names.take(pa.array(query)) if best else pa.array([], arrow_query)
        return pa.table([taken.cast(arrow_query), pa.array(ids, arrow_id), pa.array(sims, pa.float64())], names=["query_id", id_col, "similarity"])

    id_at = len(keys)
    left, right = left.select(*keys, id_col, vec_col), right.select(*keys, "query_id", "query_vector")
    schema = f"query_id {query_type.simpleString()}, `{id_col}` {id_type.simpleString()}, similarity double"
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best_of, schema)
    return scan._top([found], id_col, k)
