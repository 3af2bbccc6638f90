"""Vector search and recommendation over the test tables."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import functions as F

from marquee.operators import ann, knn, knn_join, pq, search
from marquee.operators.dedup import top_n_per_group
from marquee.plans import views as V
from marquee.plans.registry import query, with_views
from marquee.session import scratch_dir, staged
from marquee.sources.tables import change_feed

_DIM = 64
# As in the SQL: similarities are rounded before they are ranked, so that both engines see the same ties.
_DIGITS = 6
_knn = partial(knn.knn, digits=_DIGITS)
_knn_cells = partial(knn.knn_cells, digits=_DIGITS)
_TOP10 = "SELECT query_id, movie_id, similarity, CAST(rank AS INTEGER) AS rank FROM hits WHERE rank <= 10"


@query("knn_exact", with_views(_TOP10, V.LABEL_QUERIES, V.HITS))
def knn_exact(spark, sf):
    return _knn(V.vectors(spark, sf), V.label_queries(spark, sf), 10)


# The vector of the first part of every brand that has one.
_BRAND_QUERIES = """queries AS (
  SELECT p_brand AS query_id, arg_min(embedding, vec_id) AS query_vector FROM part JOIN embeddings ON vec_id = p_partkey GROUP BY p_brand)"""


def _brand_queries(spark, sf):
    part = V.load(spark, sf, "part").select(F.col("p_partkey").alias("vec_id"), F.col("p_brand").alias("query_id"))
    both = part.join(V.load(spark, sf, "embeddings"), "vec_id")
    return both.groupBy("query_id").agg(F.min_by("embedding", "vec_id").alias("query_vector"))


@query("knn_batch", with_views(_TOP10, _BRAND_QUERIES, V.HITS))
def knn_batch(spark, sf):
    return _knn(V.vectors(spark, sf), _brand_queries(spark, sf), 10)


def built_index(spark, sf):
    path = scratch_dir(spark, "index")
    model = ann.build_index(V.vectors(spark, sf), path, _DIM, cells=16)
    return path, model


@query(
    "ann_index_build",
    "SELECT vec_id AS movie_id, label, 1 AS n_cells, 64 AS dim, CAST(1.0 AS DOUBLE) AS length FROM embeddings",
)
def ann_index_build(spark, sf):
    path, _ = built_index(spark, sf)
    length = F.sqrt(F.aggregate("embedding_vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = spark.read.parquet(path).select(
        "movie_id", "label", "cell", F.size("embedding_vector").alias("dim"), F.round(length, 4).alias("length")
    )
    return rows.groupBy("movie_id", "label").agg(
        F.count("cell").cast("int").alias("n_cells"), F.max("dim").alias("dim"), F.max("length").alias("length")
    )


@query("ann_index_sync", "SELECT vec_id AS movie_id, label, CAST(floor(CAST(embedding[1] AS DOUBLE) * 1000 + 0.5) AS BIGINT) AS first FROM embeddings")
def ann_index_sync(spark, sf):
    """Index an older snapshot (one label missing, one reversed, one extra row per label), then apply the changes to today's."""
    after = V.vectors(spark, sf)
    reverse = F.when(F.col("label") == 2, F.reverse("embedding_vector")).otherwise(F.col("embedding_vector"))
    older = after.filter("label <> 1").withColumn("embedding_vector", reverse)
    extra = after.groupBy("label").agg(F.min_by("embedding_vector", "movie_id").alias("embedding_vector")).select(
        (F.lit(-1) - F.col("label")).cast("bigint").alias("movie_id"), "embedding_vector", "label"
    )
    before = older.unionByName(extra)
    path = scratch_dir(spark, "index")
    model = ann.build_index(before, path, _DIM, cells=16)
    feed = change_feed(before, after, ["movie_id"])
    fresh = feed.filter("change IN ('insert', 'update_postimage')").drop("change")
    ann.sync_index(spark, path, feed, fresh, model, _DIM, "movie_id")
    first = F.floor(F.element_at("embedding_vector", 1).cast("double") * 1000 + 0.5)
    return spark.read.parquet(path).select("movie_id", "label", first.alias("first"))


# Cells around the rounded mean of each label's unit vectors, so that cells, probes and hits can be told in SQL.
# Eight of the ten cells hold 0.95 of the true neighbours of these queries at sf0.01 and sf0.1.
_PROBES = 8
_CELLS = """units AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(CAST(x AS DOUBLE)
         / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS FLOAT)) AS u FROM embeddings),
cells AS (
  SELECT row_number() OVER (ORDER BY label) AS cell, list(m ORDER BY i) AS c
  FROM (SELECT label, i, round(avg(CAST(x AS DOUBLE)), 4) AS m
        FROM (SELECT label, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM units) GROUP BY ALL) GROUP BY label),
placed AS (
  SELECT vec_id, arg_min(cell, list_inner_product(c, c) - 2 * list_inner_product(CAST(u AS DOUBLE[]), c)) AS cell
  FROM units CROSS JOIN cells GROUP BY vec_id),
probes AS (
  SELECT query_id, cell FROM queries CROSS JOIN cells QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY list_inner_product(c, c)
    - 2 * list_inner_product(CAST(query_vector AS DOUBLE[]), c) / sqrt(list_inner_product(CAST(query_vector AS DOUBLE[]), CAST(query_vector AS DOUBLE[])))) <= 8),
near AS (
  SELECT sims.*, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, movie_id) AS rank
  FROM sims JOIN placed ON placed.vec_id = movie_id JOIN probes USING (query_id, cell))"""


def _label_cells(spark, sf):
    vectors = V.vectors(spark, sf)
    places = vectors.select("label", F.posexplode(ann.unit("embedding_vector")).alias("i", "x"))
    means = places.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 4).alias("m"))
    # One number for each label and dimension.
    rows = sorted((r["label"], r["i"], r["m"]) for r in means.collect())
    centres = np.array([m for _, _, m in rows]).reshape(-1, _DIM)
    path = scratch_dir(spark, "index")
    ann.build_index(vectors, path, _DIM, given=centres)
    return spark.read.parquet(path), centres


@query("knn_ann", with_views(_TOP10.replace("hits", "near"), V.LABEL_QUERIES, V.HITS, _CELLS))
def knn_ann(spark, sf):
    index, centres = _label_cells(spark, sf)
    return _knn_cells(index, centres, V.label_queries(spark, sf), 10, nprobe=_PROBES)


@query("knn_ann_all_cells", with_views(_TOP10, V.LABEL_QUERIES, V.HITS))
def knn_ann_all_cells(spark, sf):
    """Visiting every cell must give the exact answer."""
    path, model = built_index(spark, sf)
    return _knn_cells(spark.read.parquet(path), ann.centroids(model), V.label_queries(spark, sf), 10, nprobe=16)


@query(
    "knn_recall",
    with_views(
        """SELECT h.query_id, count(n.movie_id) / count(*) AS recall FROM hits h
           LEFT JOIN (SELECT * FROM near WHERE rank <= 10) n ON n.query_id = h.query_id AND n.movie_id = h.movie_id
           WHERE h.rank <= 10 GROUP BY h.query_id""",
        V.LABEL_QUERIES,
        V.HITS,
        _CELLS,
    ),
)
def knn_recall(spark, sf):
    return knn.recall(knn_ann(spark, sf), knn_exact(spark, sf))


# Every 50th vector against all.
_FIFTIETH = """queries AS (SELECT vec_id AS query_id, embedding AS query_vector FROM embeddings WHERE vec_id % 50 = 0)"""


@query("knn_cell_join", with_views(_TOP10, _FIFTIETH, V.HITS))
def knn_cell_join(spark, sf):
    """A table of queries joined to all cells of an index, in groups so small that crowded cells are split, is the exact search."""
    path, model = built_index(spark, sf)
    vectors = V.vectors(spark, sf)
    asked = vectors.where("movie_id % 50 = 0").select(F.col("movie_id").alias("query_id"), F.col("embedding_vector").alias("query_vector"))
    return knn_join.knn_join(spark.read.parquet(path), ann.centroids(model), asked, 10, 16, digits=_DIGITS, group_rows=100, group_queries=20)


@query(
    "knn_pq_recall",
    with_views("SELECT count(DISTINCT query_id) AS n_queries, count(*) AS n_hits, TRUE AS at_floor FROM hits WHERE rank <= 10", _FIFTIETH, V.HITS),
)
def knn_pq_recall(spark, sf):
    """Search over codes with the probes that calibration gives: whether every 50th vector finds at least nine tenths of its true neighbours."""
    vectors = V.vectors(spark, sf)
    path = scratch_dir(spark, "pq")
    coder = pq.build_index(vectors, path, _DIM, cells=16)
    index = spark.read.parquet(path)
    asked = vectors.where("movie_id % 50 = 0").select(F.col("movie_id").alias("query_id"), F.col("embedding_vector").alias("query_vector"))
    found = staged(pq.search(index, coder, asked, 10, pq.calibrate(index, coder, 10), digits=_DIGITS), "found")
    each = knn.recall(found, _knn(vectors, asked, 10))
    total = found.agg(F.count(F.lit(1)).alias("n_hits"))
    row = each.agg(F.count(F.lit(1)).alias("n_queries"), (F.avg("recall") >= 0.9).alias("at_floor"))
    return row.withColumn("all", F.lit(1)).join(total.withColumn("all", F.lit(1)), "all").drop("all")


@query(
    "search_enrich",
    with_views(
        """SELECT query_id, movie_id, similarity, coalesce(vote_average, -1) AS vote_average, coalesce(runtime, -1) AS runtime,
           coalesce(genres[1] || ', ' || genres[2], '') AS genres FROM hits LEFT JOIN movies USING (movie_id) WHERE rank <= 50""",
        V.MOVIES,
        V.LABEL_QUERIES,
        V.HITS,
    ),
)
def search_enrich(spark, sf):
    block = knn.one_block(V.label_queries(spark, sf))
    hits = _knn(V.vectors(spark, sf), block, 50)
    return search.enrich(hits, V.movies(spark, sf), search.few_hits(block, 50)).select(
        "query_id",
        "movie_id",
        "similarity",
        F.coalesce("vote_average", F.lit(-1.0)).alias("vote_average"),
        F.coalesce("runtime", F.lit(-1)).alias("runtime"),
        F.coalesce(F.array_join("genres", ", "), F.lit("")).alias("genres"),
    )


_PICKED = """SELECT query_id, movie_id, title, runtime, similarity, CAST(pick AS INTEGER) AS rank,
  coalesce(CASE WHEN length(overview) > 300 THEN substr(overview, 1, 300) || '...' ELSE overview END, '') AS overview_snippet
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, movie_id) AS pick
      FROM {} JOIN movies USING (movie_id) WHERE runtime <= 25 AND lower(genres[1]) = 'economy') WHERE pick <= 5"""


def _picked(rows):
    return rows.select("query_id", "movie_id", "title", "runtime", "similarity", "rank", "overview_snippet")


@query(
    "semantic_search",
    with_views(_PICKED.format("sims"), V.MOVIES, V.LABEL_QUERIES, V.HITS),
)
def semantic_search(spark, sf):
    return _picked(
        search.semantic_search(
            V.vectors(spark, sf), V.movies(spark, sf), V.label_queries(spark, sf), max_runtime=25, genre=" Economy ", limit=5, find=_knn
        )
    )


@query("semantic_search_prefilter", with_views(_PICKED.format("sims"), V.MOVIES, V.LABEL_QUERIES, V.HITS))
def semantic_search_prefilter(spark, sf):
    """Over an index that has the attributes itself."""
    movies = V.movies(spark, sf)
    index = search.with_attributes(V.vectors(spark, sf), movies)
    return _picked(
        search.semantic_search(index, movies, V.label_queries(spark, sf), max_runtime=25, genre="economy", limit=5, find=_knn)
    )


@query(
    "semantic_search_postfilter",
    with_views(_PICKED.format("(SELECT * FROM hits WHERE rank <= 400)"), V.MOVIES, V.LABEL_QUERIES, V.HITS),
)
def semantic_search_postfilter(spark, sf):
    """Filters the 400 nearest, as asked for by the mode."""
    return _picked(
        search.semantic_search(
            V.vectors(spark, sf),
            V.movies(spark, sf),
            V.label_queries(spark, sf),
            max_runtime=25,
            genre="economy",
            limit=5,
            mode="postfilter",
            find=_knn,
        )
    )


@query(
    "semantic_search_unfiltered",
    with_views(
        """SELECT query_id, movie_id, title, similarity, CAST(pick AS INTEGER) AS rank
           FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, movie_id) AS pick
                 FROM sims JOIN movies USING (movie_id)) WHERE pick <= 5""",
        V.MOVIES,
        V.LABEL_QUERIES,
        V.HITS,
    ),
)
def semantic_search_unfiltered(spark, sf):
    rows = search.semantic_search(V.vectors(spark, sf), V.movies(spark, sf), V.label_queries(spark, sf), find=_knn)
    return rows.select("query_id", "movie_id", "title", "similarity", "rank")


@query(
    "browse_semantic",
    with_views(
        """SELECT query_id, movie_id, similarity, CAST(rank AS INTEGER) AS rank, coalesce(genres[1] || ', ' || genres[2], '') AS genres_text
           FROM hits LEFT JOIN movies USING (movie_id) WHERE rank <= 20""",
        V.MOVIES,
        V.LABEL_QUERIES,
        V.HITS,
    ),
)
def browse_semantic(spark, sf):
    rows = search.browse_semantic(V.vectors(spark, sf), V.movies(spark, sf), V.label_queries(spark, sf), find=_knn)
    return rows.select("query_id", "movie_id", "similarity", "rank", "genres_text")


@query(
    "exclude_seen",
    with_views(
        """SELECT DISTINCT r.group_id, r.movie_id FROM ratings r
           WHERE NOT EXISTS (SELECT 1 FROM recommendations s WHERE s.group_id = r.group_id AND s.movie_id = r.movie_id)
             AND NOT EXISTS (SELECT 1 FROM watchlist w WHERE w.status = 'watched' AND w.group_id = r.group_id AND w.movie_id = r.movie_id)""",
        V.RATINGS,
        V.RECOMMENDATIONS,
        V.WATCHLIST,
    ),
)
def exclude_seen(spark, sf):
    rated = V.ratings(spark, sf).select("group_id", "movie_id").distinct()
    watched = V.watchlist(spark, sf).filter("status = 'watched'")
    return search.exclude_seen(rated, watched, V.recommendations(spark, sf))


_TASTE = """taste AS (
  SELECT group_id, label AS query_id FROM (
    SELECT group_id, label, count(*) AS n FROM watchlist JOIN embeddings ON vec_id = movie_id GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY n DESC, label) = 1)"""


def _taste(spark, sf):
    """Each group is represented by the vector label most frequent on its watchlist."""
    labelled = V.watchlist(spark, sf).join(V.vectors(spark, sf).select("movie_id", F.col("label").alias("query_id")), "movie_id")
    counts = labelled.groupBy("group_id", "query_id").agg(F.count(F.lit(1)).alias("n"))
    return top_n_per_group(counts, ["group_id"], [F.col("n").desc(), F.col("query_id")], 1).drop("n")


def _recommend(spark, sf, find):
    """A first pass over 40 candidates; groups that have seen them get more."""
    return search.recommend_for_groups(
        _taste(spark, sf),
        V.vectors(spark, sf),
        V.movies(spark, sf),
        V.label_queries(spark, sf),
        V.watchlist(spark, sf),
        V.recommendations(spark, sf),
        candidates=40,
        picks=3,
        find=find,
    ).select("group_id", "movie_id", "title", "similarity", "rank")


def _recommended(hits, *more):
    return with_views(
        """SELECT group_id, movie_id, title, similarity, CAST(pick AS INTEGER) AS rank FROM (
           SELECT group_id, movie_id, title, similarity,
             row_number() OVER (PARTITION BY group_id ORDER BY similarity DESC, movie_id) AS pick
           FROM taste JOIN {hits} USING (query_id) JOIN movies USING (movie_id)
           WHERE NOT EXISTS (SELECT 1 FROM watchlist w WHERE w.group_id = taste.group_id AND w.movie_id = movies.movie_id)
             AND NOT EXISTS (SELECT 1 FROM recommendations s WHERE s.group_id = taste.group_id AND s.movie_id = movies.movie_id))
           WHERE pick <= 3""".format(hits=hits),
        V.MOVIES,
        V.WATCHLIST,
        V.RECOMMENDATIONS,
        V.LABEL_QUERIES,
        V.HITS,
        _TASTE,
        *more,
    )


@query("recommend_for_groups", _recommended("sims"))
def recommend_for_groups(spark, sf):
    return _recommend(spark, sf, _knn)


@query("recommend_for_groups_ann", _recommended("near", _CELLS))
def recommend_for_groups_ann(spark, sf):
    index, centres = _label_cells(spark, sf)
    return _recommend(spark, sf, partial(_cells, index, centres))


def _cells(index, centres, _, queries, k):
    return _knn_cells(index, centres, queries, k, nprobe=_PROBES)
