"""Ranked look-ups and group histories over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import history, search
from marquee.operators.knn import knn
from marquee.plans import views as V
from marquee.plans.registry import query, with_views
from marquee.session import staged
from marquee.sources.tables import change_feed


@query(
    "trending",
    with_views(
        """SELECT movie_id, title, vote_average, vote_count, coalesce(year, -1) AS year FROM movies WHERE vote_count IS NOT NULL
           ORDER BY vote_count DESC, vote_average DESC NULLS LAST, movie_id LIMIT 10""",
        V.MOVIES,
    ),
)
def trending(spark, sf):
    return search.trending(V.movies(spark, sf)).withColumn("year", F.coalesce("year", F.lit(-1)))


@query(
    "browse_titles",
    with_views(
        """SELECT movie_id, title, vote_average FROM movies
           WHERE lower(title) LIKE '%red%' OR lower(original_title) LIKE '%red%'
           ORDER BY vote_average DESC NULLS LAST, vote_count DESC NULLS LAST, movie_id LIMIT 200""",
        V.MOVIES,
    ),
)
def browse_titles(spark, sf):
    return search.browse_titles(V.movies(spark, sf), "red").select("movie_id", "title", "vote_average")


@query(
    "lookup_in_order",
    with_views(
        """SELECT query_id, movie_id, title, CAST(rank AS INTEGER) AS pos FROM hits JOIN movies USING (movie_id)
           WHERE rank <= 20 ORDER BY pos""",
        V.MOVIES,
        V.LABEL_QUERIES,
        V.HITS,
    ),
)
def lookup_in_order(spark, sf):
    hits = knn(V.vectors(spark, sf), V.label_queries(spark, sf), 20)
    ids = hits.select("query_id", "movie_id", F.col("rank").alias("pos"))
    return search.lookup_in_order(V.movies(spark, sf), ids).select("query_id", "movie_id", "title", "pos")


_REQUESTS = """requests AS (
  SELECT p_brand AS request_id, p_brand AS needle FROM part GROUP BY p_brand
  UNION ALL SELECT 'none', 'no such title')"""
_MATCHES = """matches AS (
  SELECT request_id, movie_id, title, vote_average, overview, row_number() OVER (
    PARTITION BY request_id ORDER BY vote_average DESC NULLS LAST, movie_id) AS rank
  FROM requests JOIN movies ON lower(title) LIKE lower('%' || needle || '%') OR lower(original_title) LIKE lower('%' || needle || '%'))"""


def _requests(spark, sf):
    """One request per brand: ``Brand#1`` also matches ``Brand#10`` and the like."""
    brands = V.load(spark, sf, "part").select("p_brand").distinct()
    nothing = spark.range(1).select(F.lit("none").alias("request_id"), F.lit("no such title").alias("needle"))
    return brands.select(F.col("p_brand").alias("request_id"), F.col("p_brand").alias("needle")).unionByName(nothing)


@query(
    "movie_details",
    with_views(
        "SELECT request_id, movie_id, title, CAST(rank AS INTEGER) AS rank FROM matches WHERE rank <= 5",
        V.MOVIES,
        _REQUESTS,
        _MATCHES,
    ),
)
def movie_details(spark, sf):
    return search.movie_details(V.movies(spark, sf), _requests(spark, sf)).select("request_id", "movie_id", "title", "rank")


@query(
    "compare_movies",
    with_views(
        """SELECT r.request_id, coalesce(title, '') AS title, coalesce(vote_average, -1) AS vote_average,
           coalesce(CASE WHEN length(overview) > 300 THEN substr(overview, 1, 300) || '...' ELSE overview END, '') AS overview
           FROM requests r LEFT JOIN (SELECT * FROM matches WHERE rank = 1) m ON r.request_id = m.request_id""",
        V.MOVIES,
        _REQUESTS,
        _MATCHES,
    ),
)
def compare_movies(spark, sf):
    return search.compare_movies(V.movies(spark, sf), _requests(spark, sf)).select(
        "request_id",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("vote_average", F.lit(-1.0)).alias("vote_average"),
        F.coalesce("overview", F.lit("")).alias("overview"),
    )


@query(
    "group_watchlist",
    with_views(
        """SELECT group_id, item_id, movie_id, coalesce(title, '') AS title, status, strftime(added_at, '%Y-%m-%d') AS added_at,
           coalesce(vote_average, -1) AS tmdb_score, coalesce(runtime, -1) AS runtime,
           coalesce(genres[1] || ', ' || genres[2], '') AS genres
           FROM watchlist LEFT JOIN movies USING (movie_id) ORDER BY group_id, added_at DESC, item_id DESC""",
        V.WATCHLIST,
        V.MOVIES,
    ),
)
def group_watchlist(spark, sf):
    return history.watchlist(V.watchlist(spark, sf), V.movies(spark, sf)).select(
        "group_id",
        "item_id",
        "movie_id",
        F.coalesce("title", F.lit("")).alias("title"),
        "status",
        F.date_format("added_at", "yyyy-MM-dd").alias("added_at"),
        F.coalesce("tmdb_score", F.lit(-1.0)).alias("tmdb_score"),
        F.coalesce("runtime", F.lit(-1)).alias("runtime"),
        F.coalesce(F.array_join("genres", ", "), F.lit("")).alias("genres"),
    )


@query(
    "group_ratings",
    with_views(
        """SELECT group_id, rating_id, movie_id, coalesce(title, '') AS title, score, comment,
           strftime(rated_at, '%Y-%m-%d') AS rated_at
           FROM ratings LEFT JOIN movies USING (movie_id) ORDER BY group_id, rated_at DESC, rating_id DESC""",
        V.RATINGS,
        V.MOVIES,
    ),
)
def group_ratings(spark, sf):
    rows = history.ratings(V.ratings(spark, sf), V.movies(spark, sf))
    return rows.withColumn("title", F.coalesce("title", F.lit(""))).withColumn("rated_at", F.date_format("rated_at", "yyyy-MM-dd"))


@query(
    "group_recs",
    with_views(
        """SELECT group_id, rec_id, movie_id, coalesce(title, '') AS title, reason,
           strftime(recommended_at, '%Y-%m-%d %H:%M:%S') AS recommended_at
           FROM recommendations LEFT JOIN movies USING (movie_id) ORDER BY group_id, recommended_at DESC, rec_id DESC""",
        V.RECOMMENDATIONS,
        V.MOVIES,
    ),
)
def group_recs(spark, sf):
    rows = history.recommendations(V.recommendations(spark, sf), V.movies(spark, sf))
    return rows.withColumn("title", F.coalesce("title", F.lit(""))).withColumn(
        "recommended_at", F.date_format("recommended_at", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "group_history",
    with_views(
        """SELECT group_id, 'watchlist' AS kind, item_id AS fact_id, strftime(added_at, '%Y-%m-%d') AS day, movie_id,
           coalesce(title, '') AS title, status AS detail FROM watchlist LEFT JOIN movies USING (movie_id)
           UNION ALL SELECT group_id, 'rating', rating_id, strftime(rated_at, '%Y-%m-%d'), movie_id, coalesce(title, ''),
           CAST(score AS VARCHAR) FROM ratings LEFT JOIN movies USING (movie_id)
           UNION ALL SELECT group_id, 'recommendation', rec_id, strftime(recommended_at, '%Y-%m-%d'), movie_id, coalesce(title, ''),
           reason FROM recommendations LEFT JOIN movies USING (movie_id)""",
        V.WATCHLIST,
        V.RATINGS,
        V.RECOMMENDATIONS,
        V.MOVIES,
    ),
)
def group_history(spark, sf):
    rows = history.group_history(V.watchlist(spark, sf), V.ratings(spark, sf), V.recommendations(spark, sf), V.movies(spark, sf))
    record = F.from_json("record", "movie_id bigint, title string, status string, score string, reason string")
    return rows.select("group_id", "kind", "fact_id", F.date_format("at", "yyyy-MM-dd").alias("day"), record.alias("r")).select(
        "group_id",
        "kind",
        "fact_id",
        "day",
        "r.movie_id",
        F.coalesce("r.title", F.lit("")).alias("title"),
        F.coalesce("r.status", "r.score", "r.reason").alias("detail"),
    )


@query(
    "groups_members",
    """SELECT n_nationkey AS group_id, n_name AS name, CAST(coalesce(part, 0) AS INTEGER) AS part, coalesce(members, '') AS members
       FROM nation LEFT JOIN (
         SELECT c_nationkey, pos // 1000 AS part, string_agg(c_name, ',' ORDER BY pos) AS members FROM (
           SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos FROM customer) GROUP BY 1, 2
       ) ON n_nationkey = c_nationkey""",
)
def groups_members(spark, sf):
    rows = history.groups_with_members(V.groups(spark, sf), V.members(spark, sf), V.users(spark, sf))
    return rows.withColumn("members", F.array_join("members", ","))


_METRICS = """SELECT c_custkey AS group_id, coalesce(queued, 0) AS queued, coalesce(watched, 0) AS watched, coalesce(avg_score, -1) AS avg_score
  FROM customer LEFT JOIN (SELECT group_id, count(*) FILTER (status = 'queued') AS queued,
    count(*) FILTER (status = 'watched') AS watched FROM watchlist GROUP BY 1) w ON c_custkey = w.group_id
  LEFT JOIN (SELECT group_id,
    ((sum(score) * 20 + count(*)) // (2 * count(*)))::BIGINT / 10.0::DOUBLE AS avg_score FROM ratings GROUP BY 1) r ON c_custkey = r.group_id"""


@query(
    "group_metrics",
    with_views(
        _METRICS,
        V.WATCHLIST,
        V.RATINGS,
    ),
)
def group_metrics(spark, sf):
    groups = V.load(spark, sf, "customer").select(F.col("c_custkey").alias("group_id"))
    metrics = history.group_metrics(groups, V.watchlist(spark, sf), V.ratings(spark, sf))
    return metrics.withColumn("avg_score", F.coalesce("avg_score", F.lit(-1.0)))


@query("group_metrics_incremental", with_views(_METRICS, V.WATCHLIST, V.RATINGS))
def group_metrics_incremental(spark, sf):
    """Stored sums of an earlier state of both tables, brought up to date by the change feeds to the present one."""
    groups = V.load(spark, sf, "customer").select(F.col("c_custkey").alias("group_id"))
    items, rated = V.watchlist(spark, sf), V.ratings(spark, sf)
    # Earlier some items were in another group or state, some ratings lower or not there, and some rows have been deleted since.
    moved = F.when(F.col("item_id") % 5 == 0, F.col("group_id") + 1).otherwise(F.col("group_id"))
    state = F.when(F.col("item_id") % 3 == 0, F.lit("queued")).otherwise(F.col("status"))
    gone = items.filter("item_id % 4 = 0").withColumn("item_id", -1 - F.col("item_id"))
    items_before = items.withColumns({"group_id": moved, "status": state}).unionByName(gone)
    lower = F.when(F.col("rating_id") % 3 == 0, F.lit(1)).otherwise(F.col("score"))
    rated_before = rated.filter("rating_id % 7 <> 0").withColumn("score", lower)
    stored = staged(history.metric_parts(items_before, rated_before), "metric-parts")
    feeds = change_feed(items_before, items, ["item_id"]), change_feed(rated_before, rated, ["rating_id"])
    metrics = history.metrics_from_parts(groups, history.merge_metric_parts(stored, history.metric_parts(*feeds)))
    return metrics.withColumn("avg_score", F.coalesce("avg_score", F.lit(-1.0)))
