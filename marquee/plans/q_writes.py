"""Upserts and write-back over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import merge
from marquee.operators.numbering import allocate_ids
from marquee.plans import views as V
from marquee.plans.registry import query, with_views
from marquee.session import scratch_dir
from marquee.sources import tables

_SOURCE = "CASE WHEN p_size > 30 THEN NULL ELSE p_name END"


_MERGED_MOVIES = f"""SELECT p_partkey AS movie_id,
  CASE WHEN p_brand <> 'Brand#7' THEN coalesce({_SOURCE}, 'gone') ELSE 'old' END AS title,
  CASE WHEN p_brand <> 'Brand#7' THEN p_retailprice ELSE 0 END AS vote_average,
  CASE WHEN p_brand <> 'Brand#7' THEN 'new' ELSE 'kept' END AS stamped
  FROM part WHERE p_type <> 'PROMO' OR p_brand <> 'Brand#7'"""


def _movie_versions(spark, sf):
    """Target lacks one part type, source lacks one brand; the source's NULL titles overwrite."""
    part = V.load(spark, sf, "part")
    target = part.filter("p_type <> 'PROMO'").select(
        F.col("p_partkey").alias("movie_id"),
        F.lit("old").alias("title"),
        F.lit(0.0).alias("vote_average"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )
    source = part.filter("p_brand <> 'Brand#7'").select(
        F.col("p_partkey").alias("movie_id"),
        F.when(F.col("p_size") <= 30, F.col("p_name")).alias("title"),
        F.col("p_retailprice").alias("vote_average"),
    )
    return target, source


def _merged_movies(merged):
    stamped = F.when(F.col("updated_at") == V.as_of(), F.lit("new")).otherwise(F.lit("kept"))
    return merged.select("movie_id", F.coalesce("title", F.lit("gone")).alias("title"), "vote_average", stamped.alias("stamped"))


@query("merge_movies", _MERGED_MOVIES)
def merge_movies(spark, sf):
    target, source = _movie_versions(spark, sf)
    return _merged_movies(merge.merge_movies(target, source, V.as_of()))


@query("merge_movies_bucketed", _MERGED_MOVIES)
def merge_movies_bucketed(spark, sf):
    target, source = _movie_versions(spark, sf)
    path = scratch_dir(spark, "movies")
    merge.write_buckets(target, path, ["movie_id"], 16)
    merge.merge_into_buckets(spark, path, source, ["movie_id"], 16, stamp={"updated_at": V.as_of()})
    return _merged_movies(spark.read.parquet(path))


@query(
    "merge_embeddings",
    """SELECT vec_id AS movie_id, round(CAST(CASE WHEN label <> 4 THEN embedding[1] ELSE 0 END AS DOUBLE), 5) AS first,
       CASE WHEN label <> 4 THEN 'v2' ELSE 'v1' END AS embedding_model FROM embeddings""",
)
def merge_embeddings(spark, sf):
    vectors = V.vectors(spark, sf)
    target = vectors.filter("label <> 2").select(
        "movie_id",
        F.lit("t").alias("title"),
        F.array(F.lit(0.0).cast("float")).alias("embedding_vector"),
        F.lit("v1").alias("embedding_model"),
        F.lit(None).cast("timestamp_ntz").alias("embedded_at"),
    )
    source = vectors.filter("label <> 4").select("movie_id", F.lit("t").alias("title"), "embedding_vector")
    merged = merge.merge_embeddings(target, source, "v2", V.as_of())
    return merged.select(
        "movie_id", F.round(F.element_at("embedding_vector", 1).cast("double"), 5).alias("first"), "embedding_model"
    )


# Rating requests are events on a catalogue entry: the group is the user, the request order is the event id.
_RATING_REQUESTS = """requests AS (
  SELECT event_id AS request_id, user_id AS group_id, event_id % ((SELECT count(*) FROM part) + 50) AS movie_id,
         CAST(greatest(1, least(10, CAST(trunc(value / 5) AS INTEGER))) AS INTEGER) AS score, event_type AS comment FROM events),
last_requests AS (
  SELECT * FROM requests QUALIFY row_number() OVER (PARTITION BY group_id, movie_id ORDER BY request_id DESC) = 1)"""


def _rating_requests(spark, sf):
    events = V.load(spark, sf, "events")
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("user_id").alias("group_id"),
        V.movie_ref(spark, sf, "event_id"),
        (F.col("value") / 5).cast("int").alias("score"),
        F.col("event_type").alias("comment"),
    )


@query(
    "upsert_ratings",
    with_views(
        """SELECT rating_id, r.group_id, r.movie_id, coalesce(q.score, r.score) AS score, coalesce(q.comment, r.comment) AS comment,
             CASE WHEN q.score IS NULL THEN 'kept' ELSE 'new' END AS stamped
           FROM ratings r LEFT JOIN last_requests q USING (group_id, movie_id)
           UNION ALL
           SELECT (SELECT max(rating_id) FROM ratings) + row_number() OVER (ORDER BY request_id), group_id, movie_id, score, comment, 'new'
           FROM last_requests q WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.group_id = q.group_id AND r.movie_id = q.movie_id)""",
        V.RATINGS,
        _RATING_REQUESTS,
    ),
)
def upsert_ratings(spark, sf):
    merged = merge.upsert_ratings(V.ratings(spark, sf), _rating_requests(spark, sf), V.as_of())
    stamped = F.when(F.col("rated_at") == V.as_of(), F.lit("new")).otherwise(F.lit("kept"))
    return merged.select("rating_id", "group_id", "movie_id", "score", "comment", stamped.alias("stamped"))


@query(
    "rating_version_feed",
    with_views(
        """SELECT 'update_preimage' AS change, r.group_id, r.movie_id, r.score FROM ratings r JOIN last_requests q USING (group_id, movie_id)
           UNION ALL
           SELECT 'update_postimage', r.group_id, r.movie_id, q.score FROM ratings r JOIN last_requests q USING (group_id, movie_id)
           UNION ALL
           SELECT 'insert', group_id, movie_id, score FROM last_requests q
           WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.group_id = q.group_id AND r.movie_id = q.movie_id)""",
        V.RATINGS,
        _RATING_REQUESTS,
    ),
)
def rating_version_feed(spark, sf):
    """What one batch of rating requests changed in the keyed table, from its versions before and after."""
    ns = tables.Namespace.fresh(spark, "versions")
    ns.create(spark, ["ratings"])
    tables.replace(V.ratings(spark, sf), ns, "ratings")
    before = ns.keyed("ratings").manifest(spark).version
    ready, how = merge.rating_merge(ns.scan(spark, "ratings"), _rating_requests(spark, sf), V.as_of())
    tables.merge_into(ready, ns, "ratings", **how)
    return tables.version_feed(spark, ns, "ratings", before, keys=["rating_id"]).select("change", "group_id", "movie_id", "score")


_PURCHASES = """requests AS (
  SELECT rec_id AS request_id, group_id, movie_id, reason FROM recommendations)"""


@query(
    "append_watchlist",
    with_views(
        """SELECT (SELECT max(item_id) FROM watchlist) + row_number() OVER (ORDER BY request_id) AS item_id, group_id, movie_id,
             CASE WHEN reason < '{"k": 5}' THEN 'watched' ELSE 'queued' END AS status, 1 AS added_by
           FROM requests""",
        V.WATCHLIST,
        V.RECOMMENDATIONS,
        _PURCHASES,
    ),
)
def append_watchlist(spark, sf):
    status = F.when(F.col("reason") < '{"k": 5}', F.lit("watched")).otherwise(F.lit("later"))
    requests = V.recommendations(spark, sf).select(
        F.col("rec_id").alias("request_id"), "group_id", "movie_id", status.alias("status")
    )
    return merge.append_watchlist(V.watchlist(spark, sf), requests, V.as_of()).drop("added_at")


@query(
    "append_recommendations",
    with_views(
        """SELECT (SELECT max(rec_id) FROM recommendations) + row_number() OVER (ORDER BY item_id) AS rec_id, group_id, movie_id,
             substr(repeat(status, 100), 1, 500) AS reason, 'agent' AS recommended_by FROM watchlist""",
        V.WATCHLIST,
        V.RECOMMENDATIONS,
    ),
)
def append_recommendations(spark, sf):
    requests = V.watchlist(spark, sf).select(
        F.col("item_id").alias("request_id"), "group_id", "movie_id", F.repeat("status", F.lit(100)).alias("reason")
    )
    return merge.append_recommendations(V.recommendations(spark, sf), requests, V.as_of()).drop("recommended_at")


@query(
    "allocate_ids",
    """SELECT event_id, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY value, event_id) AS new_id FROM events""",
)
def allocate(spark, sf):
    events = V.load(spark, sf, "events").select("event_id", "value")
    existing = V.load(spark, sf, "orders").select(F.col("o_orderkey").alias("new_id"))
    return allocate_ids(events, existing, "new_id", "value", ["event_id"]).drop("value")
