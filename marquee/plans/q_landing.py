"""Landing, tables and sinks over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions.columns import row_json
from marquee.operators import silver
from marquee.operators.dedup import dedup_first, dedup_latest
from marquee.plans import views as V
from marquee.plans.registry import query, with_views
from marquee.session import scratch_dir
from marquee.sources import landing, tables
from marquee.streaming.landing import land_stream, read_stream


@query("scan_project", "SELECT p_partkey AS movie_id, p_name AS title, CAST(p_size AS DOUBLE) AS runtime FROM part WHERE p_size > 10")
def scan_project(spark, sf):
    part = V.load(spark, sf, "part").filter("p_size > 10")
    return part.select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"), F.col("p_size").cast("double").alias("runtime")
    )


@query(
    "bronze_land_json",
    """SELECT p_partkey AS tmdb_id, p_name AS title, md5('{"id":' || p_partkey || ',"title":"' || p_name || '"}') AS payload_md5,
       CAST(1704067200 AS BIGINT) AS fetched_at FROM part""",
)
def bronze_land_json(spark, sf):
    part = V.load(spark, sf, "part")
    doc = F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title")))
    no_id = F.to_json(F.struct(F.col("p_name").alias("title")))
    path = scratch_dir(spark, "documents")
    part.select(F.explode(F.array(doc, doc, no_id)).alias("value")).write.text(path)
    landed = landing.land_documents(landing.read_documents(spark, path), V.landed_at(F.lit(0)))
    return landed.select(
        "tmdb_id",
        F.get_json_object("payload", "$.title").alias("title"),
        F.md5("payload").alias("payload_md5"),
        F.unix_timestamp("fetched_at").alias("fetched_at"),
    )


def _pages(spark, sf):
    orders = V.load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    last = orders.select((F.max("o_orderkey") / 20).cast("int").alias("n")).scalar() + 1
    # Twenty results to a page by construction.
    item = F.struct("o_orderkey", F.struct(F.col("o_custkey").alias("id")).alias("item"))
    pages = orders.groupBy((F.floor(F.col("o_orderkey") / 20) + 1).cast("int").alias("page")).agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"]).alias("results")
    )
    return pages.select(F.to_json(F.struct("page", last.alias("total_pages"), "results")).alias("payload"))


_RANKED = """ranked AS (
  SELECT o_custkey AS id, min(o_orderkey) AS place FROM orders GROUP BY o_custkey)"""


@query(
    "paged_ids_ranked",
    with_views("SELECT id, CAST(place // 20 + 1 AS INTEGER) AS page, CAST(place % 20 AS INTEGER) AS pos FROM ranked", _RANKED),
)
def paged_ids_ranked(spark, sf):
    return landing.ranked_ids(_pages(spark, sf), max_pages=None)


@query(
    "enrich_topn",
    with_views(
        """SELECT id, CAST(place // 20 + 1 AS INTEGER) AS page, CAST(place % 20 AS INTEGER) AS pos FROM ranked
           WHERE id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup') ORDER BY place LIMIT 200""",
        _RANKED,
    ),
)
def enrich_topn(spark, sf):
    enriched = V.load(spark, sf, "events").filter("event_type = 'signup'").select(F.col("user_id").alias("id"))
    return landing.top_to_enrich(landing.ranked_ids(_pages(spark, sf), max_pages=None), enriched)


@query(
    "fresh_skip_anti",
    """SELECT c_custkey AS user_id, c_name AS name FROM customer WHERE c_custkey NOT IN (
       SELECT user_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS)""",
)
def fresh_skip_anti(spark, sf):
    landed = V.load(spark, sf, "events").select("user_id", F.col("ts").alias("fetched_at"))
    incoming = V.load(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    newest = landed.select(F.max("fetched_at").alias("at")).scalar()
    return landing.not_fresh(incoming, landed, "user_id", newest)


_PER_USER = "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts {}) = 1"


@query("dedup_first", _PER_USER.format("ASC"))
def first_per_user(spark, sf):
    events = V.load(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return dedup_first(events, ["user_id"], ["ts"]).drop("ts")


@query("dedup_latest", _PER_USER.format("DESC"))
def latest_per_user(spark, sf):
    events = V.load(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return dedup_latest(events, ["user_id"], ["ts"]).drop("ts")


@query(
    "reviews_top5",
    """SELECT o_orderkey // 20 AS tmdb_id, 'o' || o_orderkey AS review_id, o_orderpriority AS content
       FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey // 20 ORDER BY o_orderkey) <= 5""",
)
def reviews_top5(spark, sf):
    orders = V.load(spark, sf, "orders")
    # Twenty reviews to a payload by construction.
    review = F.struct(
        "o_orderkey", F.struct(F.concat(F.lit("o"), "o_orderkey").alias("id"), F.col("o_orderpriority").alias("content")).alias("r")
    )
    raw = orders.groupBy(F.floor(F.col("o_orderkey") / 20).cast("bigint").alias("tmdb_id")).agg(
        F.transform(F.array_sort(F.collect_list(review)), lambda x: x["r"]).alias("results")
    )
    pages = raw.select(
        "tmdb_id",
        F.lit("orders").alias("source_url"),
        V.landed_at(F.lit(0)).alias("fetched_at"),
        F.to_json(F.struct("results")).alias("payload"),
    )
    return landing.first_reviews(pages).select(
        "tmdb_id", "review_id", F.get_json_object("payload", "$.content").alias("content")
    )


@query(
    "sink_overwrite_roundtrip",
    "SELECT p_partkey AS movie_id, p_name AS title, p_size AS runtime FROM part UNION ALL SELECT c_custkey, c_name, NULL FROM customer",
)
def sink_overwrite_roundtrip(spark, sf):
    ns = tables.Namespace.fresh(spark, "sinks")
    ns.create(spark, ["movies"])
    stale = V.load(spark, sf, "supplier").select(F.col("s_suppkey").alias("movie_id"), F.col("s_name").alias("title"))
    parts = V.load(spark, sf, "part").select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"), F.col("p_size").alias("runtime")
    )
    people = V.load(spark, sf, "customer").select(F.col("c_custkey").alias("movie_id"), F.col("c_name").alias("title"))
    tables.append(stale, ns, "movies")
    tables.replace(parts, ns, "movies")
    tables.append(people, ns, "movies")
    return ns.scan(spark, "movies").select("movie_id", "title", "runtime")


_BEFORE = """before AS (SELECT p_partkey AS movie_id, p_name AS title,
    CASE WHEN p_size > 40 THEN p_retailprice + 1 ELSE p_retailprice END AS vote_average FROM part WHERE p_type <> 'PROMO'),
  after AS (SELECT p_partkey AS movie_id, p_name AS title, p_retailprice AS vote_average FROM part WHERE p_brand <> 'Brand#7')"""


def snapshots(spark, sf):
    part = V.load(spark, sf, "part")
    cols = [F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title")]
    price = F.col("p_retailprice")
    before = part.filter("p_type <> 'PROMO'").select(
        *cols, F.when(F.col("p_size") > 40, price + 1).otherwise(price).alias("vote_average")
    )
    return before, part.filter("p_brand <> 'Brand#7'").select(*cols, price.alias("vote_average"))


@query(
    "snapshot_change_feed",
    with_views(
        """SELECT 'insert' AS change, a.* FROM after a ANTI JOIN before b USING (movie_id)
           UNION ALL SELECT 'delete', b.* FROM before b ANTI JOIN after a USING (movie_id)
           UNION ALL SELECT 'update_preimage', b.* FROM before b JOIN after a USING (movie_id) WHERE a.vote_average <> b.vote_average
           UNION ALL SELECT 'update_postimage', a.* FROM before b JOIN after a USING (movie_id) WHERE a.vote_average <> b.vote_average""",
        _BEFORE,
    ),
)
def snapshot_change_feed(spark, sf):
    before, after = snapshots(spark, sf)
    return tables.change_feed(before, after, ["movie_id"])


@query(
    "seed_group",
    """SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS likes FROM customer
       UNION ALL SELECT -1, 'first', 'drama,comedy' UNION ALL SELECT -2, 'second', ''""",
)
def seed_group(spark, sf):
    customers = V.load(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.array("c_mktsegment").alias("preferences")
    )
    seeds = [(-1, "first", ["drama", "comedy"]), (-2, "second", [])]
    filled = tables.seed_if_empty(customers, seeds)
    empty = tables.seed_if_empty(customers.filter("c_custkey < 0").select(*filled.columns), seeds)
    return filled.unionByName(empty).select("user_id", "name", F.array_join("preferences", ",").alias("likes"))


@query(
    "run_log_counts",
    """SELECT 'watchlist' AS step, count(*) AS rows, 'success' AS status FROM orders
       UNION ALL SELECT 'movies', count(*), 'success' FROM part
       UNION ALL SELECT 'broken', 0, 'failure'""",
)
def run_log_counts(spark, sf):
    ns = tables.Namespace.fresh(spark, "log")
    ns.create(spark, ["watchlist_items", "movies", "pipeline_log"])
    tables.logged_step(ns, spark, "watchlist", lambda: tables.append(V.watchlist(spark, sf), ns, "watchlist_items"))
    tables.logged_step(ns, spark, "movies", lambda: tables.replace(V.movies(spark, sf), ns, "movies"))

    def broken() -> int:
        raise ValueError("this step fails")

    try:
        tables.logged_step(ns, spark, "broken", broken)
    except ValueError:
        pass
    return ns.scan(spark, "pipeline_log").select("step", "rows", "status")


_COUNTED = ("customer", "documents", "events", "lineitem", "orders", "part")


@query("bronze_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _COUNTED))
def bronze_counts(spark, sf):
    return tables.row_counts({t: V.load(spark, sf, t) for t in _COUNTED})


@query(
    "table_counts",
    """SELECT count(*) AS n_rows, count(*) FILTER (label <> 3) AS n_with_vector FROM embeddings""",
)
def table_counts(spark, sf):
    vectors = V.vectors(spark, sf).withColumn("embedding_vector", F.when(F.col("label") != 3, F.col("embedding_vector")))
    return vectors.agg(F.count(F.lit(1)).alias("n_rows"), F.count("embedding_vector").alias("n_with_vector"))


_LOADED = ("genres", "group_members", "groups", "movie_embeddings", "movies", "ratings", "recommendations", "users", "watchlist_items")


@query(
    "ddl_catalog",
    """SELECT 'genres' AS table_name, count(DISTINCT p_brand) AS n_rows FROM part
       UNION ALL SELECT 'group_members', count(*) FROM customer UNION ALL SELECT 'groups', count(*) FROM nation
       UNION ALL SELECT 'movie_embeddings', count(*) FROM embeddings UNION ALL SELECT 'movies', count(*) FROM part
       UNION ALL SELECT 'ratings', count(*) FROM orders
       UNION ALL SELECT 'recommendations', count(*) FROM events WHERE event_type = 'purchase'
       UNION ALL SELECT 'users', count(*) FROM customer UNION ALL SELECT 'watchlist_items', count(*) FROM orders""",
)
def ddl_catalog(spark, sf):
    """Create all twenty tables, load the nine the test tables can fill, and count them through the catalogue."""
    ns = tables.Namespace.fresh(spark, "catalog")
    ns.create(spark)
    ns.create(spark)
    frames = {
        "genres": silver.genres(V.raw_genres(spark, sf)),
        "group_members": V.members(spark, sf),
        "groups": V.groups(spark, sf),
        "movie_embeddings": V.vectors(spark, sf),
        "movies": V.movies(spark, sf),
        "ratings": V.ratings(spark, sf),
        "recommendations": V.recommendations(spark, sf),
        "users": V.users(spark, sf),
        "watchlist_items": V.watchlist(spark, sf),
    }
    for name, df in frames.items():
        tables.append(df, ns, name)
    return tables.row_counts({name: ns.scan(spark, name) for name in _LOADED})


@query(
    "result_to_json",
    """SELECT p_partkey AS movie_id, '{"title":"' || p_name || '","runtime":' || p_size || ',"released":' ||
       CASE WHEN p_size IN (7, 13) THEN 'null' ELSE '"' || (1950 + p_size) || '-' || lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') || '-15"' END ||
       ',"genres":["' || p_type || '","' || p_brand || '"]}' AS record FROM part""",
)
def result_to_json(spark, sf):
    part = V.load(spark, sf, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_size").alias("runtime"),
        V.release_text().try_cast("date").alias("released"),
        F.array("p_type", "p_brand").alias("genres"),
    )
    return part.select("movie_id", row_json("title", "runtime", "released", "genres").alias("record"))


@query("stream_land_dedup", "SELECT event_id, user_id, event_type, value, props FROM events")
def stream_land_dedup(spark, sf):
    """Events written as files twice over, landed by a stream one file at a time; each event comes out once."""
    source, target, state = (scratch_dir(spark, label) for label in ("incoming", "landed", "state"))
    events = V.load(spark, sf, "events").withColumn("fetched_at", F.col("ts").cast("timestamp")).drop("ts")
    again = events.withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 HOUR"))
    events.union(again).write.parquet(source)
    stream = read_stream(spark, source, events.schema, files_per_batch=1)
    land_stream(stream, ["event_id"], target, state).awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value", "props")


@query(
    "stream_land_window",
    """WITH RECURSIVE e AS (SELECT event_type, CAST(ts AS TIMESTAMP) AS t FROM events),
  landed AS (
    SELECT event_type, min(t) AS t FROM e GROUP BY 1
    UNION ALL
    SELECT l.event_type, min(e.t) AS t FROM landed l JOIN e ON e.event_type = l.event_type AND e.t > l.t + INTERVAL 6 HOUR GROUP BY 1)
SELECT event_type, epoch_us(t) AS landed_at FROM landed""",
)
def stream_land_window(spark, sf):
    """All events landed by type, each type once in six hours: repeats inside and past the window."""
    source, target, state = (scratch_dir(spark, label) for label in ("incoming", "landed", "state"))
    events = V.load(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("fetched_at"))
    events.write.parquet(source)
    land_stream(read_stream(spark, source, events.schema), ["event_type"], target, state, hours=6).awaitTermination()
    return spark.read.parquet(target).select("event_type", F.unix_micros("fetched_at").alias("landed_at"))
