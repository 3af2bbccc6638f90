"""JSON flattening and scalar functions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import columns as C
from marquee.operators import silver
from marquee.plans import views as V
from marquee.plans.registry import query, with_views


@query(
    "silver_parse_movie",
    with_views("SELECT movie_id AS id, title, CAST(runtime AS DOUBLE) AS runtime, vote_average, 2 AS n_genres FROM movies", V.MOVIES),
)
def silver_parse_movie(spark, sf):
    return silver.parse_movies(V.raw_movies(spark, sf)).select(
        "id", "title", "runtime", "vote_average", F.size("genres").alias("n_genres")
    )


@query(
    "silver_movies",
    with_views(
        """SELECT movie_id, title, original_title, md5(coalesce(overview, '')) AS overview_md5, tagline, runtime, vote_average,
           coalesce(vote_count, -1) AS vote_count, release_date, coalesce(year, -1) AS year,
           genres[1] || '/' || genres[2] AS genres, 'en' AS language, 'Released' AS status FROM movies""",
        V.MOVIES,
    ),
)
def silver_movies(spark, sf):
    return silver.movies(V.raw_movies(spark, sf)).select(
        "movie_id",
        "title",
        "original_title",
        F.md5(F.coalesce("overview", F.lit(""))).alias("overview_md5"),
        "tagline",
        "runtime",
        "vote_average",
        F.coalesce("vote_count", F.lit(-1)).alias("vote_count"),
        F.col("release_date").cast("string").alias("release_date"),
        F.coalesce("year", F.lit(-1)).alias("year"),
        F.array_join("genres", "/").alias("genres"),
        "language",
        "status",
    )


@query(
    "silver_genres",
    """SELECT CAST(substr(p_brand, 7) AS INTEGER) AS genre_id, arg_max(p_name, p_partkey) AS name FROM part GROUP BY 1""",
)
def silver_genres(spark, sf):
    return silver.genres(V.raw_genres(spark, sf))


@query("silver_cast", with_views('SELECT person_id, movie_id, name, "character", credit_order FROM cast_t', V.CAST))
def silver_cast(spark, sf):
    return silver.cast(V.raw_credits(spark, sf))


@query("silver_keywords", with_views("SELECT movie_id, keyword_id, keyword FROM keywords_t", V.KEYWORDS))
def silver_keywords(spark, sf):
    return silver.keywords(V.raw_keywords(spark, sf))


@query(
    "silver_reviews",
    with_views(
        """SELECT review_id, movie_id, author, CAST(rating AS DOUBLE) AS rating, md5(content) AS content_md5, created_at, url
           FROM reviews_t""",
        V.REVIEWS,
    ),
)
def silver_reviews(spark, sf):
    return silver.reviews(V.raw_reviews(spark, sf)).withColumn("content_md5", F.md5("content")).drop("content")


_PROVIDERS = """SELECT DISTINCT l_partkey AS movie_id, CASE WHEN l_linestatus = 'F' THEN 'US' ELSE 'CA' END AS country,
  'S' || l_suppkey AS provider_name,
  CASE l_returnflag WHEN 'A' THEN 'flatrate' WHEN 'N' THEN 'rent' ELSE 'buy' END AS provider_type FROM lineitem"""


@query("silver_providers", f"{_PROVIDERS} WHERE l_linestatus = 'F'")
def silver_providers(spark, sf):
    return silver.providers(V.raw_providers(spark, sf))


@query("silver_providers_all", _PROVIDERS)
def silver_providers_all(spark, sf):
    return silver.providers(V.raw_providers(spark, sf), countries=None)


@query(
    "payload_profile",
    """SELECT 4 * count(*) AS n_rows, 3 * count(*) AS n_with_id, 2 * count(*) AS n_with_runtime, 2 * count(*) AS n_with_genres,
       count(*) AS n_corrupt FROM part""",
)
def payload_profile(spark, sf):
    return silver.payload_profile(V.raw_movies(spark, sf))


@query(
    "genre_names",
    "SELECT p_partkey AS movie_id, p_type || '/' || CASE WHEN p_size > 20 THEN p_brand ELSE '?' END AS names FROM part",
)
def genre_names(spark, sf):
    genre = F.array(
        F.struct(F.col("p_type").alias("name")), F.struct(F.when(F.col("p_size") > 20, F.col("p_brand")).alias("name"))
    )
    part = V.load(spark, sf, "part").select(F.col("p_partkey").alias("movie_id"), C.names_of(genre).alias("names"))
    return part.select("movie_id", F.array_join("names", "/", "?").alias("names"))


@query(
    "safe_date_year",
    with_views("SELECT movie_id, release_date, coalesce(year, -1) AS year FROM movies", V.MOVIES),
)
def safe_date_year(spark, sf):
    released = C.safe_date(V.release_text())
    return V.load(spark, sf, "part").select(
        F.col("p_partkey").alias("movie_id"),
        released.cast("string").alias("release_date"),
        F.coalesce(F.year(released), F.lit(-1)).alias("year"),
    )


@query(
    "null_filters",
    """SELECT doc_id FROM documents WHERE nullif(lang, 'en') IS NOT NULL OR length(CASE WHEN n_chars < 500 THEN '' ELSE source END) > 0""",
)
def null_filters(spark, sf):
    docs = V.load(spark, sf, "documents")
    title = F.when(F.col("n_chars") < 500, F.lit("")).otherwise(F.col("source"))
    return docs.filter(C.has_text(title, F.nullif(F.col("lang"), F.lit("en")))).select("doc_id")


@query(
    "title_match",
    """SELECT p_partkey AS movie_id FROM part WHERE lower(p_name) LIKE lower('%ED W_d%') OR lower(nullif(p_brand, 'Brand#3')) LIKE lower('%ED W_d%')
       OR lower(p_name) LIKE '%brand#1%' OR lower(nullif(p_brand, 'Brand#3')) LIKE '%brand#1%'""",
)
def title_match(spark, sf):
    part = V.load(spark, sf, "part").withColumn("p_brand", F.nullif(F.col("p_brand"), F.lit("Brand#3")))
    titles = (F.col("p_name"), F.col("p_brand"))
    wild = C.title_like(F.lit("ED W_d"), *titles)
    return part.filter(wild | C.title_like(F.lit("Brand#1"), *titles, literal=True)).select(F.col("p_partkey").alias("movie_id"))


@query("runtime_bound", "SELECT p_partkey AS movie_id, p_size AS runtime FROM part WHERE nullif(p_size, 9) <= 20")
def runtime_bound(spark, sf):
    runtime = F.nullif(F.col("p_size"), F.lit(9))
    part = V.load(spark, sf, "part").filter(C.runtime_within(runtime, 20) & C.runtime_within(runtime, -1))
    return part.select(F.col("p_partkey").alias("movie_id"), F.col("p_size").alias("runtime"))


@query("genre_filter", "SELECT p_partkey AS movie_id FROM part WHERE lower(p_type) = 'economy' AND p_size <> 9")
def genre_filter(spark, sf):
    genres = F.when(F.col("p_size") != 9, F.array("p_type", "p_brand"))
    return V.load(spark, sf, "part").filter(C.has_genre(genres, " Economy\t")).select(F.col("p_partkey").alias("movie_id"))


@query(
    "overview_snippet",
    """SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS snippet
       FROM (SELECT doc_id, CASE WHEN lang = 'de' THEN '' ELSE text END AS text FROM documents)""",
)
def overview_snippet(spark, sf):
    text = F.nullif(F.col("text"), F.when(F.col("lang") == "de", F.col("text")))
    return V.load(spark, sf, "documents").select("doc_id", C.summary_snippet(text).alias("snippet"))


@query(
    "normalise_writes",
    """SELECT o_orderkey, CAST(greatest(1, least(10, CAST(floor(o_totalprice / 30000) AS INTEGER))) AS INTEGER) AS score,
       CASE o_orderstatus WHEN 'F' THEN 'watched' ELSE 'queued' END AS status,
       length(substr(repeat(o_orderpriority, 100), 1, 500)) AS reason_chars FROM orders""",
)
def normalise_writes(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", F.lit("watched")).when(F.col("o_orderstatus") == "P", F.lit("foo"))
    return V.load(spark, sf, "orders").select(
        "o_orderkey",
        C.clamp_score(F.floor(F.col("o_totalprice") / 30000)).alias("score"),
        C.watch_status(status).alias("status"),
        F.length(C.short_reason(F.repeat("o_orderpriority", F.lit(100)))).cast("bigint").alias("reason_chars"),
    )


@query(
    "genres_text",
    "SELECT p_partkey AS movie_id, CASE WHEN p_size = 9 THEN '' ELSE p_type || ', ' || p_brand END AS genres FROM part",
)
def genres_text(spark, sf):
    genres = F.when(F.col("p_size") != 9, F.array("p_type", "p_brand"))
    return V.load(spark, sf, "part").select(F.col("p_partkey").alias("movie_id"), C.genres_text(genres).alias("genres"))
