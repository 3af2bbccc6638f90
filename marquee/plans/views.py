"""The test tables in the shape of the catalogue tables, as frames and as the same views in plain SQL.

Bronze frames are real JSON text made with ``to_json``; their SQL counterparts start from the base tables, so a parse that
loses or changes a value shows up as a difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def landed_at(seconds) -> Column:
    """A landing time: the first second of 2024 (UTC) plus ``seconds``."""
    return F.timestamp_seconds(F.lit(1704067200) + seconds)


AS_OF = "2024-02-01 00:00:00"


def as_of() -> Column:
    return F.to_timestamp_ntz(F.lit(AS_OF))


# Catalogue -----------------------------------------------------------------------------------------------------------

MOVIES = """movies AS (
  SELECT p_partkey AS movie_id, p_name AS title, p_brand AS original_title,
         CASE WHEN p_size > 1 THEN repeat(p_name || ' ', p_size) END AS overview,
         CASE WHEN p_size > 25 THEN p_type END AS tagline,
         p_size AS runtime, p_retailprice AS vote_average, n AS vote_count,
         CASE WHEN p_size IN (7, 13) THEN NULL
              ELSE (1950 + p_size) || '-' || lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') || '-15' END AS release_date,
         CASE WHEN p_size IN (7, 13) THEN NULL ELSE 1950 + p_size END AS year,
         [p_type, p_brand] AS genres
  FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey)"""


def release_text() -> Column:
    size = F.col("p_size")
    usual = F.concat_ws("-", (size + 1950).cast("string"), F.lpad((size % 12 + 1).cast("string"), 2, "0"), F.lit("15"))
    return F.when(size == 7, F.lit("")).when(size == 13, F.lit("2020-13-02")).otherwise(usual)


def _described_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = load(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    part = load(spark, sf_dir, "part")
    return part.join(votes, part.p_partkey == votes.l_partkey, "left").select(
        part["*"],
        "n",
        F.when(F.col("p_size") > 1, F.expr("repeat(p_name || ' ', p_size)")).alias("overview"),
        F.when(F.col("p_size") > 25, F.col("p_type")).alias("tagline"),
        release_text().alias("release_text"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    released = F.col("release_text").try_cast("date")
    return _described_parts(spark, sf_dir).select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("original_title"),
        "overview",
        "tagline",
        F.col("p_size").alias("runtime"),
        F.col("p_retailprice").alias("vote_average"),
        F.col("n").alias("vote_count"),
        released.alias("release_date"),
        F.year(released).alias("year"),
        F.array("p_type", "p_brand").alias("genres"),
    )


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three payloads per part: a list-shaped one, an outdated detail, and the current detail; plus text that is not JSON."""
    genre = F.array(
        F.struct(F.lit(1).alias("id"), F.col("p_type").alias("name")),
        F.struct(F.lit(2).alias("id"), F.col("p_brand").alias("name")),
    )

    def detail(title: Column) -> Column:
        return F.to_json(
            F.struct(
                F.col("p_partkey").alias("id"),
                title.alias("title"),
                F.col("p_brand").alias("original_title"),
                "overview",
                "tagline",
                F.col("p_size").alias("runtime"),
                F.col("p_retailprice").alias("vote_average"),
                F.col("n").alias("vote_count"),
                F.col("release_text").alias("release_date"),
                F.lit("en").alias("original_language"),
                F.lit("Released").alias("status"),
                genre.alias("genres"),
            )
        )

    listed = F.to_json(F.struct(F.col("p_partkey").alias("id"), F.array(F.lit(1), F.lit(2)).alias("genre_ids")))
    versions = F.array(
        F.struct(F.lit(0).alias("age"), listed.alias("payload")),
        F.struct(F.lit(1).alias("age"), detail(F.concat(F.lit("old "), "p_name")).alias("payload")),
        F.struct(F.lit(2).alias("age"), detail(F.col("p_name")).alias("payload")),
        F.struct(F.lit(3).alias("age"), F.concat(F.lit("not json "), "p_name").alias("payload")),
    )
    return _described_parts(spark, sf_dir).select(F.col("p_partkey").alias("tmdb_id"), F.inline(versions)).select(
        "tmdb_id",
        F.lit("parts").alias("source_url"),
        landed_at(F.col("age")).alias("fetched_at"),
        "payload",
    )


def raw_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One genre payload per part; the brand number is the genre id and the newest name wins."""
    payload = F.to_json(F.struct(F.expr("cast(substring(p_brand, 7) as int)").alias("id"), F.col("p_name").alias("name")))
    return load(spark, sf_dir, "part").select(landed_at(F.col("p_partkey")).alias("fetched_at"), payload.alias("payload"))


# Children of a catalogue entry, from documents: the entry is the document's source --------------------------------------

SOURCE_ID = "CAST(substr(source, 4) AS BIGINT)"


def _source_id() -> Column:
    return F.expr("cast(substring(source, 4) as bigint)").alias("tmdb_id")


def raw_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One credits payload per labelled document: its own person, a person without id, and one shared by label."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    people = F.array(
        F.struct(
            F.col("doc_id").alias("id"),
            F.concat(F.lit("p"), "doc_id").alias("name"),
            F.col("lang").alias("character"),
            F.col("n_chars").cast("int").alias("order"),
        ),
        F.struct(F.lit(None).cast("bigint").alias("id"), F.lit("x").alias("name"), F.lit("x").alias("character"), F.lit(0).alias("order")),
        F.struct(
            (F.lit(-1) - F.col("quality")).cast("bigint").alias("id"),
            F.col("lang").alias("name"),
            F.lit("shared").alias("character"),
            F.col("toxic").cast("int").alias("order"),
        ),
    )
    return docs.join(load(spark, sf_dir, "labels"), "doc_id").select(
        _source_id(), landed_at(F.col("doc_id")).alias("fetched_at"), F.to_json(F.struct(people.alias("cast"))).alias("payload")
    )


CAST = f"""credits AS (
  SELECT doc_id, {SOURCE_ID} AS movie_id, lang, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)),
cast_rows AS (
  SELECT doc_id AS seq, doc_id AS person_id, movie_id, 'p' || doc_id AS name, lang AS "character", CAST(n_chars AS INTEGER) AS credit_order FROM credits
  UNION ALL
  SELECT doc_id, -1 - quality, movie_id, lang, 'shared', toxic FROM credits),
cast_t AS (
  SELECT * EXCLUDE (seq) FROM cast_rows QUALIFY row_number() OVER (PARTITION BY person_id, movie_id ORDER BY seq DESC) = 1)"""


def raw_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One keywords payload per document: its language, and a keyword without id."""
    words = F.array(
        F.struct((F.ascii("lang") * 256 + F.ascii(F.substring("lang", 2, 1))).cast("bigint").alias("id"), F.col("lang").alias("name")),
        F.struct(F.lit(None).cast("bigint").alias("id"), F.lit("x").alias("name")),
    )
    return load(spark, sf_dir, "documents").select(
        _source_id(), landed_at(F.col("doc_id")).alias("fetched_at"), F.to_json(F.struct(words.alias("keywords"))).alias("payload")
    )


KEYWORDS = f"""keywords_t AS (
  SELECT DISTINCT {SOURCE_ID} AS movie_id, CAST(ascii(lang) * 256 + ascii(substr(lang, 2, 1)) AS BIGINT) AS keyword_id, lang AS keyword
  FROM documents)"""


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reviews payload per document: the review twice on a page for English, a single review otherwise."""
    review = F.struct(
        F.concat(F.lit("r"), "doc_id").alias("id"),
        F.col("lang").alias("author"),
        F.col("text").alias("content"),
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("created_at"),
        F.concat(F.lit("u"), "doc_id").alias("url"),
        F.struct((F.col("n_chars") % 21 / 2).alias("rating")).alias("author_details"),
    )
    page = F.to_json(F.struct(F.col("doc_id").alias("id"), F.lit(1).alias("page"), F.array(review, review).alias("results")))
    return load(spark, sf_dir, "documents").select(
        _source_id(),
        F.lit("documents").alias("source_url"),
        landed_at(F.col("doc_id")).alias("fetched_at"),
        F.when(F.col("lang") == "en", page).otherwise(F.to_json(review)).alias("payload"),
    )


REVIEWS = f"""reviews_t AS (
  SELECT 'r' || doc_id AS review_id, {SOURCE_ID} AS movie_id, lang AS author, (n_chars % 21) / 2.0 AS rating, text AS content,
         lpad(CAST(doc_id AS VARCHAR), 12, '0') AS created_at, 'u' || doc_id AS url
  FROM documents)"""


def raw_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One provider payload per line item: the supplier under the list its return flag names, in US or CA by line status."""
    one = F.array(F.struct(F.concat(F.lit("S"), "l_suppkey").alias("provider_name")))
    lists = F.struct(
        F.when(F.col("l_returnflag") == "A", one).alias("flatrate"),
        F.when(F.col("l_returnflag") == "N", one).alias("rent"),
        F.when(F.col("l_returnflag") == "R", one).alias("buy"),
    )
    results = F.struct(
        F.when(F.col("l_linestatus") == "F", lists).alias("US"), F.when(F.col("l_linestatus") != "F", lists).alias("CA")
    )
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("tmdb_id"), F.to_json(F.struct(results.alias("results"))).alias("payload")
    )


def corpus_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue entry per document source."""
    docs = load(spark, sf_dir, "documents").select("source", "n_chars", "lang")
    return docs.groupBy(_source_id()).agg(F.min("source").alias("title"), F.max("n_chars").alias("longest"), F.min("lang").alias("lang")).select(
        F.col("tmdb_id").alias("movie_id"),
        "title",
        F.when(F.col("longest") % 3 != 0, F.concat(F.lit("about "), "title")).alias("overview"),
        F.when(F.col("longest") % 2 == 0, F.col("lang")).alias("tagline"),
    )


CORPUS_MOVIES = f"""corpus_movies AS (
  SELECT movie_id, title, CASE WHEN longest % 3 <> 0 THEN 'about ' || title END AS overview,
         CASE WHEN longest % 2 = 0 THEN lang END AS tagline
  FROM (SELECT {SOURCE_ID} AS movie_id, min(source) AS title, max(n_chars) AS longest, min(lang) AS lang
        FROM documents GROUP BY 1))"""

CHILDREN = """kw_list AS (
  SELECT movie_id, string_agg(keyword, ', ' ORDER BY keyword_id) AS kws FROM (
    SELECT * FROM keywords_t QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY keyword_id, keyword) <= 15) GROUP BY movie_id),
cast_list AS (
  SELECT movie_id, string_agg(name, ', ' ORDER BY credit_order, person_id) AS names FROM (
    SELECT * FROM cast_t WHERE credit_order IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY credit_order, person_id) <= 15) GROUP BY movie_id),
review_list AS (
  SELECT movie_id, string_agg(snip, ' ' ORDER BY created_at, review_id) AS snips FROM (
    SELECT movie_id, created_at, review_id, substr(content, 1, 600) AS snip FROM reviews_t WHERE length(content) > 0
    QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY created_at, review_id) <= 5) GROUP BY movie_id),
composite AS (
  SELECT movie_id, title, overview,
         concat_ws(' | ', overview, coalesce(tagline, ''), coalesce(kws, ''), coalesce(names, ''), coalesce(snips, '')) AS text
  FROM corpus_movies LEFT JOIN kw_list USING (movie_id) LEFT JOIN cast_list USING (movie_id) LEFT JOIN review_list USING (movie_id)
  WHERE overview IS NOT NULL OR length(title) > 0)"""

COMPOSITE_VIEWS = (CORPUS_MOVIES, KEYWORDS, CAST, REVIEWS, CHILDREN)

# Groups and their facts ----------------------------------------------------------------------------------------------


def movie_ref(spark: SparkSession, sf_dir: str, key: str) -> Column:
    """A catalogue id for a fact; a few point past the end of the catalogue."""
    n = load(spark, sf_dir, "part").select(F.count(F.lit(1)).alias("n")).scalar()
    return (F.col(key) % (n + 50)).alias("movie_id")


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("item_id"),
        F.col("o_custkey").alias("group_id"),
        movie_ref(spark, sf_dir, "o_orderkey"),
        F.when(F.col("o_orderstatus") == "F", F.lit("watched")).otherwise(F.lit("queued")).alias("status"),
        F.lit(1).alias("added_by"),
        F.col("o_orderdate").alias("added_at"),
    )


WATCHLIST = """watchlist AS (
  SELECT o_orderkey AS item_id, o_custkey AS group_id, o_orderkey % ((SELECT count(*) FROM part) + 50) AS movie_id,
         CASE WHEN o_orderstatus = 'F' THEN 'watched' ELSE 'queued' END AS status, 1 AS added_by, o_orderdate AS added_at
  FROM orders)"""


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rating_id"),
        F.col("o_custkey").alias("group_id"),
        movie_ref(spark, sf_dir, "o_orderkey"),
        F.lit(None).cast("int").alias("user_id"),
        F.greatest(F.lit(1), F.least(F.lit(10), F.floor(F.col("o_totalprice") / 50000))).cast("int").alias("score"),
        F.col("o_orderpriority").alias("comment"),
        F.col("o_orderdate").alias("rated_at"),
    )


RATINGS = """ratings AS (
  SELECT o_orderkey AS rating_id, o_custkey AS group_id, o_orderkey % ((SELECT count(*) FROM part) + 50) AS movie_id,
         CAST(greatest(1, least(10, floor(o_totalprice / 50000))) AS INTEGER) AS score, o_orderpriority AS comment,
         o_orderdate AS rated_at
  FROM orders)"""


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = load(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return bought.select(
        F.col("event_id").alias("rec_id"),
        F.col("user_id").alias("group_id"),
        movie_ref(spark, sf_dir, "event_id"),
        F.col("props").alias("reason"),
        F.col("ts").alias("recommended_at"),
    )


RECOMMENDATIONS = """recommendations AS (
  SELECT event_id AS rec_id, user_id AS group_id, event_id % ((SELECT count(*) FROM part) + 50) AS movie_id, props AS reason,
         ts AS recommended_at
  FROM events WHERE event_type = 'purchase')"""


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("group_id"), F.col("n_name").alias("name"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("group_id"), F.col("c_custkey").alias("user_id"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))


# Vectors -------------------------------------------------------------------------------------------------------------


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("movie_id"), F.col("embedding").alias("embedding_vector"), "label"
    )


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per label: the vector with the lowest id."""
    first = load(spark, sf_dir, "embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("query_vector"))
    return first.select(F.col("label").alias("query_id"), "query_vector")


LABEL_QUERIES = """queries AS (
  SELECT label AS query_id, arg_min(embedding, vec_id) AS query_vector FROM embeddings GROUP BY label)"""

HITS = """sims AS (
  SELECT query_id, vec_id AS movie_id,
         round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(query_vector AS DOUBLE[])), 6) AS similarity
  FROM embeddings CROSS JOIN queries),
hits AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, movie_id) AS rank FROM sims)"""
