"""Composite texts and embeddings over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import corpus, embed, silver
from marquee.operators.dedup import top_n_per_group
from marquee.plans import views as V
from marquee.plans.registry import query, with_views


def _texts(spark, sf):
    return corpus.composite_text(
        V.corpus_movies(spark, sf),
        silver.keywords(V.raw_keywords(spark, sf)),
        silver.cast(V.raw_credits(spark, sf)),
        silver.reviews(V.raw_reviews(spark, sf)),
    )


@query(
    "children_lists",
    with_views(
        """SELECT movie_id, coalesce(kws, '') AS kws, coalesce(names, '') AS names, md5(coalesce(snips, '')) AS snips_md5
           FROM corpus_movies LEFT JOIN kw_list USING (movie_id) LEFT JOIN cast_list USING (movie_id) LEFT JOIN review_list USING (movie_id)""",
        *V.COMPOSITE_VIEWS,
    ),
)
def children_lists(spark, sf):
    joined = (
        V.corpus_movies(spark, sf)
        .join(corpus.keyword_lists(silver.keywords(V.raw_keywords(spark, sf))), "movie_id", "left")
        .join(corpus.cast_lists(silver.cast(V.raw_credits(spark, sf))), "movie_id", "left")
        .join(corpus.review_lists(silver.reviews(V.raw_reviews(spark, sf))), "movie_id", "left")
    )
    return joined.select(
        "movie_id",
        F.coalesce(F.array_join("kw_list", ", "), F.lit("")).alias("kws"),
        F.coalesce(F.array_join("cast_list", ", "), F.lit("")).alias("names"),
        F.md5(F.coalesce(F.array_join("review_list", " "), F.lit(""))).alias("snips_md5"),
    )


@query(
    "topn_per_group",
    """SELECT source, doc_id, n_chars, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank
       FROM documents QUALIFY rank <= 5""",
)
def topn_per_group(spark, sf):
    docs = V.load(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return top_n_per_group(docs, ["source"], [F.col("n_chars").desc(), F.col("doc_id")], 5, rank="rank")


@query("composite_text", with_views("SELECT movie_id, title, text FROM composite", *V.COMPOSITE_VIEWS))
def composite_text(spark, sf):
    return _texts(spark, sf).select("movie_id", "title", "text")


@query("embed_input", "SELECT doc_id, md5(substr(text, 1, 5000)) AS text_md5, length(substr(text, 1, 5000)) AS n FROM documents")
def embed_input(spark, sf):
    docs = corpus.embed_input(V.load(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n"))


@query("need_embedding", "SELECT doc_id AS movie_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def need_embedding(spark, sf):
    docs = V.load(spark, sf, "documents").select(F.col("doc_id").alias("movie_id"), "n_chars")
    done = V.load(spark, sf, "labels").select(F.col("doc_id").alias("movie_id"))
    return corpus.need_embedding(docs, done)


_DIM = 64
_EMBEDDED = f"""tokens AS (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[ \\t\\r\\n]+'), lambda w: w <> '')) AS token FROM documents),
places AS (
  SELECT doc_id, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % {_DIM} AS place,
         CASE WHEN substr(md5(token), 9, 1) < '8' THEN 1 ELSE -1 END AS sign FROM tokens),
sums AS (SELECT doc_id, place, CAST(sum(sign) AS DOUBLE) AS s FROM places GROUP BY 1, 2),
lengths AS (SELECT doc_id, sqrt(sum(s * s)) AS len FROM sums GROUP BY 1),
digits AS (
  SELECT d.doc_id, p.place, CAST(floor(CAST(CAST(coalesce(s / nullif(len, 0), 0) AS FLOAT) AS DOUBLE) * 1000 + 0.5) AS BIGINT) AS v
  FROM documents d CROSS JOIN range({_DIM}) p(place)
  LEFT JOIN sums ON sums.doc_id = d.doc_id AND sums.place = p.place LEFT JOIN lengths ON lengths.doc_id = d.doc_id)
SELECT doc_id, string_agg(v, ',' ORDER BY place) AS digits FROM digits GROUP BY doc_id"""


@query("embed_documents", f"WITH {_EMBEDDED}")
def embed_documents(spark, sf):
    docs = V.load(spark, sf, "documents").select("doc_id", "text")
    vectors = embed.embed_documents(docs, "text", embed.hashed_tokens(_DIM), batch=1024)
    digits = F.transform("embedding_vector", lambda x: F.floor(x.cast("double") * 1000 + 0.5).cast("string"))
    return vectors.select("doc_id", F.array_join(digits, ",").alias("digits"))


_INCREMENT = """SELECT doc_id AS movie_id, CASE WHEN doc_id NOT IN (SELECT doc_id FROM labels) THEN 'new'
    WHEN lang = 'en' THEN 'text changed' WHEN source = 'src1' THEN 'other model' ELSE 'no vector' END AS reason
  FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR lang = 'en' OR source = 'src1' OR source = 'src2'"""


def embedding_table(spark, sf):
    """Stored vectors of the labelled documents: English texts have changed since, two sources hold unusable vectors."""
    docs = V.load(spark, sf, "documents").join(V.load(spark, sf, "labels").select("doc_id").distinct(), "doc_id")
    old_text = F.when(F.col("lang") == "en", F.lit("older")).otherwise(F.col("text"))
    return docs.select(
        F.col("doc_id").alias("movie_id"),
        F.col("source").alias("title"),
        F.col("lang").alias("overview"),
        F.when(F.col("source") != "src2", F.array(F.lit(1.0).cast("float"))).alias("embedding_vector"),
        F.when(F.col("source") == "src1", F.lit("older")).otherwise(F.lit("hashed")).alias("embedding_model"),
        F.sha2(old_text, 256).alias("text_hash"),
        F.lit(None).cast("timestamp_ntz").alias("embedded_at"),
    )


def document_texts(spark, sf):
    return V.load(spark, sf, "documents").select(
        F.col("doc_id").alias("movie_id"), F.col("source").alias("title"), F.col("lang").alias("overview"), "text"
    )


@query("incremental_embed", _INCREMENT)
def incremental_embed(spark, sf):
    new = embed.incremental_embed(
        document_texts(spark, sf), embedding_table(spark, sf), embed.hashed_tokens(_DIM), "hashed", batch=1024
    )
    known = V.load(spark, sf, "labels").select(F.col("doc_id").alias("movie_id"), F.lit(1).alias("known")).distinct()
    reason = (
        F.when(F.col("known").isNull(), "new")
        .when(F.col("overview") == "en", "text changed")
        .when(F.col("title") == "src1", "other model")
        .otherwise("no vector")
    )
    checked = new.filter(F.size("embedding_vector") == _DIM)
    return checked.join(known, "movie_id", "left").select("movie_id", reason.alias("reason"))


@query(
    "refresh_embeddings",
    f"""SELECT doc_id AS movie_id, source AS title, CASE WHEN reason IS NULL THEN 'kept' ELSE 'new' END AS stamped,
        CASE WHEN reason IS NULL THEN 1 ELSE {_DIM} END AS dim
        FROM documents LEFT JOIN ({_INCREMENT}) i ON doc_id = movie_id""",
)
def refresh_embeddings(spark, sf):
    table = embed.refresh_embeddings(
        document_texts(spark, sf), embedding_table(spark, sf), embed.hashed_tokens(_DIM), "hashed", V.as_of(), batch=1024
    )
    stamped = F.when(F.col("embedded_at") == V.as_of(), F.lit("new")).otherwise(F.lit("kept"))
    return table.select("movie_id", "title", stamped.alias("stamped"), F.size("embedding_vector").alias("dim"))
