"""Declared schemas: the twenty tables and the JSON payloads, as Spark DDL strings.

Numbers that sources send both as ``8`` and ``8.0`` are parsed as double and narrowed afterwards, because an integer field
in ``from_json`` turns ``8.0`` into NULL.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

_LANDED = "source_url string, fetched_at timestamp, payload string"

BRONZE = {
    "raw_movies": f"tmdb_id bigint, {_LANDED}",
    "raw_credits": f"tmdb_id bigint, {_LANDED}",
    "raw_keywords": f"tmdb_id bigint, {_LANDED}",
    "raw_reviews": f"tmdb_id bigint, review_id string, {_LANDED}",
    "raw_providers": f"tmdb_id bigint, {_LANDED}",
    "raw_genres": f"genre_id int, {_LANDED}",
}

SILVER = {
    "movies": (
        "movie_id bigint, title string, original_title string, overview string, tagline string, runtime int, "
        "vote_average double, vote_count bigint, release_date date, year int, poster_path string, "
        "backdrop_path string, genres array<string>, language string, status string, updated_at timestamp"
    ),
    "cast": "person_id bigint, movie_id bigint, name string, character string, credit_order int",
    "keywords": "movie_id bigint, keyword_id bigint, keyword string",
    "reviews": (
        "review_id string, movie_id bigint, author string, rating double, content string, created_at string, url string"
    ),
    "providers": "movie_id bigint, country string, provider_name string, provider_type string",
    "genres": "genre_id int, name string",
}

VECTOR = {
    "movie_embeddings": (
        "movie_id bigint, title string, overview string, embedding_vector array<float>, embedding_model string, "
        "embedded_at timestamp, text_hash string"
    ),
}

APP = {
    "users": "user_id int, name string, preferences array<string>",
    "groups": "group_id int, name string, created_at timestamp",
    "group_members": "group_id int, user_id int, role string",
    "ratings": (
        "rating_id bigint, group_id int, movie_id bigint, user_id int, score int, comment string, rated_at timestamp"
    ),
    "watchlist_items": (
        "item_id bigint, group_id int, movie_id bigint, status string, added_by int, added_at timestamp"
    ),
    "recommendations": (
        "rec_id bigint, group_id int, movie_id bigint, reason string, recommended_by string, recommended_at timestamp"
    ),
    "pipeline_log": "run_id string, step string, rows bigint, status string, ts timestamp",
}

# Tables that are merged into, and the keys of the merge.
KEYED = {"movies": ("movie_id",), "movie_embeddings": ("movie_id",), "ratings": ("group_id", "movie_id")}

TABLES = {**BRONZE, **SILVER, **VECTOR, **APP}

MOVIE_PAYLOAD = (
    "id bigint, title string, original_title string, overview string, tagline string, runtime double, "
    "vote_average double, vote_count double, release_date string, poster_path string, backdrop_path string, "
    "original_language string, status string, genres array<struct<id:int,name:string>>"
)
GENRE_PAYLOAD = "id int, name string"
CREDITS_PAYLOAD = "cast array<struct<id:bigint,name:string,character:string,order:int>>"
KEYWORDS_PAYLOAD = "keywords array<struct<id:bigint,name:string>>"
REVIEW_FIELDS = "id:string,author:string,content:string,created_at:string,url:string,author_details:struct<rating:double>"
# One schema for both landed shapes: a page of reviews, and a single review at top level.
REVIEWS_PAYLOAD = (
    "id string, author string, content string, created_at string, url string, author_details struct<rating:double>, "
    f"results array<struct<{REVIEW_FIELDS}>>"
)
# How payloads become tables: the payload's schema, the array of records in it (None: the payload is one record), the key, and
# the columns whose source has another name or shape than the column itself.
FLATTENING = {
    "movies": (
        MOVIE_PAYLOAD,
        None,
        ("movie_id",),
        {
            "movie_id": "id",
            "year": "year(try_cast(release_date AS date))",
            "genres": "coalesce(genres.name, CAST(array() AS array<string>))",
            "language": "original_language",
        },
    ),
    "genres": (GENRE_PAYLOAD, None, ("genre_id",), {"genre_id": "id"}),
    "cast": (CREDITS_PAYLOAD, "cast", ("person_id", "movie_id"), {"person_id": "id", "movie_id": "tmdb_id", "credit_order": "order"}),
    "keywords": (KEYWORDS_PAYLOAD, "keywords", ("movie_id", "keyword_id"), {"movie_id": "tmdb_id", "keyword_id": "id", "keyword": "name"}),
    "reviews": (
        REVIEWS_PAYLOAD,
        # A page of results, or the single review that the payload itself is.
        """coalesce(results, CASE WHEN author IS NOT NULL OR content IS NOT NULL
           THEN array(struct(id, author, content, created_at, url, author_details)) END)""",
        ("review_id",),
        {"review_id": "id", "movie_id": "tmdb_id", "rating": "author_details.rating"},
    ),
}
_OFFERS = ",".join(f"{kind}:array<struct<provider_name:string>>" for kind in ("flatrate", "rent", "buy"))
LIST_PAGE_PAYLOAD = "page int, total_pages int, results array<struct<id:bigint>>"
RESPONSE_PAYLOAD = (
    "choices array<struct<message:struct<content:string,tool_calls:array<struct<id:string,"
    "function:struct<name:string,arguments:string>>>>>>"
)


def providers_payload(countries) -> str:
    """Schema of the watch-provider payload: only the named countries, or every country when ``countries`` is None."""
    if countries is None:
        return f"results map<string,struct<{_OFFERS}>>"
    return f"results struct<{','.join(f'`{c}`:struct<{_OFFERS}>' for c in countries)}>"


def struct_type(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])
