"""The eight catalogue tools as DataFrame-in, DataFrame-out functions, each for a whole batch of requests.

``row_json`` renders any result as one JSON object per row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.operators import corpus, embed, history, merge, search
from marquee.operators.knn import knn
from marquee.session import staged
from marquee.sources import tables
from marquee.sources.tables import Namespace


@dataclass(frozen=True)
class Catalogue:
    """Tables, the vectors to search, the embedder that made them, and the top-k to search with."""

    spark: SparkSession
    ns: Namespace
    vectors: DataFrame
    embed_batch: embed.EmbedBatch
    find: Callable = knn

    def table(self, name: str) -> DataFrame:
        return self.ns.scan(self.spark, name)


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def search_movies_semantic(
    cat: Catalogue,
    queries: DataFrame,
    max_runtime: int = 0,
    genre: str = "",
    limit: int = K.SEARCH_LIMIT,
    mode: str = "prefilter",
    chars: int | None = None,
) -> DataFrame:
    """Best ``limit`` titles per (query_id, query). Texts are embedded once; ``chars`` must be what the index was embedded with."""
    asked = queries.select("query_id", "query")
    asked = asked if chars is None else corpus.embed_input(asked, "query", chars)
    vectors = staged(embed.embed_documents(asked, "query", cat.embed_batch, out="query_vector"), "queries")
    return search.semantic_search(cat.vectors, cat.table("movies"), vectors, max_runtime, genre, limit, mode, cat.find)


def fetch_trending_movies(cat: Catalogue, limit: int = K.TRENDING_LIMIT) -> DataFrame:
    return search.trending(cat.table("movies"), limit)


def get_movie_details(cat: Catalogue, requests: DataFrame) -> DataFrame:
    """Up to five matches per (request_id, needle)."""
    return search.movie_details(cat.table("movies"), requests).select(
        "request_id", "rank", "movie_id", "title", "original_title", "overview", "vote_average", "runtime", "genres",
        "release_date", "status",
    )


def compare_movies(cat: Catalogue, requests: DataFrame) -> DataFrame:
    """The best match per (request_id, needle), an empty record where there is none; two requests make a comparison."""
    return search.compare_movies(cat.table("movies"), requests).select(
        "request_id", "title", "original_title", "vote_average", "runtime", "genres", "overview", "release_date", "year"
    )


def add_to_watchlist(cat: Catalogue, requests: DataFrame, as_of: Column | None = None) -> int:
    """Append (request_id, group_id, movie_id, status); returns the rows written."""
    rows = merge.append_watchlist(cat.table("watchlist_items"), requests, _now(as_of))
    return tables.append(rows, cat.ns, "watchlist_items")


def log_group_rating(cat: Catalogue, requests: DataFrame, as_of: Column | None = None) -> int:
    """Upsert (request_id, group_id, movie_id, score, comment); returns the rows of the table after it.

    Only the buckets of the rated (group, movie) pairs are written.
    """
    ready, how = merge.rating_merge(cat.table("ratings"), requests, _now(as_of))
    tables.merge_into(ready, cat.ns, "ratings", **how)
    return cat.ns.keyed("ratings").manifest(cat.spark).rows


def log_recommendation(cat: Catalogue, requests: DataFrame, as_of: Column | None = None) -> int:
    """Append (request_id, group_id, movie_id, reason); returns the rows written."""
    rows = merge.append_recommendations(cat.table("recommendations"), requests, _now(as_of))
    return tables.append(rows, cat.ns, "recommendations")


def get_group_history(cat: Catalogue, group_id: int | None = None) -> DataFrame:
    """Watchlist, ratings and recommendations of one group or of all, newest first, one JSON record per row."""
    parts = [cat.table(t) for t in ("watchlist_items", "ratings", "recommendations", "movies")]
    return history.group_history(*parts, group_id=group_id)


TOOLS = {
    f.__name__: f
    for f in (
        search_movies_semantic,
        fetch_trending_movies,
        get_movie_details,
        compare_movies,
        add_to_watchlist,
        log_group_rating,
        log_recommendation,
        get_group_history,
    )
}
