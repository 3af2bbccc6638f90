"""Look-ups and searches over the catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions.columns import genres_text, has_genre, like_pattern, runtime_within, snippet, summary_snippet, title_like
from marquee.operators import trigrams
from marquee.operators.dedup import top_n_per_group
from marquee.operators.knn import CURSOR_MARGIN, SKIPPED, QueryBlock, knn, one_block
from marquee.session import staged

# Title requests sent to every task at once.
BLOCK_REQUESTS = 10_000
# Hits broadcast at most: some 30 MB of (query, id, similarity).
BROADCAST_HITS = 1_000_000


def _best_first(*cols: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols] + [F.col("movie_id").asc()]


def trending(movies: DataFrame, limit: int = K.TRENDING_LIMIT) -> DataFrame:
    voted = movies.filter(F.col("vote_count").isNotNull())
    return voted.select("movie_id", "title", "vote_average", "vote_count", "year").orderBy(
        *_best_first("vote_count", "vote_average")
    ).limit(limit)


def browse_titles(movies: DataFrame, needle: str | None = None, limit: int = K.BROWSE_LIMIT) -> DataFrame:
    shown = movies
    if needle:
        shown = movies.filter(title_like(F.lit(needle), F.col("title"), F.col("original_title")))
    return shown.orderBy(*_best_first("vote_average", "vote_count")).limit(limit)


def lookup_in_order(movies: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``movies`` for ``ids`` (movie_id, pos), in the order of ``pos``."""
    return movies.join(ids, "movie_id").orderBy("pos", "movie_id")


def _request_blocks(requests: DataFrame) -> list[DataFrame]:
    """``requests`` in parts of at most ``BLOCK_REQUESTS`` rows."""
    n = requests.limit(BLOCK_REQUESTS + 1).count()
    if n <= BLOCK_REQUESTS:
        return [requests] if n else []
    total = requests.count()
    if requests.select("request_id").distinct().limit(2).count() < 2:
        raise ValueError(f"{total} requests have one request_id; ids must be unique")
    pieces = -(-total // BLOCK_REQUESTS) * 2
    cut = requests.withColumn("_piece", F.pmod(F.xxhash64("request_id", F.lit(pieces)), F.lit(pieces)))
    return [
        block
        for piece in range(pieces)
        for block in _request_blocks(cut.filter(F.col("_piece") == piece).drop("_piece"))
    ]


def title_matches(movies: DataFrame, requests: DataFrame, k: int) -> DataFrame:
    """Top ``k`` titles per request (request_id, needle) by score.

    A needle with three literal characters in a row meets the titles of its rarest trigrams by a join (``trigrams``). The others have no equality to join
    on: a block of them goes to every task, after a check of its size, and the catalogue is scanned where it lies; further blocks are further passes, and
    where there are none there is no such pass. The catalogue is never broadcast, however small its files are.
    """
    # Lower-cased once per title and once per request, not once per pair.
    lowered = movies.withColumn("_title", F.lower("title")).withColumn("_original", F.lower("original_title"))
    asked = requests.select("request_id", "needle").withColumn("_needle", F.lower("needle")).withColumn("_wild", F.rlike("needle", F.lit("[%_]")))
    has_trigram = F.rlike("_needle", F.lit("(?s)[^%_]{3}"))
    found = trigrams.postings(lowered, "movie_id", ["_title", "_original"])
    few = requests.limit(BLOCK_REQUESTS + 1).count() <= BLOCK_REQUESTS
    pairs = trigrams.candidates(asked.where(has_trigram), found, "movie_id", "_needle", few=few)
    pairs = pairs.join(trigrams.met_with(asked, few), ["request_id", "_needle"])
    hits = [lowered.hint("merge").join(pairs, "movie_id").where(_hit("_title") | _hit("_original"))]
    for block in _request_blocks(asked.where(~has_trigram)):
        hits.append(lowered.join(F.broadcast(block), _hit("_title") | _hit("_original")))
    matched = reduce(DataFrame.unionByName, hits).drop("_title", "_original", "_needle", "_wild")
    return top_n_per_group(matched, ["request_id"], _best_first("vote_average"), k, rank="rank")


def _hit(title: str) -> Column:
    """Whether the lower-cased ``title`` matches ``_needle``; without wildcards it is a plain substring."""
    wild = F.call_function("like", F.col(title), like_pattern(F.col("_needle")))
    return F.coalesce(F.when(F.col("_wild"), wild).otherwise(F.contains(F.col(title), F.col("_needle"))), F.lit(False))


def movie_details(movies: DataFrame, requests: DataFrame, limit: int = K.DETAILS_LIMIT) -> DataFrame:
    return title_matches(movies, requests, limit)


def compare_movies(movies: DataFrame, requests: DataFrame) -> DataFrame:
    """The best match per request, an empty record where nothing matches; the overview is cut for display."""
    best = title_matches(movies, requests, 1).drop("needle", "rank").withColumn("overview", snippet(F.col("overview")))
    return requests.select("request_id", "needle").join(best, "request_id", "left")


def summarise(rows: DataFrame) -> DataFrame:
    return rows.withColumn("overview_snippet", summary_snippet(F.col("overview"))).drop("overview")


def enrich(hits: DataFrame, movies: DataFrame, few: bool = False) -> DataFrame:
    """Hits with catalogue attributes; a hit without a catalogue row stays, its attributes NULL.

    With ``few`` the hits are known to be few (``few_hits``): the catalogue is first reduced to them where it lies, which
    spares its shuffle. The plan names the hits twice and computes them once, by exchange reuse.
    """
    attributes = movies.select("movie_id", "vote_average", "runtime", "genres")
    if few:
        wanted = F.broadcast(hits.select("movie_id").distinct())
        attributes = F.broadcast(attributes.join(wanted, "movie_id", "left_semi"))
    return hits.join(attributes, "movie_id", "left")


def _keep(max_runtime: int, genre: str) -> Column:
    return runtime_within(F.col("runtime"), max_runtime) & has_genre(F.col("genres"), genre)


def _candidate_count(limit: int, filtered: bool) -> int:
    return (K.FILTERED_CANDIDATES if filtered else limit) * K.OVERFETCH


def few_hits(block: QueryBlock | None, k: int) -> bool:
    """Whether queries times ``k`` proves the hits few enough to broadcast."""
    return block is not None and len(block.ids) * k <= BROADCAST_HITS


def _small(hits: DataFrame, block: QueryBlock | None, k: int) -> DataFrame:
    """Mark few hits for broadcast, so that the catalogue is not shuffled to meet them."""
    return F.broadcast(hits) if few_hits(block, k) else hits


def semantic_search(
    index: DataFrame,
    movies: DataFrame,
    queries: DataFrame,
    max_runtime: int = 0,
    genre: str = "",
    limit: int = K.SEARCH_LIMIT,
    mode: str = "prefilter",
    find=knn,
) -> DataFrame:
    """The ``limit`` most similar catalogue rows per query, with optional runtime and genre filters.

    ``prefilter`` filters the catalogue first and always fills ``limit`` when enough rows match. An index with columns ``runtime``
    and ``genres`` (``with_attributes``) is filtered where it is scanned; another one is joined to the catalogue rows that match.
    ``postfilter`` filters a fixed number of nearest candidates, so it can return fewer rows than match. ``find`` is the
    vector top-k to use.
    """
    attributes = movies.select("movie_id", "title", "vote_average", "runtime", "year", "genres", "overview")
    block = one_block(queries)
    queries = block or queries
    if mode == "prefilter":
        allowed = attributes.filter(_keep(max_runtime, genre))
        if {"runtime", "genres"} <= set(index.columns):
            searched = index.filter(_keep(max_runtime, genre))
        else:
            searched = index.join(allowed.select("movie_id"), "movie_id", "left_semi")
        hits = find(searched, queries, limit)
        ranked = allowed.join(_small(hits, block, limit), "movie_id")
    elif mode == "postfilter":
        n = _candidate_count(limit, bool(max_runtime or genre))
        hits = find(index, queries, n).drop("rank")
        kept = attributes.filter(_keep(max_runtime, genre)).join(_small(hits, block, n), "movie_id")
        order = [F.col("similarity").desc(), F.col("movie_id").asc()]
        ranked = top_n_per_group(kept, ["query_id"], order, limit, rank="rank")
    else:
        raise ValueError("mode must be 'postfilter' or 'prefilter'")
    return summarise(ranked)


def with_attributes(vectors: DataFrame, movies: DataFrame) -> DataFrame:
    """``vectors`` of catalogue rows with the attributes that searches filter by, to build an index from."""
    return vectors.drop("runtime", "genres").join(movies.select("movie_id", "runtime", "genres"), "movie_id")


def browse_semantic(index: DataFrame, movies: DataFrame, queries: DataFrame, limit: int = K.BROWSE_SEMANTIC_LIMIT, find=knn) -> DataFrame:
    block = one_block(queries)
    hits = enrich(find(index, block or queries, limit), movies, few_hits(block, limit))
    return hits.withColumn("genres_text", genres_text(F.col("genres"))).drop("genres")


def exclude_seen(candidates: DataFrame, watchlist: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Candidates (group_id, movie_id, …) the group has not watched, queued or been recommended."""
    return candidates.join(_seen(watchlist, recommendations), ["group_id", "movie_id"], "left_anti")


def _seen(watchlist: DataFrame, recommendations: DataFrame) -> DataFrame:
    keys = ["group_id", "movie_id"]
    return watchlist.select(*keys).union(recommendations.select(*keys)).distinct()


def recommend_for_groups(
    group_queries: DataFrame,
    index: DataFrame,
    movies: DataFrame,
    queries: DataFrame,
    watchlist: DataFrame,
    recommendations: DataFrame,
    candidates: int,
    picks: int,
    find=knn,
) -> DataFrame:
    """(group_id, movie_id, similarity, rank): the best unseen titles for every group.

    ``group_queries`` (group_id, query_id) says which of the shared ``queries`` speaks for a group, so one vector pass
    serves all groups. A first pass looks at ``candidates`` rows per query. Groups that are still short of ``picks`` get further passes
    over the queries that speak for them, for four times as many rows each, until they have enough or the index is exhausted. A
    further pass goes on where the last one ended (``_resumed``) and keeps what the group has been given already.
    """
    order = [F.col("similarity").desc(), F.col("movie_id").asc()]
    titles = movies.select("movie_id", "title")
    group_queries = staged(group_queries.select("group_id", "query_id"), "groups")
    queries = staged(queries.select("query_id", "query_vector"), "queries")
    done: list[DataFrame] = []
    found: DataFrame | None = None
    given: DataFrame | None = None
    asked, n = queries, candidates
    while True:
        block = one_block(asked)
        hits = staged(find(index, block or asked, n).drop("rank"), "hits")
        # What lies within the margin of a cursor and was too much to be named comes again.
        fresh = hits if found is None else hits.join(found, ["query_id", "movie_id"], "left_anti")
        offered = group_queries.join(titles.join(_small(fresh, block, n), "movie_id"), "query_id")
        best = exclude_seen(offered, watchlist, recommendations)
        best = best if given is None else best.unionByName(given)
        best = staged(top_n_per_group(best, ["group_id"], order, picks, rank="rank"), "picked")
        # A query with fewer hits than asked for has met every row that it can.
        open_queries = hits.groupBy("query_id").agg(F.count("*").alias("c")).filter(F.col("c") >= n).select("query_id")
        full = best.groupBy("group_id").agg(F.count("*").alias("c")).filter(F.col("c") >= picks).select("group_id")
        short = staged(group_queries.join(full, "group_id", "left_anti").join(open_queries, "query_id", "left_semi"), "groups")
        if short.isEmpty():
            done.append(best)
            return reduce(DataFrame.unionByName, done)
        groups = short.select("group_id").distinct()
        done.append(best.join(groups, "group_id", "left_anti"))
        given = best.join(groups, "group_id", "left_semi").drop("rank")
        found = hits if found is None else found.unionByName(hits)
        asked = staged(_resumed(queries, short, found, _seen(watchlist, recommendations)), "queries")
        group_queries, n = short, n * 4


def _resumed(queries: DataFrame, groups: DataFrame, found: DataFrame, seen: DataFrame) -> DataFrame:
    """The queries of ``groups`` as they go on behind what they ``found``.

    A query names the rows found within the margin of its cursor, then rows that all of its groups have seen, up to
    ``SKIPPED``. Naming them only spares the scan: what else comes again is taken out where the groups meet it.
    """
    cursor = found.groupBy("query_id").agg(F.min("similarity").alias("after"))
    close = found.join(cursor, "query_id").filter(F.col("similarity") <= F.col("after") + 2 * CURSOR_MARGIN)
    speaks_for = groups.groupBy("query_id").agg(F.count_distinct("group_id").alias("n_groups"))
    seen_by = groups.distinct().join(seen, "group_id").groupBy("query_id", "movie_id").agg(F.count("*").alias("n_seen"))
    by_all = seen_by.join(speaks_for, "query_id").filter(F.col("n_seen") == F.col("n_groups"))
    named = close.select("query_id", "movie_id", F.lit(0).alias("kind")).unionByName(by_all.select("query_id", "movie_id", F.lit(1).alias("kind")))
    some = top_n_per_group(named, ["query_id"], [F.col("kind"), F.col("movie_id")], SKIPPED)
    skip = some.groupBy("query_id").agg(F.collect_set("movie_id").alias("skip"))
    return queries.join(speaks_for, "query_id", "left_semi").join(cursor, "query_id").join(skip, "query_id")
