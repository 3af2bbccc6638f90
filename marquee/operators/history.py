"""Group histories, memberships and metrics.

Histories are long tables, one row per fact: a group with a third of all facts stays many rows. The order (group, newest
first, id) is a range sort whose key includes the unique id, so such a group also spreads over many sort partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import row_json
from marquee.operators.numbering import number_rows

MEMBERS_PER_ROW = 1000


def _with_movies(facts: DataFrame, movies: DataFrame, group_id: int | None, *attributes) -> DataFrame:
    wanted = facts if group_id is None else facts.filter(F.col("group_id") == group_id)
    return wanted.join(movies.select("movie_id", "title", *attributes), "movie_id", "left")


def _newest_first(df: DataFrame, at: str, row_id: str, ordered: bool) -> DataFrame:
    return df.orderBy("group_id", F.col(at).desc_nulls_last(), F.col(row_id).desc()) if ordered else df


def watchlist(items: DataFrame, movies: DataFrame, group_id: int | None = None, ordered: bool = True) -> DataFrame:
    rows = _with_movies(items, movies, group_id, F.col("vote_average").alias("tmdb_score"), "runtime", "genres").select(
        "group_id", "item_id", "movie_id", "title", "status", "added_at", "tmdb_score", "runtime", "genres"
    )
    return _newest_first(rows, "added_at", "item_id", ordered)


def ratings(rated: DataFrame, movies: DataFrame, group_id: int | None = None, ordered: bool = True) -> DataFrame:
    rows = _with_movies(rated, movies, group_id).select(
        "group_id", "rating_id", "movie_id", "title", "score", "comment", "rated_at"
    )
    return _newest_first(rows, "rated_at", "rating_id", ordered)


def recommendations(recs: DataFrame, movies: DataFrame, group_id: int | None = None, ordered: bool = True) -> DataFrame:
    rows = _with_movies(recs, movies, group_id).select(
        "group_id", "rec_id", "movie_id", "title", "reason", "recommended_at"
    )
    return _newest_first(rows, "recommended_at", "rec_id", ordered)


def group_history(
    items: DataFrame, rated: DataFrame, recs: DataFrame, movies: DataFrame, group_id: int | None = None
) -> DataFrame:
    """(group_id, kind, at, fact_id, record): all three histories, each record one JSON object.

    The rows of one group, read in order, are the three lists of its history document.
    """

    own = ["status", "score", "comment", "reason"]

    def part(df: DataFrame, kind: str, at: str, row_id: str) -> DataFrame:
        wanted = df if group_id is None else df.filter(F.col("group_id") == group_id)
        rest = [F.col(c) if c in df.columns else F.lit(None).cast("int" if c == "score" else "string").alias(c) for c in own]
        return wanted.select(
            "group_id", F.lit(kind).alias("kind"), F.col(at).alias("at"), F.col(row_id).alias("fact_id"), "movie_id", *rest
        )

    # The facts come together first, so that the catalogue is joined once.
    facts = part(items, "watchlist", "added_at", "item_id")
    facts = facts.unionByName(part(rated, "rating", "rated_at", "rating_id"))
    facts = facts.unionByName(part(recs, "recommendation", "recommended_at", "rec_id"))
    titled = facts.join(movies.select("movie_id", "title", F.col("vote_average").alias("tmdb_score"), "runtime", "genres"), "movie_id", "left")
    at = F.col("at").alias
    record = (
        F.when(F.col("kind") == "watchlist", row_json("movie_id", "title", "status", at("added_at"), "tmdb_score", "runtime", "genres"))
        .when(F.col("kind") == "rating", row_json("movie_id", "title", "score", "comment", at("rated_at")))
        .otherwise(row_json("movie_id", "title", "reason", at("recommended_at")))
    )
    both = titled.select("group_id", "kind", "at", "fact_id", record.alias("record"))
    return both.orderBy("group_id", "kind", F.col("at").desc_nulls_last(), F.col("fact_id").desc())


def groups_with_members(
    groups: DataFrame, members: DataFrame, users: DataFrame, per_row: int = MEMBERS_PER_ROW
) -> DataFrame:
    """(group_id, name, part, members): member names of each group in user order.

    A list holds at most ``per_row`` names; a larger group continues in rows with ``part`` 1, 2, …, so no list and no task
    grows with a group. A group without members has one empty list.
    """
    named = members.join(users.select("user_id", F.col("name").alias("member")), "user_id", "left")
    placed = number_rows(named.filter(F.col("member").isNotNull()), "user_id", ["group_id"], out="_pos")
    paged = placed.withColumn("part", F.floor(F.col("_pos") / per_row).cast("int"))
    lists = paged.groupBy("group_id", "part").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "member"))), lambda m: m["member"]).alias("members")
    )
    return (
        groups.select("group_id", "name")
        .join(lists, "group_id", "left")
        .select(
            "group_id",
            "name",
            F.coalesce("part", F.lit(0)).alias("part"),
            F.coalesce("members", F.array().cast("array<string>")).alias("members"),
        )
        .orderBy("group_id", "part")
    )


def group_metrics(groups: DataFrame, items: DataFrame, rated: DataFrame) -> DataFrame:
    """Queued and watched counts and the mean score per group; a group without ratings has no mean."""
    listed = items.groupBy("group_id").agg(
        F.count_if(F.col("status") == "queued").alias("queued"), F.count_if(F.col("status") == "watched").alias("watched")
    )
    scored = rated.groupBy("group_id").agg(F.round(F.avg("score"), 1).alias("avg_score"))

    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).alias(c)

    return (
        groups.select("group_id")
        .join(listed, "group_id", "left")
        .join(scored, "group_id", "left")
        .select("group_id", zero("queued"), zero("watched"), "avg_score")
    )


#: Sums that ``group_metrics`` follows from, one row per group; parts of disjoint sets of rows add up to the parts of all.
PARTS = ["queued", "watched", "score_sum", "scores"]


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("group_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in PARTS])


def metric_parts(items: DataFrame, rated: DataFrame) -> DataFrame:
    """(group_id, queued, watched, score_sum, scores) of watchlist rows and ratings, or of change feeds of them.

    With a ``change`` column an ``insert`` or ``update_postimage`` counts for its row and a ``delete`` or ``update_preimage`` against it; a row
    that moves to another group changes both. Scores are whole numbers, so sums stay exact however often rows come and go.
    """

    def sign(df: DataFrame) -> Column:
        if "change" not in df.columns:
            return F.lit(1)
        return F.when(F.col("change").isin("insert", "update_postimage"), 1).otherwise(-1)

    none = F.lit(0).cast("long")
    counted = items.select("group_id", *[F.when(F.col("status") == s, sign(items)).otherwise(0).cast("long").alias(s) for s in PARTS[:2]])
    scored = rated.filter(F.col("score").isNotNull()).select(
        "group_id", (F.col("score") * sign(rated)).cast("long").alias("score_sum"), sign(rated).cast("long").alias("scores")
    )
    both = counted.withColumns({"score_sum": none, "scores": none}).unionByName(scored.withColumns({"queued": none, "watched": none}))
    return _added(both)


def merge_metric_parts(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """The stored parts with those of a change feed added; groups that nothing is left of go."""
    both = _added(stored.select("group_id", *PARTS).unionByName(changes.select("group_id", *PARTS)))
    return both.filter(F.greatest(*[F.abs(c) for c in PARTS]) > 0)


def metrics_from_parts(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """What ``group_metrics`` gives, without the rows behind the parts."""
    mean = F.when(F.col("scores") > 0, F.round(F.col("score_sum") / F.col("scores"), 1)).alias("avg_score")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in PARTS[:2]]
    return groups.select("group_id").join(parts, "group_id", "left").select("group_id", *counts, mean)
