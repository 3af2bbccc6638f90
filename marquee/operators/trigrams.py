"""Trigram postings of titles: substring and LIKE requests as an equality join.

A needle's literal runs of three characters and more give its trigrams, and every title that matches holds all of them. The needle meets the titles of its
rarest trigrams alone; the match itself is verified on what is left. Needles without three literal characters in a row have no trigram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trigrams of a needle that are looked up.
RAREST = 2


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of ``text``."""
    last = F.length(text) - 2
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(3))))


def literal_trigrams(needle: Column) -> Column:
    """The trigrams between the wildcards of a LIKE needle."""
    runs = F.split(needle, "[%_]")
    return F.array_distinct(F.flatten(F.transform(runs, trigrams)))


def postings(titles: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """tri, ``key``: the trigrams of any of the ``columns`` of each row."""
    all_of = F.array_distinct(F.flatten(F.array(*[F.coalesce(trigrams(F.col(c)), F.array().cast("array<string>")) for c in columns])))
    return titles.select(F.explode(all_of).alias("tri"), key)


def met_with(requests: DataFrame, few: bool) -> DataFrame:
    """``requests`` for a join with the catalogue: broadcast when they are ``few``, else both sides are shuffled."""
    return F.broadcast(requests) if few else requests.hint("merge")


def candidates(
    requests: DataFrame, found: DataFrame, key: str, needle: str = "needle", request: str = "request_id", few: bool = False
) -> DataFrame:
    """request, needle, ``key``: the rows of ``found`` (``postings``) that hold the rarest trigrams of each request's ``needle``; only of needles that have any.

    The frequency of a trigram is counted for the trigrams of the requests alone; one that no title has ends its request. With
    ``few`` the requests are known to be few and go to the postings; otherwise both are shuffled. The postings never go to the
    driver: of exploded rows Spark knows only the size of the file they come from.
    """
    asked = requests.select(request, needle, F.explode(literal_trigrams(F.col(needle))).alias("tri"))
    wanted = asked.select("tri").distinct()
    counts = found.join(met_with(wanted, few), "tri", "left_semi").groupBy("tri").agg(F.count(F.lit(1)).alias("n"))
    counts = counts if few else counts.hint("merge")
    ranked = asked.join(counts, "tri", "left").groupBy(request, needle).agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "tri"))).alias("all"))
    rarest = ranked.select(request, needle, F.explode(F.slice("all", 1, RAREST)).alias("one"), F.least(F.size("all"), F.lit(RAREST)).alias("of"))
    met = met_with(rarest.select(request, needle, "of", F.col("one.tri").alias("tri")), few).join(found, "tri")
    return met.groupBy(request, needle, key).agg(F.count(F.lit(1)).alias("n"), F.min("of").alias("of")).where("n = of").select(request, needle, key)
