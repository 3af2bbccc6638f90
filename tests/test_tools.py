import pytest
from pyspark.sql import functions as F

from marquee import constants, jobs, tools
from marquee.operators.embed import hashed_tokens
from marquee.sources import tables
from marquee.sources.tables import Namespace


def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def cat(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("catalogue")
    ns = Namespace("t_tools", str(root / "tables"))
    jobs.set_up(spark, ns)

    def docs(*payloads):
        return spark.createDataFrame([(p, "file") for p in payloads], "payload string, source_url string")

    jobs.land(
        spark,
        ns,
        "raw_movies",
        docs(
            '{"id": 1, "title": "Heist", "overview": "a bank heist with a twist", "runtime": 100, "vote_count": 5, "genres": [{"id": 1, "name": "Crime"}]}',
            '{"id": 2, "title": "Laughs", "overview": "a feel good comedy", "runtime": 90, "vote_count": 9, "genres": [{"id": 2, "name": "Comedy"}]}',
            '{"title": "no id"}',
        ),
        now(),
    )
    jobs.land(spark, ns, "raw_keywords", docs('{"id": 1, "keywords": [{"id": 3, "name": "robbery"}]}'), now())
    jobs.transform(spark, ns, now())
    jobs.embed_new(spark, ns, hashed_tokens(64), "hashed", now())
    index = jobs.Index(str(root / "index"), 64)
    jobs.sync_index(spark, ns, index, cells=2)
    return tools.Catalogue(spark, ns, index.rows(spark), hashed_tokens(64))


def test_landing_again_within_the_window_is_skipped(spark, cat):
    doc = spark.createDataFrame([('{"id": 1}', "f"), ('{"id": 7}', "f")], "payload string, source_url string")
    table = cat.table("raw_movies").count()
    later = now() + F.expr("INTERVAL 1 HOUR")
    assert jobs.land(spark, cat.ns, "raw_movies", doc, later) == 1
    tables.replace(cat.table("raw_movies").filter("tmdb_id <> 7"), cat.ns, "raw_movies")
    assert cat.table("raw_movies").count() == table


def test_tool_names_are_the_fixed_ones():
    assert tuple(tools.TOOLS) == constants.TOOL_NAMES


def test_search_by_text(spark, cat):
    queries = spark.createDataFrame([(1, "bank robbery heist"), (2, "a feel good comedy")], "query_id int, query string")
    best = {r["query_id"]: r["title"] for r in tools.search_movies_semantic(cat, queries, limit=1).collect()}
    assert best == {1: "Heist", 2: "Laughs"}
    only = tools.search_movies_semantic(cat, queries, max_runtime=95, genre="comedy").collect()
    assert {r["title"] for r in only} == {"Laughs"}


def test_look_ups(spark, cat):
    assert [r["title"] for r in tools.fetch_trending_movies(cat).collect()] == ["Laughs", "Heist"]
    asks = spark.createDataFrame([("a", "HEI"), ("b", "nothing")], "request_id string, needle string")
    assert [r["title"] for r in tools.get_movie_details(cat, asks).collect()] == ["Heist"]
    compared = {r["request_id"]: r["runtime"] for r in tools.compare_movies(cat, asks).collect()}
    assert compared == {"a": 100, "b": None}


def test_writes_and_history(spark, cat):
    asks = spark.createDataFrame(
        [(1, 5, 1, "watched", 11, "why"), (2, 5, 2, "x", 4, "because")],
        "request_id bigint, group_id int, movie_id bigint, status string, score int, reason string",
    ).withColumn("comment", F.col("reason"))
    assert tools.add_to_watchlist(cat, asks, now()) == 2
    assert tools.log_group_rating(cat, asks, now()) == 2
    assert tools.log_group_rating(cat, asks.filter("movie_id = 2").withColumn("score", F.lit(7)), now()) == 2
    assert tools.log_recommendation(cat, asks, now()) == 2
    assert sorted(tuple(r) for r in cat.table("ratings").select("rating_id", "movie_id", "score").collect()) == [(1, 1, 10), (2, 2, 7)]
    kinds = [r["kind"] for r in tools.get_group_history(cat, 5).collect()]
    assert sorted(kinds) == ["rating"] * 2 + ["recommendation"] * 2 + ["watchlist"] * 2


def test_index_follows_the_embedding_table(spark, cat, tmp_path):
    index = jobs.Index(str(tmp_path / "index"), 64)
    assert jobs.sync_index(spark, cat.ns, index, cells=2) == 2
    assert jobs.sync_index(spark, cat.ns, index) == 0
    kept = cat.table("movie_embeddings").filter("movie_id = 2")
    tables.replace(kept, cat.ns, "movie_embeddings")
    assert jobs.sync_index(spark, cat.ns, index) == 1
    assert [r["movie_id"] for r in index.rows(spark).collect()] == [2]


def test_the_index_follows_the_attributes_and_a_filtered_search_moves_no_vector(spark, cat, tmp_path):
    tables.replace(cat.table("movies").withColumn("runtime", F.lit(50)), cat.ns, "movies")
    jobs.embed_new(spark, cat.ns, hashed_tokens(64), "hashed", now())
    index = jobs.Index(str(tmp_path / "index"), 64)
    jobs.sync_index(spark, cat.ns, index, cells=2)
    changed = F.when(F.col("movie_id") == 1, 300).otherwise(F.col("runtime"))
    tables.replace(cat.table("movies").withColumn("runtime", changed), cat.ns, "movies")
    assert jobs.sync_index(spark, cat.ns, index) == 1
    assert jobs.sync_index(spark, cat.ns, index) == 0
    assert {(r["movie_id"], r["runtime"]) for r in index.rows(spark).collect()} == {(1, 300), (2, 50)}
    over = tools.Catalogue(spark, cat.ns, index.rows(spark), hashed_tokens(64))
    queries = spark.createDataFrame([(1, "bank robbery heist")], "query_id int, query string")
    found = tools.search_movies_semantic(over, queries, max_runtime=100)
    assert [r["movie_id"] for r in found.collect()] == [2]
    scan = found._jdf.queryExecution().optimizedPlan().toString()
    scan = scan[scan.index("MapInArrow") :]
    assert "Join" not in scan.split("Relation")[0] and "embedding_vector" in scan
