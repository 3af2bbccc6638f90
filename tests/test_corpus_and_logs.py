import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import chatlog, corpus, embed, history
from marquee.streaming.landing import dedup_within_window, land_stream, read_stream, thin

MOVIES = "movie_id bigint, title string, overview string, tagline string"


def children(spark, keywords=(), cast=(), reviews=()):
    return (
        spark.createDataFrame(list(keywords), "movie_id bigint, keyword_id bigint, keyword string"),
        spark.createDataFrame(list(cast), "person_id bigint, movie_id bigint, name string, character string, credit_order int"),
        spark.createDataFrame(list(reviews), "review_id string, movie_id bigint, content string, created_at string"),
    )


def texts(spark, movies, **kw):
    df = corpus.composite_text(spark.createDataFrame(movies, MOVIES), *children(spark, **kw))
    return {r["movie_id"]: r["text"] for r in df.collect()}


def test_empty_parts_keep_their_separators(spark):
    got = texts(spark, [(1, "t", "o", None), (2, "t", None, "tag"), (3, "", None, "x"), (4, None, "", None)])
    assert got == {1: "o |  |  |  | ", 2: "tag |  |  | ", 4: " |  |  |  | "}


def test_children_are_ordered_and_cut(spark):
    got = texts(
        spark,
        [(1, "t", "o", "tag")],
        keywords=[(1, i, f"k{i}") for i in range(20, 0, -1)],
        cast=[(i, 1, f"p{i}", "c", 20 - i) for i in range(20)] + [(99, 1, "unbilled", "c", None)],
        reviews=[(f"r{i}", 1, str(i) * 700, f"2024-01-{i:02d}") for i in range(9, 0, -1)] + [("e", 1, "", "2023")],
    )[1]
    words = ", ".join(f"k{i}" for i in range(1, 16))
    people = ", ".join(f"p{i}" for i in range(19, 4, -1))
    snips = " ".join(str(i) * 600 for i in range(1, 6))
    assert got == f"o | tag | {words} | {people} | {snips}"


def test_embedding_is_one_vector_per_row_in_order(spark):
    calls = []

    def count_words(batch):
        calls.append(len(batch))
        return np.array([[len(t.split()), 1.0] for t in batch])

    df = spark.createDataFrame([(i, "w " * i) for i in range(1, 40)] + [(0, None)], "id bigint, text string")
    got = {r["id"]: r["embedding_vector"] for r in embed.embed_documents(df, "text", count_words).collect()}
    assert got == {i: [float(i), 1.0] for i in range(40)}


def test_embedding_retries_and_checks_the_count():
    tries = []

    def flaky(batch):
        tries.append(1)
        if len(tries) < 2:
            raise OSError("slow")
        return np.ones((len(batch), 2))

    assert embed._with_retries(flaky, ["a", "b"], 4).shape == (2, 2) and len(tries) == 2
    with pytest.raises(ValueError, match="expected 2 vectors"):
        embed._with_retries(lambda b: np.ones((1, 2)), ["a", "b"], 1)
    calls = []
    with pytest.raises(ValueError, match="expected 2 vectors"):
        embed._with_retries(lambda b: calls.append(1) or np.ones((1, 2)), ["a", "b"], 4)
    assert len(calls) == 1


def test_hashed_tokens():
    f = embed.hashed_tokens(32)
    v = f(["a b c", "C  b\na", "", "a b d"])
    assert np.array_equal(v[0], v[1]) and not v[2].any()
    assert np.isclose(np.linalg.norm(v[0]), 1) and v[0] @ v[3] < 1


def test_hashed_tokens_hold_the_words_of_few_texts_at_once(monkeypatch):
    texts = ["a b c d", "", "e f", "g" * 40, "h i j k l", "", "m"] * 20
    whole, held, factorize = embed.hashed_tokens(16)(texts), [], embed.pd.factorize
    monkeypatch.setattr(embed, "HASHED_CHARS", 30, raising=False)
    monkeypatch.setattr(embed.pd, "factorize", lambda words: held.append(len(words)) or factorize(words))
    assert np.array_equal(embed.hashed_tokens(16)(texts), whole)
    assert max(held) < 40 and sum(held) == 260
    assert embed.hashed_tokens(16)([]).shape == (0, 16)


def test_embedding_calls_of_a_task_are_made_one_by_one(spark):
    df = spark.createDataFrame([(i, f"t{i}" if i % 3 else None) for i in range(25)], "id int, text string").coalesce(1)
    got = embed.embed_documents(df, "text", lambda texts: np.full((len(texts), 2), len(texts)), batch=10).collect()
    assert [(r["id"], r["embedding_vector"][0]) for r in got] == [(i, 10.0 if i < 20 else 5.0) for i in range(25)]


def test_incremental_embedding_is_idempotent_and_refreshes(spark):
    f = embed.hashed_tokens(8)
    schema = "movie_id bigint, title string, overview string, text string"
    docs = spark.createDataFrame([(1, "t", "o", "one"), (2, "t", "o", "two")], schema)
    empty = spark.createDataFrame(
        [],
        "movie_id bigint, title string, overview string, embedding_vector array<float>, embedding_model string, "
        "embedded_at timestamp, text_hash string",
    )
    now = F.lit("2024-01-01").cast("timestamp")
    table = embed.refresh_embeddings(docs, empty, f, "m", now)
    assert table.count() == 2
    assert embed.incremental_embed(docs, table, f, "m").count() == 0
    assert embed.incremental_embed(docs, table, f, "other").count() == 2
    edited = spark.createDataFrame([(1, "t", "o", "one more"), (3, "t", "o", "three")], schema)
    assert {r["movie_id"] for r in embed.incremental_embed(edited, table, f, "m").collect()} == {1, 3}
    assert {r["movie_id"] for r in corpus.need_embedding(edited, table).collect()} == {3}


def test_context_counts_system_turns(spark):
    turns = [(1, i, r, f"m{i}") for i, r in enumerate(["user", "assistant", "user", "system", "assistant", "user", "assistant"])]
    turns += [(2, 0, "system", "s"), (3, 0, "user", None)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: [m["content"] for m in r["messages"]] for r in chatlog.chat_context(df).collect()}
    assert got == {1: ["m1", "m2", "m4", "m5", "m6"], 2: [], 3: [""]}


def test_tool_calls(spark):
    def call(name, arguments):
        return {"id": "c", "function": {"name": name, "arguments": arguments}}

    first = {"message": {"content": None, "tool_calls": [call("compare_movies", '{"title_a": "x"}'), call("nope", "{bad")]}}
    second = {"message": {"content": "ignored", "tool_calls": [call("compare_movies", "{}")]}}
    logs = [(1, json.dumps({"choices": [first, second]})), (2, json.dumps({"choices": []})), (3, "broken")]
    rows = chatlog.tool_calls(spark.createDataFrame(logs, "k int, response string"), ["k"]).collect()
    got = sorted((r["k"], r["tool"] or "", str(r["arguments"]), r["known"]) for r in rows)
    assert got == [
        (1, "compare_movies", "{'title_a': 'x'}", True),
        (1, "nope", "{}", False),
        (2, "", "{}", None),
        (3, "", "{}", None),
    ]


def test_members_of_a_large_group_continue_in_further_rows(spark):
    groups = spark.createDataFrame([(1, "big"), (2, "none"), (3, "one")], "group_id int, name string")
    users = spark.range(25).select(F.col("id").cast("int").alias("user_id"), F.concat(F.lit("u"), "id").alias("name"))
    members = users.select(F.when(F.col("user_id") == 24, 3).otherwise(1).alias("group_id"), "user_id").withColumn("role", F.lit("m"))
    got = [(r["group_id"], r["part"], r["members"]) for r in history.groups_with_members(groups, members, users, per_row=10).collect()]
    names = [f"u{i}" for i in range(24)]
    assert got == [(1, 0, names[:10]), (1, 1, names[10:20]), (1, 2, names[20:]), (2, 0, []), (3, 0, ["u24"])]


def test_history_keeps_facts_without_a_movie(spark):
    movies = spark.createDataFrame(
        [(1, "t", 5.0, 90, ["x"])], "movie_id bigint, title string, vote_average double, runtime int, genres array<string>"
    )
    items = spark.createDataFrame(
        [(1, 7, 1, "queued", 1, None), (2, 7, 2, "watched", 1, None)],
        "item_id bigint, group_id int, movie_id bigint, status string, added_by int, added_at timestamp",
    )
    rated = spark.createDataFrame([], "rating_id bigint, group_id int, movie_id bigint, score int, comment string, rated_at timestamp")
    recs = spark.createDataFrame([], "rec_id bigint, group_id int, movie_id bigint, reason string, recommended_at timestamp")
    got = [(r["title"], r["genres"]) for r in history.watchlist(items, movies, 7).collect()]
    assert got == [(None, None), ("t", ["x"])]
    assert history.watchlist(items, movies, 8).count() == 0
    records = [json.loads(r["record"]) for r in history.group_history(items, rated, recs, movies, 7).collect()]
    assert [r["title"] for r in records] == [None, "t"] and records[0]["added_at"] is None
    metrics = history.group_metrics(spark.createDataFrame([(7,), (8,)], "group_id int"), items, rated).collect()
    assert sorted(tuple(r) for r in metrics) == [(7, 1, 1, None), (8, 0, 0, None)]


def test_metric_parts_follow_inserts_updates_and_deletes(spark):
    """Three days of random changes; what is stored is only ever added to."""
    import random

    from marquee.sources.tables import change_feed

    random.seed(3)
    groups = spark.createDataFrame([(g,) for g in range(6)], "group_id int")
    item_schema, rate_schema = "item_id bigint, group_id int, status string", "rating_id bigint, group_id int, score int"

    def day():
        states, scores = ["queued", "watched", "dropped", None], [1, 4, 7, 10, None]
        items = [(i, random.choice([0, 1, 2, None]), random.choice(states)) for i in range(30) if random.random() < 0.7]
        rated = [(i, random.choice([0, 1, 3]), random.choice(scores)) for i in range(30) if random.random() < 0.7]
        return spark.createDataFrame(items, item_schema), spark.createDataFrame(rated, rate_schema)

    days = [day() for _ in range(3)]
    days.append((days[0][0].limit(0), days[0][1].limit(0)))
    stored = history.metric_parts(*days[0])
    for before, after in zip(days, days[1:]):
        feeds = change_feed(before[0], after[0], ["item_id"]), change_feed(before[1], after[1], ["rating_id"])
        rows = history.merge_metric_parts(stored, history.metric_parts(*feeds)).collect()
        stored = spark.createDataFrame(rows, stored.schema)
        assert sorted(map(str, rows)) == sorted(map(str, history.merge_metric_parts(history.metric_parts(*after), stored.limit(0)).collect()))
        got, want = history.metrics_from_parts(groups, stored), history.group_metrics(groups, *after)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert rows == []
    # A change of nothing changes nothing.
    nothing = change_feed(days[0][0], days[0][0], ["item_id"]), change_feed(days[0][1], days[0][1], ["rating_id"])
    assert history.metric_parts(*nothing).count() == 0


def test_stream_lands_once_per_window_over_many_batches(spark, tmp_path):
    schema = "id bigint, v string, fetched_at timestamp"
    source, target, state = (str(tmp_path / p) for p in ("in", "out", "state"))

    def arrive(*rows):
        df = spark.createDataFrame(list(rows), "id bigint, v string, at string").selectExpr("id", "v", "cast(at as timestamp) fetched_at")
        df.coalesce(1).write.mode("append").parquet(source)

    def run():
        land_stream(read_stream(spark, source, schema, files_per_batch=1), ["id"], target, state).awaitTermination()
        return sorted((r["id"], r["v"]) for r in spark.read.parquet(target).collect())

    arrive((1, "a", "2024-01-01 00:00:00"), (1, "b", "2024-01-01 01:00:00"), (2, "a", "2024-01-01 00:00:00"))
    assert run() == [(1, "a"), (2, "a")]
    # Within the window of the first landing: skipped. After it: landed again. A late document of a new id is not lost.
    arrive((1, "c", "2024-01-01 23:00:00"), (2, "d", "2024-01-02 00:00:01"), (3, "late", "2023-01-01 00:00:00"))
    assert run() == [(1, "a"), (2, "a"), (2, "d"), (3, "late")]
    assert run() == [(1, "a"), (2, "a"), (2, "d"), (3, "late")]


@pytest.mark.parametrize("files", [1, 2, None])
def test_nothing_that_is_far_apart_is_lost_whatever_the_batches(spark, tmp_path, files):
    schema = "id bigint, fetched_at timestamp"
    source, target, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    for i, day in ((1, "01-01"), (1, "01-04"), (2, "01-06"), (2, "01-02")):
        row = spark.createDataFrame([(i, f"2024-{day}")], "id bigint, at string").selectExpr("id", "cast(at as timestamp) fetched_at")
        row.coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):
        land_stream(read_stream(spark, source, schema, files_per_batch=files), ["id"], target, state).awaitTermination()
        assert spark.read.parquet(target).count() == 4


def test_a_hot_key_is_walked_in_order(spark):
    hours = [0, 1, 23, 24, 25, 26, 49, 50, 51, 74, 76]
    docs = spark.createDataFrame([(7, h) for h in hours] * 2 + [(None, 3), (None, 4)], "id bigint, h int")
    docs = docs.select("id", F.timestamp_seconds(F.col("h") * 3600).alias("fetched_at"), "h").repartition(5)
    got = sorted((r["id"] or 0, r["h"]) for r in thin(docs, ["id"], 24).collect())
    assert got == [(0, 3), (7, 0), (7, 25), (7, 50), (7, 76)]


def test_in_stream_dedup_keeps_one_per_key_within_the_window(spark, tmp_path):
    source, target, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    events = spark.range(100).select(
        (F.col("id") % 40).alias("id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("fetched_at")
    )
    events.repartition(3).write.parquet(source)
    stream = dedup_within_window(read_stream(spark, source, events.schema, files_per_batch=1), ["id"])
    query = stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(target)
    query.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(40))
