import pytest
from pyspark.sql import functions as F

from marquee.operators import merge
from marquee.operators.dedup import dedup_latest, top_n_per_group
from marquee.operators.numbering import allocate_ids, number_rows
from marquee.sources import tables


def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def test_merge_overwrites_with_null_keeps_the_rest_and_inserts(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id bigint, v string, other string")
    source = spark.createDataFrame([(1, None), (3, "c")], "id bigint, v string")
    once = merge.merge_upsert(target, source, ["id"])
    assert rows(once, "id", F.coalesce("v", F.lit("-")), F.coalesce("other", F.lit("-"))) == [(1, "-", "x"), (2, "b", "y"), (3, "c", "-")]
    assert rows(merge.merge_upsert(once, source, ["id"]).na.fill("-")) == rows(once.na.fill("-"))


def test_merge_refuses_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "id bigint, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "id bigint, v string")
    with pytest.raises(Exception, match="duplicate keys"):
        merge.merge_upsert(target, source, ["id"]).collect()


def test_merge_updates_every_copy_of_a_hot_target_key(spark):
    target = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"), F.lit("old").alias("v"))
    source = spark.createDataFrame([(7, "new")], "k bigint, v string")
    merged = merge.merge_upsert(target, source, ["k"])
    assert merged.filter("v = 'new'").count() == 1000 and merged.count() == 3000


def test_bucketed_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    target = spark.range(200).select(F.col("id"), F.lit("old").alias("v"))
    merge.write_buckets(target, path, ["id"], 8)
    before = {f.name: {p.name for p in f.iterdir()} for f in (tmp_path / "t").iterdir() if f.is_dir()}
    source = spark.createDataFrame([(5, "new"), (500, "new")], "id bigint, v string")
    touched = merge.merge_into_buckets(spark, path, source, ["id"], 8)
    after = {f.name: {p.name for p in f.iterdir()} for f in (tmp_path / "t").iterdir() if f.is_dir()}
    assert {b for b in after if after[b] != before[b]} == {f"bucket={b}" for b in touched}
    got = spark.read.parquet(path)
    assert got.count() == 201 and rows(got.filter("v = 'new'"), "id") == [(5,), (500,)]
    merge.merge_into_buckets(spark, path, source, ["id"], 8)
    assert spark.read.parquet(path).count() == 201


RATINGS = "rating_id bigint, group_id int, movie_id bigint, user_id int, score int, comment string, rated_at timestamp"


def test_rating_upsert(spark):
    old = spark.createDataFrame([(4, 1, 10, 2, 5, "ok", None)], RATINGS)
    asked = spark.createDataFrame(
        [(1, 1, 10, 3, "a"), (2, 1, 10, 15, "b"), (3, 2, 10, -3, None), (4, 1, 11, 6, "c")],
        "request_id bigint, group_id int, movie_id bigint, score int, comment string",
    )
    got = rows(merge.upsert_ratings(old, asked, now()), "rating_id", "group_id", "movie_id", F.coalesce("user_id", F.lit(-1)), "score", "comment")
    assert got == [(4, 1, 10, 2, 10, "b"), (5, 2, 10, -1, 1, ""), (6, 1, 11, -1, 6, "c")]


ITEMS = "item_id bigint, group_id int, movie_id bigint, status string, added_by int, added_at timestamp"


def test_watchlist_append_keeps_repeats_unless_told(spark):
    old = spark.createDataFrame([(9, 1, 10, "queued", 1, None)], ITEMS)
    asked = spark.createDataFrame(
        [(1, 1, 10, "foo"), (2, 1, 11, "watched"), (3, 1, 11, None)], "request_id bigint, group_id int, movie_id bigint, status string"
    )
    assert rows(merge.append_watchlist(old, asked, now()), "item_id", "movie_id", "status") == [
        (10, 10, "queued"),
        (11, 11, "watched"),
        (12, 11, "queued"),
    ]
    assert rows(merge.append_watchlist(old, asked, now(), skip_existing=True), "item_id", "movie_id") == [(10, 11)]


def test_ids_start_at_one_in_an_empty_table(spark):
    empty = spark.createDataFrame([], "n bigint")
    assert rows(allocate_ids(spark.range(3), empty, "n", "id")) == [(0, 1), (1, 2), (2, 3)]
    assert rows(allocate_ids(spark.range(0), empty, "n", "id")) == []


@pytest.mark.parametrize("partitions", [1, 7])
def test_positions_with_a_hot_group_heavy_values_and_nulls(spark, partitions):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.when(F.col("id") % 2 == 0, 42).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 97).alias("v"),
        "id",
    )
    got = number_rows(df.repartition(partitions), "v", ["g"], ["id"], ranges=16)
    want: dict = {}
    for r in sorted(df.collect(), key=lambda r: (str(r["g"]), r["v"] is not None, r["v"] or 0, r["id"])):
        want.setdefault(r["g"], []).append(r["id"])
    for r in got.collect():
        assert want[r["g"]][r["pos"]] == r["id"]


def test_heavy_value_is_cut_by_the_tie_column(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") < 3000, 5).otherwise(F.col("id")).alias("v"))
    got = number_rows(df, "v", tie_cols=["id"], ranges=8)
    assert rows(got.filter("pos <> id")) == []
    plan = got._jdf.queryExecution().toString()
    assert "_sub" in plan and "_tie" in plan


def test_top_n_of_a_hot_group_is_cut_before_the_exchange(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    top = top_n_per_group(df, ["k"], [F.col("id").desc()], 2)
    assert rows(top.filter("k = 0"), "id") == [(2994,), (2997,)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert dedup_latest(df, ["k"], ["id"]).count() == 2000 + 1


def test_change_feed_applied_to_the_old_snapshot_gives_the_new(spark):
    schema = "id bigint, v string"
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (5, None)], schema)
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None), (5, None)], schema)
    feed = tables.change_feed(old, new, ["id"])
    assert sorted((r["change"], r["id"], r["v"] or "") for r in feed.collect()) == [
        ("delete", 3, "c"),
        ("insert", 4, ""),
        ("update_postimage", 2, "b"),
        ("update_preimage", 2, ""),
    ]


def test_tables_append_replace_and_log(spark, tmp_path):
    ns = tables.Namespace("t_tables", str(tmp_path))
    ns.create(spark)
    ns.create(spark)
    users = spark.createDataFrame([(1, "a"), (2, "b")], "user_id int, name string")
    assert tables.append(users, ns, "users") == 2
    assert tables.append(users.limit(0), ns, "users") == 0
    # The replacement reads the table it replaces.
    assert tables.replace(ns.scan(spark, "users").filter("user_id = 2"), ns, "users") == 1
    assert rows(ns.scan(spark, "users"), "user_id", "name") == [(2, "b")]
    with pytest.raises(ZeroDivisionError):
        tables.logged_step(ns, spark, "bad", lambda: 1 // 0)
    assert tables.logged_step(ns, spark, "good", lambda: 3) == 3
    assert rows(ns.scan(spark, "pipeline_log"), "step", "rows", "status") == [("bad", 0, "failure"), ("good", 3, "success")]


def test_seed_only_when_empty(spark):
    empty = spark.createDataFrame([], "id bigint, likes array<string>")
    assert rows(tables.seed_if_empty(empty, [(1, ["x"])]), "id") == [(1,)]
    full = spark.createDataFrame([(5, [])], empty.schema)
    assert rows(tables.seed_if_empty(full, [(1, ["x"])]), "id") == [(5,)]
