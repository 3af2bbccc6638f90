"""Cell join, coded vectors and trigram postings against brute force, and their plans."""

import random

import numpy as np
import pytest

from marquee.operators import ann, knn, knn_join, pq, search, trigrams
from marquee.session import scratch_dir

DIM = 8


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def cells(spark):
    """An index with one crowded cell, with NULL and zero vectors left out, and its centroids."""
    rng = np.random.default_rng(3)
    near = rng.normal([5.0] + [0.0] * (DIM - 1), 0.3, (300, DIM))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([near, rng.normal(0, 1, (150, DIM))]))]
    rows += [(1000, None), (1001, [0.0] * DIM), (1002, rows[0][1])]
    vectors = spark.createDataFrame(rows, "movie_id long, embedding_vector array<float>").repartition(4)
    path = scratch_dir(spark, "cells")
    model = ann.build_index(vectors, path, DIM, cells=5)
    return vectors, spark.read.parquet(path), ann.centroids(model)


def queries(spark, n, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(f"q{i}", rng.normal([2.0] + [0.0] * (DIM - 1), 1, DIM).tolist()) for i in range(n)] + [("none", None), ("zero", [0.0] * DIM)]
    return spark.createDataFrame(rows, "query_id string, query_vector array<double>").repartition(3)


def hits(df):
    return sorted((r["query_id"], r["rank"], r["movie_id"], r["similarity"]) for r in df.collect())


def test_cell_join_over_all_cells_is_exact(spark, cells):
    vectors, index, centroids = cells
    asked = queries(spark, 40)
    joined = knn_join.knn_join(index, centroids, asked, 7, len(centroids), digits=5, group_rows=50, group_queries=6)
    assert hits(joined) == hits(knn.knn(vectors, asked, 7, digits=5))


def test_cell_join_equals_probed_scan(spark, cells):
    _, index, centroids = cells
    asked = queries(spark, 30, 5)
    joined = knn_join.knn_join(index, centroids, asked, 5, 2, digits=5, group_rows=1000)
    assert hits(joined) == hits(knn.knn_cells(index, centroids, asked, 5, 2, digits=5))


def test_a_cell_has_few_parts_until_a_group_is_full(spark):
    """Rows are sent once for each part of the queries: parts by a small group size alone would send them ever more often."""

    def parts(n, size, most):
        return spark.range(n).agg(knn_join._parts(size, most)).head()[0]

    assert [parts(n, 10, 100) for n in (1, 10, 11, 35, 400, 401, 1001)] == [1, 1, 2, 4, 4, 5, 11]
    assert [parts(n, 300, 100) for n in (100, 301, 3000)] == [1, 2, 10]


def test_the_length_of_a_vector_is_summed_once_for_all_its_numbers(spark):
    df = spark.createDataFrame([([3.0, 4.0],), (None,), ([],)], "v array<float>").select(ann.unit("v").alias("u"))
    assert [r["u"] and [round(x, 6) for x in r["u"]] for r in df.collect()] == [[0.6, 0.8], None, []]
    optimized = plan_of(df).split("Optimized Logical Plan")[1].split("Physical Plan")[0]
    assert "aggregate(" not in optimized.split("transform(v")[1]


def test_cell_join_moves_no_query_to_the_driver(spark, cells):
    _, index, centroids = cells
    joined = knn_join.knn_join(index, centroids, queries(spark, 10), 5, 2)
    for line in plan_of(joined).splitlines():
        if "BroadcastExchange" in line:
            assert "query_vector" not in line
    assert knn_join.knn_join(index, centroids, queries(spark, 10).limit(0), 5, 2).count() == 0


def test_codes_find_the_neighbours(spark, cells):
    vectors, _, _ = cells
    path = scratch_dir(spark, "pq")
    coder = pq.build_index(vectors, path, DIM, cells=5)
    index = spark.read.parquet(path)
    assert index.count() == 451
    asked = queries(spark, 40)
    # Over the stored vectors: those are of unit length as float, so the last digit may differ from the given ones.
    truth = knn.knn(index, asked, 10, digits=5)
    # All cells and all rows refined: exact.
    assert hits(pq.search(index, coder, asked, 10, 5, refine=60, digits=5)) == hits(truth)
    assert pq.search(index, coder, asked.limit(0), 10, 2).count() == 0


@pytest.mark.xfail(reason="calibrated on rows of the index; queries from elsewhere find 0.855, under the floor of 0.9")
def test_calibrated_probes_hold_for_other_queries(spark, cells):
    path = scratch_dir(spark, "pq")
    coder = pq.build_index(cells[0], path, DIM, cells=5)
    index, asked = spark.read.parquet(path), queries(spark, 40)
    truth = knn.knn(index, asked, 10, digits=5)
    probes = pq.calibrate(index, coder, 10)
    found = pq.search(index, coder, asked, 10, probes, digits=5)
    assert knn.recall(found, truth).agg({"recall": "avg"}).first()[0] >= 0.9


def test_codes_are_scanned_without_vectors(spark, cells):
    vectors, _, _ = cells
    path = scratch_dir(spark, "pq")
    coder = pq.build_index(vectors, path, DIM, cells=5)
    index = spark.read.parquet(path)
    block = knn.one_block(queries(spark, 5))
    read = [line.split("ReadSchema")[1] for line in plan_of(pq._survivors(index, coder, block, 20, 2, "movie_id")).splitlines() if "ReadSchema" in line]
    assert read and all("code" in r and "embedding_vector" not in r for r in read)


def brute(titles, requests, k):
    import re

    out = []
    for request, needle in requests:
        if needle is None:
            continue
        pattern = "".join({"%": "(?s:.*)", "_": "(?s:.)"}.get(c, re.escape(c)) for c in needle.lower())
        found = [t for t in titles if any(x is not None and re.search(pattern, x.lower()) for x in t[1:3])]
        found.sort(key=lambda t: (-t[3], t[0]))
        out += [(request, i + 1, t[0]) for i, t in enumerate(found[:k])]
    return sorted(out)


def test_titles_by_trigrams(spark):
    rnd = random.Random(6)
    words = ["red", "The", "sea", "Über", "a", "b_", "100%", "\\", "日本語", "reddish", "x"]
    titles = [(i, " ".join(rnd.choices(words, k=3)) if i % 11 else None, rnd.choice([None, rnd.choice(words)]), float(i % 7)) for i in range(200)]
    movies = spark.createDataFrame(titles, "movie_id long, title string, original_title string, vote_average double").repartition(3)
    needles = ["red", "the sea", "a", "", "re%sea", "r_d", "日本語", "no such", "%", "über", "dish x", None, "ed", "b_ r", "\\"]
    requests = [(f"r{i}", n) for i, n in enumerate(needles)]
    asked = spark.createDataFrame(requests, "request_id string, needle string")
    got = sorted((r["request_id"], r["rank"], r["movie_id"]) for r in search.title_matches(movies, asked, 6).collect())
    assert got == brute(titles, requests, 6)
    literal = asked.where("needle in ('red', 'the sea', 'no such')")
    assert "NestedLoop" not in plan_of(search.title_matches(movies, literal, 6))


def broadcast_scans(df):
    """The scans whose rows the physical plan broadcasts as they are, not reduced by an aggregate or a rank."""
    found, inside = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        body = line.lstrip(" :+-*")
        depth = len(line) - len(body)
        inside = None if inside is not None and depth <= inside else inside
        if inside is None and body.startswith("BroadcastExchange"):
            inside = depth
        if "Aggregate(" in body or body.startswith("Window"):
            inside = None
        if inside is not None and "FileScan" in body:
            found.append(body)
    return found


@pytest.mark.parametrize("block", [10_000, 1])
def test_the_catalogue_is_not_broadcast_to_title_requests(spark, monkeypatch, block):
    """A dictionary-coded file is far smaller than its rows, and its postings are more still."""
    path = scratch_dir(spark, "titles")
    rows = [(i, f"title {i % 3}", f"Brand#{i % 5}", float(i)) for i in range(50)]
    spark.createDataFrame(rows, "movie_id long, title string, original_title string, vote_average double").write.parquet(path)
    movies = spark.read.parquet(path)
    requests = [(f"r{i}", f"brand#{i}") for i in range(6)]
    asked = spark.createDataFrame(requests, "request_id string, needle string")
    monkeypatch.setattr(search, "BLOCK_REQUESTS", block)
    for df in (search.movie_details(movies, asked, 5), search.compare_movies(movies.withColumn("overview", movies.title), asked)):
        assert not broadcast_scans(df)
    got = sorted((r["request_id"], r["rank"], r["movie_id"]) for r in search.movie_details(movies, asked, 5).collect())
    assert got == brute(rows, requests, 5)


def test_trigrams_of_needles(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("abcd",), ("ab",), ("ab%bcd_e",), ("aaaa",), (None,)], "t string")
    got = [r[0] for r in df.select(trigrams.literal_trigrams(F.col("t"))).collect()]
    assert got == [["abc", "bcd"], [], ["bcd"], ["aaa"], None]
