"""What operators leave in the scratch folder and on the executors' disks: only what their result still reads."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from marquee import session
from marquee.llm.components import components
from marquee.llm.jaccard import jaccard_components
from marquee.llm.passages import remove_repeats
from marquee.session import passing, staged


@pytest.fixture
def written(monkeypatch):
    """Paths by label, as they are given out."""
    paths: list[tuple[str, str]] = []
    make = session.scratch_dir

    def noted(spark, label):
        path = make(spark, label)
        paths.append((label, path))
        return path

    monkeypatch.setattr(session, "scratch_dir", noted)
    return paths


def left(paths):
    return sorted(label for label, path in paths if os.path.exists(path))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getPath() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def text(rng, words):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(words))


def near(line, i):
    """The line with another word in its middle."""
    words = line.split()
    words[len(words) // 2] = f"changed{i}"
    return " ".join(words)


def test_passages_keep_what_the_result_reads(make, written):
    rng = random.Random(3)
    line, passage = text(rng, 70), text(rng, 60)
    rows = [(i, f"{text(rng, 80)}\n{near(line, i)}\n{text(rng, 70)} {passage} {text(rng, 60)}") for i in range(6)]
    out = remove_repeats(make(rows))
    assert {"repeated", "sets", "links", "members", "postings", "moves", "edges"} <= {label for label, _ in written}
    assert left(written) == ["lines", "names", "passages", "rids", "windows"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[0]["n_removed"] == 0 and all(got[i]["n_removed"] == 130 and got[i]["repeats_of"] == [0] for i in range(1, 6))


def test_passages_without_repeats(make, written):
    rng = random.Random(4)
    rows = [(i, text(rng, 80)) for i in range(5)]
    out = remove_repeats(make(rows))
    assert left(written) == ["lines", "passages", "rids", "windows"]
    assert {r["doc_id"]: r["text"] for r in out.collect()} == dict(rows)


def test_jaccard_keeps_what_the_result_reads(make, written):
    rng = random.Random(6)
    one = text(rng, 100)
    out = jaccard_components(make([one, near(one, 1), text(rng, 90), one]))
    assert left(written) == ["names", "sets"]
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {0: 0, 1: 0, 2: 2, 3: 0}


def test_no_links(spark, written):
    for kind, value in (("long", "1"), ("string", "'1'")):
        out = components(spark.sql(f"SELECT cast({value} AS {kind}) AS a, cast({value} AS {kind}) AS b"))
        assert left(written) == [] and out.dtypes == spark.sql(f"SELECT cast(1 AS {kind}) AS node, cast(1 AS {kind}) AS component").dtypes and out.count() == 0


def test_passing(spark, written):
    with passing() as keep_out:
        staged(spark.range(1), "a")
        with passing() as keep:
            kept, moved = keep(staged(spark.range(3), "b")), keep(staged(spark.range(4), "c"))
            staged(spark.range(1), "d")
        assert left(written) == ["a", "b", "c"]
        keep_out(kept)
        assert moved.count() == 4
    assert left(written) == ["b"] and kept.count() == 3
    with pytest.raises(ValueError), passing():
        staged(spark.range(1), "e")
        raise ValueError
    staged(spark.range(1), "f")
    assert left(written) == ["b", "f"]


def test_staged_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = staged(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count().repartition(3, "count"), "sums")
    until = time.time() + 20
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not new and table.count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
