"""Source targets against iterated sharing, and what a mix may take."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm.mixing import fit, mix


def brute_targets(sizes, weights=(1, 2, 3)):
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    w = {n: weights[i % 3] for i, n in enumerate(names)}
    target, rest = dict.fromkeys(names, 0.0), float(sum(sizes.values()))
    open_ = set(names)
    while rest > 1e-9 and open_:
        share, total = rest, sum(w[n] for n in open_)
        rest = 0.0
        for n in sorted(open_, key=str):
            target[n] += share * w[n] / total
            if target[n] > 3 * sizes[n]:
                rest += target[n] - 3 * sizes[n]
                target[n] = 3.0 * sizes[n]
        open_ = {n for n in open_ if target[n] < 3 * sizes[n]}
    return target


@pytest.mark.parametrize("sf", ["sf0.001", "hand"])
def test_targets_and_budget(spark, sf):
    if sf == "hand":
        rows = [(i, s, t) for i, (s, t) in enumerate([("a", "x " * 900), ("b", "y"), ("c", "z z"), (None, "q q q"), ("d", None), ("e", ""), ("b", "y"), ("é", "w " * 50)] + [("a", "k " * (i + 1)) for i in range(40)])]
        rows += [(0, "a", "x " * 900)]
        df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    else:
        df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        rows = [(r["doc_id"], r["source"], r["text"]) for r in df.collect()]
    size = [len(re.findall("[^\x20\x09-\x0d]+", t or "")) for _, _, t in rows]
    by = {}
    for (_, s, _), n in zip(rows, size, strict=True):
        by[s] = by.get(s, 0) + n
    want = brute_targets(by)
    got = mix(df).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((d, n) for (d, _, _), n in zip(rows, size, strict=True))
    taken = {}
    for r in got:
        assert r["source_size"] == by[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in taken.items():
        assert t <= want[s] + 1e-6 and want[s] - t < max(1, *(n for (_, x, _), n in zip(rows, size, strict=True) if x == s))
    assert sorted(map(str, mix(df).collect())) == sorted(map(str, got))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 4)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(0, 200))
def test_knapsack_is_best_when_small(pieces, budget):
    sizes, counts = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    take = fit(sizes, counts, budget)
    assert (take >= 0).all() and (take <= counts).all() and (take * sizes).sum() <= budget
    sums = {0}
    for s, c in pieces:
        sums = {x + s * i for x in sums for i in range(c + 1)}
    best = max(x for x in sums if x <= budget)
    assert best - (take * sizes).sum() <= max(sizes)


def test_empty(spark):
    assert mix(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
