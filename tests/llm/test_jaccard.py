"""Jaccard join against brute force, and components."""

import random
from collections import Counter, defaultdict

import pytest

from marquee.llm.components import components
from marquee.llm.jaccard import jaccard_components


def brute(rows, k=4, percent=85):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset())
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, s in enumerate(sets):
        for j, common in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    smallest = {}
    for i in range(len(rows)):
        smallest[find(i)] = min(smallest.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows)))


def ours(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(df).collect())


def test_planted_families(make):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 30, 60, 200]))]
        for _ in range(rng.choice([1, 2, 12, 40])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(" ".join(w))
    rows = [(i * 3, t) for i, t in enumerate(rows)]
    assert ours(make(rows)) == brute(rows)


def test_real_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert ours(df) == brute(rows)


def test_edges(make):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (5, "one two"), (6, long), (7, long + " end"), (8, "a b c d"), (9, None), (10, "one")]
    got = {(d, n): c for d, n, c in ours(make(rows))}
    assert got == {(1, 0): 1, (2, 0): 2, (3, 0): 3, (4, 1): 4, (5, 1): 4, (6, 29997): 6, (7, 29998): 6, (8, 1): 8, (9, 0): 9, (10, 1): 10}
    assert len(ours(make(rows))) == len(rows)


def test_sets_whose_first_row_has_no_id(spark):
    words = [f"v{i}" for i in range(60)]
    near = lambda i: " ".join(words[:i] + ["other"] + words[i + 1 :])
    rows = [(None, " ".join(words)), (5, " ".join(words)), (8, near(0)), (9, near(59))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_components(df).collect()} == {None: 5, 5: 5, 8: 5, 9: 5}


def test_empty_table(make):
    assert ours(make([]).where("doc_id < 0")) == []


@pytest.mark.parametrize("n", [1, 2, 40])
def test_components_of_chains_and_stars(spark, n):
    edges = [(f"c{i}", f"c{i + 1}") for i in range(n)] + [("s0", f"s{i}") for i in range(1, n + 1)] + [("x", "x"), (None, "y")]
    got = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a string, b string")).collect():
        got[r["component"]].add(r["node"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, [{f"c{i}" for i in range(n + 1)}, {f"s{i}" for i in range(n + 1)}]))
