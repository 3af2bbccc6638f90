import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.llm import trie


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        own_saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        found = [below(c) for c in children[p]]
        return (sum(f[0] for f in found) or 1, own_saved + sum(f[1] for f in found))

    out = []
    for p, ms in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ms if len(built[c]) == len(p)))
        leaves, saved = below(p)
        out.append((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for name in ("k", "node", "id", "next", "slot", "pos", "n", "bytes"):
        df = df.withColumn(name, F.lit("x"))
    return df


def made(seed, convs=60):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(convs), -7, -10, 10**15, 10**15 + 5]:
        for t in range(rnd.randrange(1, 9)):
            rows.append((c, rnd.choice([t, t, t, None]), rnd.choice(["user", "assistant", None]), rnd.choice(["", "a", "é", "long text", None])))
    rows += rows[:4] + [(None, 1, "user", "lost"), (31, None, None, None)]
    return [r for r in rows if r[0] not in (20, 25)]  # bases that are absent


@pytest.mark.parametrize(("seed", "few", "every"), [(1, 8, 2), (2, 40, 4), (3, trie.FEW, trie.EVERY)])
def test_against_brute_force(spark, seed, few, every):
    rows = made(seed)
    got = sorted((tuple(r) for r in trie.prefix_trie(frame(spark, rows), few, every).collect()), key=str)
    assert got == brute(rows)


def test_copies_turnless_and_one_turn(spark, monkeypatch):
    monkeypatch.setattr(trie, "SLOT", 4)
    monkeypatch.setattr(trie, "IDS", 3)
    # Without a base and with few turns nothing is left of many of these; all others are equal.
    rows = [(c, 1, "user", "same") for c in range(0, 200, 5)] + [(c, t, "user", str(t)) for c in (1003, 1004, 1011) for t in range(3)]
    rows += [(c, t, "user", f"{c}") for c in range(2000, 2100, 5) for t in range(2)]
    got = sorted((tuple(r) for r in trie.prefix_trie(frame(spark, rows), 10, 3).collect()), key=str)
    assert got == brute(rows)


def test_empty(spark):
    assert trie.prefix_trie(frame(spark, made(1)).limit(0)).count() == 0
    assert trie.prefix_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0


def test_list_ranking(spark):
    rnd = random.Random(4)
    order = rnd.sample(range(10_000), 3000)
    arcs = spark.createDataFrame(list(zip(order, [*order[1:], None], strict=True)), "id long, next long").repartition(5)
    got = {r["id"]: r["left"] for r in trie.ranked(arcs, few=50, every=5).collect()}
    assert got == {x: len(order) - 1 - i for i, x in enumerate(order)}
