"""Repeated passages: what is planted goes from all documents but one, clean documents stay as they are."""

import random

from marquee.llm.passages import remove_repeats


def sentences(rng, words):
    out, n = [], 0
    while n < words:
        s = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(rng.randint(5, 14))]
        s[0] = s[0].capitalize()
        out.append(" ".join(s) + ".")
        n += len(s)
    return " ".join(out)


def ours(df):
    return {r["doc_id"]: r for r in remove_repeats(df).collect()}


def test_planted_passage_stays_once(make):
    rng = random.Random(5)
    passage, small = sentences(rng, 60), sentences(rng, 20)
    bodies = [sentences(rng, 120) for _ in range(8)]
    # In a line of its own, in the middle of a sentence, and twice in one document.
    rows = [
        (3, bodies[0] + "\n" + passage + "\n" + bodies[1]),
        (5, bodies[2] + " lower " + passage + " lower " + bodies[3]),
        (9, passage + " " + bodies[6] + " " + passage),
        (11, bodies[4] + " " + small),
        (12, small + "\n" + bodies[5]),
    ]
    got = ours(make(rows))
    assert got[3]["text"] == rows[0][1] and got[3]["n_removed"] == 0
    assert got[5]["text"] == bodies[2] + " lower lower " + bodies[3] and got[5]["repeats_of"] == [3]
    assert got[9]["text"] == bodies[6]
    assert got[9]["n_removed"] == 2 * len(passage.split())
    for d, t in rows[3:]:
        assert got[d]["text"] == t and got[d]["n_removed"] == 0


def test_near_equal_line(make):
    rng = random.Random(8)
    line = [w.lower() for w in sentences(rng, 70).replace(".", "").split()]
    other = list(line)
    other[35] = "changed"
    rows = [(1, "Head.\n" + " ".join(line)), (2, "Start.\n" + " ".join(other)), (4, sentences(rng, 80))]
    got = ours(make(rows))
    assert got[1]["n_removed"] == 0 and got[2]["text"] == "Start." and got[2]["repeats_of"] == [1] and got[4]["n_removed"] == 0


def test_edges(make):
    rng = random.Random(1)
    t, long = sentences(rng, 90), " ".join(f"x{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, t), (3, t), (4, t), (None, t), (6, long), (7, "the " * 300)]
    got = sorted(((r["doc_id"] or -1), r["text"]) for r in remove_repeats(make([(d, x) for d, x in rows])).collect() if r["text"] is not None)
    texts = [x for d, x in got if d in (3, 4, -1)]
    assert sorted(texts) == ["", "", "", t] and (3, t) in got
    assert (2, "") in got and (6, long) in got and (7, "the " * 300) in got and len(got) == 7


def test_columns_stay(spark, make):
    df = make(["a b", "c d"])
    out = remove_repeats(df)
    assert set(df.columns) - {"rid"} <= set(out.columns)
    assert remove_repeats(df.where("doc_id < 0")).count() == 0


def test_passages_whatever_surrounds_them(make):
    """Other line breaks, no capitals or stops, and long lines: every repeated passage goes whole, and nothing else."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    wrapped = lambda words, n: "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))
    rows, want = [], {}
    for i in range(60):
        passage = [word() for _ in range(rng.choice([50, 51, 55, 60, 80, 200]))]
        a, b, c, d = ([word() for _ in range(rng.randint(60, 90))] for _ in range(4))
        first, second = (13, 11) if i % 2 else (10**6, 10**6)
        rows += [(2 * i, wrapped(a + passage + b, first)), (2 * i + 1, wrapped(c + passage + d, second))]
        want[2 * i], want[2 * i + 1] = a + passage + b, c + d
    rows.append((500, wrapped([word() for _ in range(30)] + rows[1][1].split()[:49], 11)))
    want[500] = rows[-1][1].split()
    got = ours(make(rows))
    assert {d: r["text"].split() for d, r in got.items()} == want
    assert all(got[2 * i + 1]["repeats_of"] == [2 * i] for i in range(60))
