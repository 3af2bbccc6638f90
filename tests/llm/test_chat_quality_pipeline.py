"""Chat formatting, the classifier, and the pipeline."""

import pytest

import corpus_pipeline
from marquee.llm import chat, quality
from marquee.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string"


def rendered(spark, rows):
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS k", "1 AS n", "'b' AS block", "'p' AS prefix").repartition(3)
    out = {}
    for r in sorted(chat.render(df).collect(), key=lambda r: r["k"]):
        out[r["conv_id"]] = out.get(r["conv_id"], "") + r["rendered"]
    return out


def test_snapshots_collapse(spark):
    log = [(i, t) for i, t in enumerate(["hi", "hello", "how", "fine"])]
    rows = [(c, i, "user" if i % 2 == 0 else "assistant", t) for c, n in ((1, 1), (2, 2), (3, 4), (4, 4), (5, 3)) for i, t in log[:n]]
    rows += [(6, 0, "user", "hi"), (6, 1, "assistant", "other"), (7, 0, None, None), (8, 0, "user", "x" * 100_000), (9, 5, "user", "hi"), (9, 9, "assistant", "other"), (9, 9, "assistant", "other")]
    got = rendered(spark, rows)
    assert set(got) == {3, 6, 7, 8}
    assert got[3] == "<|user|>\nhi\n<|assistant|>\nhello\n<|user|>\nhow\n<|assistant|>\nfine\n<|end|>\n"
    assert got[7] == "<||>\n\n<|end|>\n"


def test_long_conversation_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 4)
    rows = [(c, i, "user", f"t{i}") for c, n in ((1, 37), (2, 36), (None, 5)) for i in range(n)] + [(4, 0, "user", "t1")]
    got = rendered(spark, rows)
    assert set(got) == {1, 4} and got[1].count("<|user|>") == 37


def test_no_turns(spark):
    assert rendered(spark, [(1, 0, "user", "a")]) and chat.render(spark.createDataFrame([], TURNS)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op6_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in got) / len(got) > 0.97
    bad = [r["score"] for r in got if r["quality"] == 0]
    good = [r["score"] for r in got if r["quality"] == 1]
    assert sum(b < g for b in bad for g in good) / (len(bad) * len(good)) > 0.98


def test_classifier_edges(spark, make):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (5, None), (5, 1)], "doc_id long, quality int")
    texts = [(i, "good words here " * 5 if i % 2 else "### !! ### !! " * 5) for i in range(40)] + [(100, None), (101, ""), (3, "good words"), (102, "w " * 300_000), (None, "x")]
    got = quality.classify(make(texts), labels).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(0.0 <= r["score"] <= 1.0 for r in quality.classify(make(texts), labels.limit(0)).collect())
    assert quality.classify(make(texts).where("doc_id < 0"), labels).count() == 0


def test_scores_ignore_other_columns(spark, make):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    texts = [(i, "good words here " * 5 if i % 2 else "### !! ### !! " * 5) for i in range(40)]
    model = quality.fit(make(texts), labels)
    twice = quality.scored(make([(7, texts[0][1]), (8, texts[0][1])], clash=False), model).collect()
    assert twice[0]["score"] == twice[1]["score"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf = "/root/testdata/sf0.01"
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_in_order(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    names = list(stages)
    assert [n for n, _ in corpus_pipeline.STAGES] == names[1:]
    for n in names[:-1]:
        assert sorted(stages[n].columns) == sorted(columns)
    for a, b in zip(names, names[1:], strict=False):
        assert set(rows(stages[b])) <= set(rows(stages[a]))


def test_fit_does_not_depend_on_the_order_of_rows(spark):
    texts = [(i % 40, f"{'good clear words here' if i % 2 else 'zz qq xx yy'} {i} {i * 7}") for i in range(160)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    models = [quality.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(n), labels) for n, rows in ((1, texts), (3, texts[::-1]), (7, texts))]
    assert all(m.temperature == models[0].temperature and (m.w1 == models[0].w1).all() and (m.vectors == models[0].vectors).all() for m in models)



def test_quality_keeps_clean_documents(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept, before = rows(stages["quality"]), rows(stages["documents"])
    good = [d for d in before if labels.get(d) == 1]
    bad = [d for d in before if labels.get(d) == 0]
    assert sum(d in kept for d in good) / len(good) > 0.97 and sum(d in kept for d in bad) / len(bad) < 0.1


def test_one_of_each_group_stays(stages):
    from test_jaccard import brute

    before = [(d, r["text"]) for d, r in rows(stages["quality"]).items()]
    assert set(rows(stages["near_duplicates"])) == {c for _, _, c in brute(before)}


def test_passages_are_cut_and_the_rest_stays(stages):
    before, after = rows(stages["near_duplicates"]), rows(stages["repeated_passages"])
    assert set(before) == set(after)
    for d, r in after.items():
        if r["text"] != before[d]["text"]:
            assert len(before[d]["text"].split()) - len(r["text"].split()) >= 50 and r["n_chars"] == len(r["text"])


def test_leaks_go(spark, stages):
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    holds = lambda t: any(i in " ".join(t.lower().split()) for i in items)
    before, after = rows(stages["repeated_passages"]), rows(stages["decontaminate"])
    assert any(holds(r["text"]) for r in before.values()) and not any(holds(r["text"]) for r in after.values())
    assert all(holds(before[d]["text"]) for d in set(before) - set(after))


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, "/root/testdata/sf0.01").collect())) == sorted(map(tuple, stages["mix"].collect()))
