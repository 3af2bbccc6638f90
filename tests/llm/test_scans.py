"""Licences, decontamination and fingerprints against brute force and hand-made cases."""

import hashlib
import re

import pytest

from marquee.llm import decontaminate, lempel_ziv, licences

SF = "/root/testdata/sf0.001"


def brute_licences(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in licences.BASE.items():
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_places(spark, make):
    texts = [
        "Licensed under the Apache License, Version 2.0.", "x" * 50_000, None, "", "under THE mit\nlicense under the mit license!", "CC-BY-NC 4.0 cc by-nc", "under the mit licenses",
        "éunder the mit license", "under the mit license" * 3, "apache license version 20",
    ]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in licences.scan_licences(make(texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licences(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_labels_of_the_method(make):
    texts = [
        "Intro. This work is licensed under the GNU General Public License, version 3. More.",
        "This work is licensed under the GNU General Public License, version 2.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)",
        "The licence of the general public was granted, this software works under version 3 of the plan.",
        "All rights reserved.",
    ]
    got = {r["doc_id"]: r["labels"] for r in licences.scan_licences(make(texts)).collect()}
    assert got == {0: "gpl-3", 1: "gpl-2", 2: "mit", 3: "", 4: "all-rights-reserved"}
    assert licences.scan_licences(make(texts).where("doc_id < 0")).count() == 0


def test_every_notice_of_a_file_is_found():
    texts: dict[str, list[str]] = {}
    for label, text, _ in licences.TEMPLATES:
        texts.setdefault(label, []).append(text)
    index = licences.build_index(dict.fromkeys(licences.vocabulary(), 1.0))
    found = lambda text: licences.scan(licences.licence_words(text), index, 0.8)[2]
    every = [(label, t) for label, ts in texts.items() for t in ts]
    assert found(" filler ".join(t for _, t in every)) == set(texts)
    for i, (a, x) in enumerate(every):
        for b, y in every[:i]:
            assert {a, b} <= found(f"{x}. Some more words. {y}."), (a, b)
    assert {"bsd", "mpl-2", "cc0"} <= found(" and ".join(texts[k][0] for k in ("bsd", "mpl-2", "cc0")))
    assert found(" ".join(w.decode() for w in licences.vocabulary())) <= {"all-rights-reserved"}


ITEM = "On Monday the farmer Ann sold 12 kg of apples to Bob and 30 kg of pears to Carl, then she bought 12 eggs from Bob for the kitchen."


def held(make, spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'x' AS share")
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(make(docs), bench).collect()}


def test_same_question_with_other_parameters(make, spark):
    docs = [
        "Something before. " + ITEM + " And after.",
        "Words. " + ITEM.replace("Ann", "Eve").replace("12", "7").replace("30", "9").replace("Bob", "Tom"),
        "Other. " + ITEM.replace("12 kg", "7 kg").replace("30", "9").replace("12 eggs", "8 eggs").replace("to Bob", "to Tom").replace("from Bob", "from Jim"),
        "The farmer sold apples to a man and pears to another, then she bought eggs for the kitchen.",
        None, "", ITEM[: len(ITEM) // 2],
    ]
    got = held(make, spark, docs, [(7, ITEM), (8, None), (9, ""), (10, "one"), (7, ITEM)])
    assert {d for d, _ in got} == {0, 1} and {i for _, i in got} == {7}
    assert got[0, 7]["verbatim"] and not got[1, 7]["verbatim"] and got[1, 7]["consistency"] == 1.0


def test_scripts_without_spaces():
    items = ["小明有五个苹果，他给了小红两个苹果，还剩下几个苹果？", "太郎はりんごを五個持っています。花子に二個あげました。残りは何個ですか？", "มานีมีแอปเปิลห้าลูกแล้วให้เพื่อนไปสองลูกเหลือกี่ลูก"]
    memo, index = decontaminate.Codes(), decontaminate.Items([(i, t) for i, t in enumerate(items)])
    for i, t in enumerate(items):
        for doc in (t, f"前文“说明”——其他内容{t}后面还有文字。", f"Some English before: {t} and after."):
            assert decontaminate.suspects([doc], index, memo) == [0]
            got = decontaminate.matches(doc, index, memo, 0.8)
            assert [m[0] for m in got] == [i] and got[0][5], doc
        assert decontaminate.matches("今天天气很好，我们去公园散步吧。明日は雨が降るでしょう。วันนี้อากาศดีมาก", index, memo, 0.8) == []
    words = lambda text: [t.decode() for t in decontaminate.TOKEN.findall(text.encode())]
    assert words("价格１２元。ok don't “naïve” का है। 3.5kg") == ["价", "格", "１２", "元", "。", "ok", "don't", "“naïve”", "का", "है", "।", "3.5", "kg"]


def test_benchmark_in_blocks_gives_the_same(make, spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    one = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2000)
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == one and one
    plain = {r["item_id"]: " ".join(r["text"].lower().split()) for r in bench.collect()}
    whole = {(r["doc_id"], i) for r in docs.collect() for i, t in plain.items() if t in " ".join(r["text"].lower().split())}
    assert whole <= {(r[0], r[1]) for r in one}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 and decontaminate.contaminated(docs.limit(0), bench).count() == 0


def brute_fingerprint(text):
    data = text.encode()
    phrases, at = set(), 0
    while at < len(data):
        end = at + 1
        while end < len(data) and data[at:end] in phrases:
            end += 1
        phrases.add(data[at:end])
        at = end
    return phrases


def phrases_of(text):
    parse = lempel_ziv.Parse()
    parse.feed(text.encode())
    return len(parse.hashes) - 1


@pytest.mark.parametrize("text", ["", "a", "aaaaaaaaaa", "abababab", "the theory of the thing", "é" * 9, "xyz" * 500])
def test_phrases(text):
    assert phrases_of(text) == len(brute_fingerprint(text))


def test_fingerprints_and_followers(make, spark):
    rows = [(5, "abcdef" * 50), (9, "hello world " * 30), (2, None), (7, "abcdef" * 50), (1, "é日本" * 40), (4, "x"), (3, ""), (8, "y" * 20_000)]
    got = {r["doc_id"]: r for r in lempel_ziv.fingerprints(make(rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        third = len(t) // 3
        changed = t[: len(t) - third] + following[:third]
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == lempel_ziv.text_of(lempel_ziv.fingerprint(t)) and r["edited_fingerprint"] == lempel_ziv.text_of(lempel_ziv.fingerprint(changed))
        assert r["near_edited"] == lempel_ziv.likeness(lempel_ziv.fingerprint(t), lempel_ziv.fingerprint(changed))
        assert r["near_next"] == lempel_ziv.likeness(lempel_ziv.fingerprint(t), lempel_ziv.fingerprint(following))
    assert got[5]["fingerprint"] == got[7]["fingerprint"]


def test_fingerprints_of_few_rows(make):
    one = lempel_ziv.fingerprints(make([(4, "abcabcabc")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    same = lempel_ziv.fingerprints(make([(4, "b"), (4, "a"), (None, "c"), (4, "a")])).collect()
    assert len(same) == 4
    assert lempel_ziv.fingerprints(make([]).where("doc_id < 0")).count() == 0
