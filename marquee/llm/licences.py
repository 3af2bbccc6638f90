"""Licence scan by a positional index of rare words.

The words of all licence templates are indexed with their places. Of each template the words with the highest inverse document frequency
(counted over all documents) are looked up in each file, as many as it takes for the others to weigh less than ``threshold``: no alignment
that reaches it is without one of them. Wherever one stands the template is laid over the file, the weight of the words that stand in
their places is measured, and the label counts if that reaches ``threshold`` and all mandatory phrases stand nearby.

Words are runs of characters that are neither ASCII controls, punctuation, nor space, A-Z lower-cased. NULL and empty texts have no words and
no labels. Rows that repeat a ``doc_id`` are scanned each. Labels without any are the empty string; the score is then the weight of the
best alignment at a looked-up word, times ``threshold``, 0 without one. Columns beyond ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import doc_columns, texts_of

# Phrases whose every place is reported, with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices of well-known licences, as label, words, phrases that must be there.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee is hereby granted"]),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("lgpl-3", "this work is licensed under the gnu lesser general public license version 3", ["gnu lesser general public license", "version 3"]),
    ("agpl-3", "this work is licensed under the gnu affero general public license version 3", ["gnu affero general public license", "version 3"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights", ["waived all copyright"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("all-rights-reserved", "all rights reserved", ["all rights reserved"]),
]

OTHER = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Words by which a phrase may lie outside its template, or a template be shifted inside.
SLACK = 3


def licence_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(OTHER).split() if text else []


@dataclass
class Index:
    idf: dict[bytes, float]
    templates: list[tuple[str, list[bytes], list[list[bytes]], float]] = field(default_factory=list)
    postings: dict[bytes, list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))
    base: list[tuple[str, list[bytes], int]] = field(default_factory=list)


def vocabulary() -> list[bytes]:
    return sorted({w for _, text, _ in TEMPLATES for w in text.encode().split()} | {w for p in BASE for w in p.encode().split()})


def build_index(idf: dict[bytes, float]) -> Index:
    index = Index(idf)
    for label, text, phrases in TEMPLATES:
        words = text.encode().split()
        for place, w in enumerate(words):
            index.postings[w].append((len(index.templates), place))
        index.templates.append((label, words, [p.encode().split() for p in phrases], sum(idf[w] for w in words)))
    for phrase, label in BASE.items():
        words = phrase.encode().split()
        index.base.append((label, words, max(range(len(words)), key=lambda i: idf[words[i]])))
    return index


def word_idf(docs: DataFrame) -> dict[bytes, float]:
    """Inverse document frequency of every licence word over all documents; the driver gets one number for each word."""
    words = vocabulary()

    def count(batches):
        known, seen, n = set(words), Counter(), 0
        for batch in batches:
            for text in texts_of(batch):
                seen.update(known.intersection(licence_words(text)))
                n += 1
        rows = [("", n), *((w.decode(), c) for w, c in seen.items())]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.int64())], names=["word", "n"])

    counted = doc_columns(docs).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"].encode(): r["n"] for r in counted.collect()}
    total = found.pop(b"", 0)
    return {w: math.log((total + 2) / (found.get(w, 0) + 1)) for w in words}


def _has(words: list[bytes], phrase: list[bytes], begin: int, end: int) -> bool:
    return any(words[i : i + len(phrase)] == phrase for i in range(max(0, begin), min(end, len(words) - len(phrase) + 1)))


def scan(words: list[bytes], index: Index, threshold: float) -> tuple[list[int], set[str], set[str], float]:
    """Places of base phrases, base labels, the method's labels, and the best weight."""
    places: dict[bytes, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        if w in index.idf:
            places[w].append(i)
    base, base_labels = [], set()
    for label, phrase, rare in index.base:
        for i in places.get(phrase[rare], ()):
            if i >= rare and words[i - rare : i - rare + len(phrase)] == phrase:
                base.append(i - rare)
                base_labels.add(label)
    labels, best = set(), 0.0
    for label, template, phrases, total in index.templates:
        by_weight = sorted(range(len(template)), key=lambda i: (-index.idf[template[i]], i))
        begins, rest = set(), total
        for place in by_weight:
            if rest < threshold * total - 1e-9:
                break
            rest -= index.idf[template[place]]
            for i in places.get(template[place], ()):
                begins.update(range(i - place - SLACK, i - place + SLACK + 1))
        for begin in sorted(begins):
            # The share that changes something: enough for the label, or a better score without it.
            hit, left, least = 0.0, total, min(threshold, best / threshold if threshold else 0.0) * total
            for place in by_weight:
                w = template[place]
                left -= index.idf[w]
                if w in places and w in words[max(0, begin + place - SLACK) : max(0, begin + place + SLACK + 1)]:
                    hit += index.idf[w]
                elif hit + left < least - 1e-9:
                    break
            share = min(1.0, hit / total) if total > 0 else 0.0
            if share >= threshold and all(_has(words, p, begin - SLACK, begin + len(template) + SLACK) for p in phrases):
                labels.add(label)
                best = max(best, share)
            else:
                best = max(best, share * threshold)
    return base, base_labels, labels, 1.0 if base else best


def scan_licences(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs``."""
    index = build_index(word_idf(docs))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                words = licence_words(text)
                base, base_labels, labels, score = scan(words, index, threshold)
                rows.append((doc_id, len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[p.split()[0] for p in schema.split(", ")])

    return doc_columns(docs).mapInArrow(run, schema)
