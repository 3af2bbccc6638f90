"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; what is left is a template. Windows of ``WINDOW`` template tokens of the documents
are joined by hash with those of the benchmark. A document holds an item when the windows that they share cover at least ``threshold``
of the item's tokens and its slots are consistent: one value of the item stands for one value of the document (3 apples and 3
pears for 5 apples and 5 pears), as in the same question with other parameters.

A name is a capitalised word that does not begin a sentence, a unit a unit word after a number. In scripts that put no space between words (Han,
kana, Thai, Lao, Tibetan, Burmese, Khmer) each character is a token; a number is one token in their digits too. An item with fewer tokens than a window
is matched as a whole from ``LEAST`` tokens up; shorter ones, NULL and empty texts match nothing. Rows that repeat a document or item are
compared each. Columns beyond ``doc_id``/``item_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import doc_columns, in_small_batches, shingles, slices, starts_of, texts_of

WINDOW = 5
LEAST = 3
#: Characters of benchmark text that are held in one task; a larger benchmark takes several passes over the documents.
BLOCK_CHARS = 20_000_000
# Scripts without spaces: Thai, Lao, Tibetan; Burmese; Khmer; kana and bopomofo; Han with its compatibility forms, half-width kana.
_SINGLE = rb"\xe0[\xb8-\xbf][\x80-\xbf]|\xe1[\x80-\x82][\x80-\xbf]|\xe1[\x9e\x9f][\x80-\xbf]|\xe3\x80[\x85-\x87]|\xe3[\x81-\x84\x87\x90-\xbf][\x80-\xbf]"
_SINGLE += rb"|[\xe4-\xe9][\x80-\xbf]{2}|\xef[\xa4-\xab][\x80-\xbf]|\xef\xbd[\xa6-\xbf]|\xef\xbe[\x80-\x9f]|\xf0[\xa0-\xbf][\x80-\xbf]{2}"
# Digits of these scripts and full-width ones.
_DIGITS = rb"(?:\xef\xbc[\x90-\x99])+|(?:\xe0[\xb9\xbb][\x90-\x99])+|(?:\xe0\xbc[\xa0-\xa9])+|(?:\xe1\x81[\x80-\x89])+|(?:\xe1\x9f[\xa0-\xa9])+"
# Ends of sentences in these scripts and full-width ones, danda, Arabic full stop and question mark.
_ENDS = rb"\xe3\x80\x82|\xef\xbc[\x81\x8e\x9f]|\xef\xbd\xa1|\xe0\xa5[\xa4\xa5]|\xd8\x9f|\xdb\x94"
# What else parts words: ideographic and full-width punctuation and spaces.
_BREAKS = rb"\xe3\x80[\x80-\xbf]|\xef\xbc[\x80-\x8f\x9a-\xa0\xbb-\xbf]|\xef\xbd[\x80\x9b-\xa5]"
#: Numbers, characters of scripts without spaces, words (with what else is not ASCII), ends of sentences.
TOKEN = re.compile(
    rb"[A-Za-z]++(?![\x80-\xff'])|[0-9]+(?:[.,:/][0-9]+)*|[.!?\n]|(?=[\x80-\xff])(?:" + rb"|".join((_DIGITS, _ENDS, _SINGLE)) + rb")"
    + rb"|(?=[A-Za-z\x80-\xff'])(?:[A-Za-z]++|(?!" + rb"|".join((_DIGITS, _ENDS, _SINGLE, _BREAKS)) + rb")[\xc2-\xf4][\x80-\xbf]*+|(?<=[a-z])'(?=[a-z]))++"
)
#: Tokens of documents that are hashed at once.
CHUNK = 100_000

# Words that are units when they follow a number.
UNITS = frozenset(
    """
    mm cm m km inch inches foot feet yard yards mile miles mg g kg t gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds lb lbs oz
    ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years
    c f k degrees degree percent cent cents dollar dollars euro euros usd eur gbp mph kmh kph w kw watt watts v volt volts j joule joules hz khz mhz ghz
    kb mb gb tb byte bytes bit bits
    """.split()
)

WORD, CAPITAL, NUMBER, MARK, UNIT = range(5)
KIND = np.uint64(7)
SLOT = {k: np.uint64((xxhash.xxh3_64_intdigest(n) & ~7) | WORD) for k, n in ((NUMBER, b"<number>"), (CAPITAL, b"<name>"), (UNIT, b"<unit>"))}


class Codes(dict):
    """64-bit code of a token: a hash of its lower-case form with the kind in the lowest three bits."""

    def __missing__(self, token: bytes) -> int:
        if len(self) > 60_000:
            self.clear()
        text = token.decode("utf-8", "replace")
        # A vowel or tone mark that is a token of its own is part of a word.
        word = text if text.isalnum() or len(text) == 1 and unicodedata.category(text)[0] == "M" else re.sub(r"^[\W_]+|[\W_]+$", "", text)
        low = word.lower()
        if not word:
            kind = MARK
        elif word[0].isdigit():
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        else:
            kind = CAPITAL if word[0].isupper() and len(word) > 1 and not word.isupper() else WORD
        code = self[token] = (xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass")) & ~7) | kind
        return code


def codes_of(text: str, memo: Codes) -> np.ndarray:
    tokens = TOKEN.findall(text.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))


def canonical(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template codes, slot kinds (0 for plain words) and the tokens' own codes, without the marks between sentences; which tokens were kept."""
    kinds = (codes & KIND).astype(np.int8)
    before = np.concatenate([[MARK], kinds[:-1]]) if len(kinds) else kinds
    slots = np.zeros(len(kinds), np.int8)
    slots[kinds == NUMBER] = NUMBER
    slots[(kinds == CAPITAL) & (before != MARK)] = CAPITAL
    slots[(kinds == UNIT) & (before == NUMBER)] = UNIT
    own = codes & ~KIND
    template = own.copy()
    for kind, code in SLOT.items():
        template[slots == kind] = code
    keep = kinds != MARK
    return template[keep], slots[keep], own[keep], keep


class Items:
    """Sorted windows of some benchmark items, with the places that each stands at."""

    def __init__(self, items: list[tuple[int | None, str]]):
        memo = Codes()
        self.ids = [i for i, _ in items]
        self.forms = [canonical(codes_of(t or "", memo))[:3] for _, t in items]
        hashes, places = [], []
        for n, (template, _, _) in enumerate(self.forms):
            if len(template) >= LEAST:
                w = shingles(template, WINDOW)
                hashes.append(w)
                places.extend((n, q) for q in range(len(w)))
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.places = np.array(places, np.int64).reshape(-1, 2)[order]
        self.short = sorted({len(t) for t, _, _ in self.forms if LEAST <= len(t) < WINDOW})
        # A quick test that most windows fail: one bit for each hash by its low bits.
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def hits(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among ``windows`` and rows of ``places`` that are equal."""
        maybe = np.flatnonzero(self.bits[(windows & np.uint64((1 << 22) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(self.hashes, windows[maybe], "left"), np.searchsorted(self.hashes, windows[maybe], "right")
        n = hi - lo
        at = np.repeat(maybe, n)
        rows = np.repeat(lo - starts_of(n)[:-1], n) + np.arange(n.sum())
        return at, rows


def suspects(texts: list[str], items: Items, memo: Codes) -> list[int]:
    """The texts that share a window with an item; many texts are hashed as one, with the end of a sentence between them."""
    out: set[int] = set()
    end = np.array([memo[b"\n"]], np.uint64)
    held: list[np.ndarray] = []
    first = size = 0
    for i, text in enumerate(texts):
        held += [codes_of(text, memo), end]
        size += len(held[-2])
        if size < CHUNK and i + 1 < len(texts):
            continue
        template, _, _, keep = canonical(np.concatenate(held))
        owner = np.repeat(np.arange(first, i + 1), [len(held[j]) + 1 for j in range(0, len(held), 2)])[keep]
        for width in [WINDOW, *items.short]:
            at, _ = items.hits(shingles(template, width)) if len(template) >= width else (np.empty(0, np.int64), None)
            out.update(owner[at[owner[at] == owner[np.minimum(at + width - 1, len(owner) - 1)]]].tolist())
        held.clear()
        first, size = i + 1, 0
    return sorted(out)


def matches(text: str, items: Items, memo: Codes, threshold: float) -> list[tuple]:
    """(item_id, item_tokens, share, n_slots, consistency, verbatim) of the items that a text holds."""
    template, _, own, _ = canonical(codes_of(text, memo))
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for width in [WINDOW, *items.short]:
        if len(template) < width:
            continue
        at, rows = items.hits(shingles(template, width))
        for p, r in zip(at.tolist(), rows.tolist(), strict=True):
            n, q = items.places[r]
            if min(WINDOW, len(items.forms[n][0])) == width:
                found[int(n)].append((p, int(q), width))
    out = []
    for n, hits in found.items():
        form, kinds, values = items.forms[n]
        covered = np.zeros(len(form), bool)
        pairs: dict[int, Counter] = defaultdict(Counter)
        for p, q, width in hits:
            covered[q : q + width] = True
            for i in range(width):
                if kinds[q + i]:
                    pairs[q + i][int(own[p + i])] += 1
        share = float(covered.mean())
        if share < threshold:
            continue
        # The value that each slot of the item most often meets; slots of one value must agree.
        mapped: dict[int, Counter] = defaultdict(Counter)
        same = 0
        for q, seen in pairs.items():
            value = int(values[q]) if int(values[q]) in seen else min(seen, key=lambda v, s=seen: (-s[v], v))
            mapped[int(values[q])][value] += 1
            same += value == int(values[q])
        # A value that stands in one slot agrees with itself; only those in several can disagree.
        several = [c for c in mapped.values() if sum(c.values()) > 1]
        total = sum(sum(c.values()) for c in several)
        agree = sum(max(c.values()) for c in several) / total if total else 1.0
        out.append((items.ids[n], len(form), share, len(pairs), agree, same == len(pairs)))
    return out


def _blocks(benchmark: DataFrame) -> list[list[tuple[int | None, str]]]:
    """The items in parts of about ``BLOCK_CHARS`` characters, one part at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = -(-chars // BLOCK_CHARS)
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, consistency: float = 0.8) -> DataFrame:
    """doc_id, item_id, item_tokens, share, n_slots, consistency, verbatim: one row for each document and item that it holds."""
    schema = "doc_id long, item_id long, item_tokens long, share double, n_slots long, consistency double, verbatim boolean"
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.bool_()]
    rows = in_small_batches(doc_columns(docs))
    out = None
    for block in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            items, memo = Items(shared.value), Codes()
            for batch in (part for whole in batches for part in slices(whole)):
                doc_ids, texts = batch.column(0).to_pylist(), texts_of(batch)
                found = [
                    (doc_ids[i], *m) for i in suspects(texts, items, memo) for m in matches(texts[i], items, memo, threshold) if m[4] >= consistency
                ]
                columns = list(zip(*found, strict=True)) if found else [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[p.split()[0] for p in schema.split(", ")])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)
