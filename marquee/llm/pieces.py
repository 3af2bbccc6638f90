"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised through the model's compiled character map: at each place the longest key of its trie that starts there is replaced, any other
character stays, and every normalised byte remembers where its source begins. Extra spaces go and the first word gets a space where the model says so; spaces
become U+2581. Pairs of symbols are then merged by score, leftmost first, characters that the vocabulary lacks become one piece for each byte, and each piece is
projected to the bytes of the original text that it stands for.

Pieces that hold U+2581 after another character do not exist in the usual vocabularies; where that is so, words are merged one by one and remembered, with the
same result. Inside long words a text is cut where no piece holds the two characters side by side.

NULL and empty texts have no pieces and decode to the empty text. Rows that repeat are encoded each; an empty table gives no rows; other columns are ignored.
Models with user-defined or unused pieces, spaces as suffixes, or another algorithm than BPE are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import column_of, doc_columns, slices, texts_of

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Words of so many characters are merged together and remembered, up to so many.
WIDTHS = (8, 16, 32)
REMEMBERED = 100_000
#: No pair of symbols; no character any more; a character that no piece has.
NO_RANK = 1 << 40
NOTHING, STRANGE = (1 << 31) - 1, (1 << 31) - 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message; fixed-width values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, data[at : at + size]
            at += size


class CharacterMap:
    """The compiled map: a double-array trie of keys, and the strings that take their place."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.strings = blob[4 + size :]
        self.first = np.array([self._child(0, c) is not None for c in range(256)]) if size else np.zeros(256, bool)

    def _child(self, node: int, byte: int) -> int | None:
        """The place of the unit that ``byte`` leads to from the unit at ``node``."""
        unit = self.units[node]
        base = node ^ ((unit >> 10) << (8 if unit >> 9 & 1 else 0))
        at = base ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that starts at ``at``."""
        node, found = 0, None
        for i in range(at, len(text)):
            node = self._child(node, text[i])
            if node is None:
                break
            unit = self.units[node]
            if unit >> 8 & 1:
                leaf = self.units[node ^ ((unit >> 10) << (8 if unit >> 9 & 1 else 0))] & 0x7FFFFFFF
                found = i + 1 - at, leaf
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(0, found[1])]


class Model:
    def __init__(self, data: bytes):
        pieces, trainer, normaliser = [], {}, {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif number == 2:
                trainer |= dict(fields(value))
            elif number == 3:
                normaliser |= dict(fields(value))
        if trainer.get(3, 1) != 2 or trainer.get(24, 0) or any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces):
            raise ValueError("only BPE models without user-defined pieces, unused pieces and spaces as suffixes")
        self.map = CharacterMap(normaliser.get(2, b""))
        self.dummy, self.squeeze, self.escape = (bool(normaliser.get(n, 1)) for n in (3, 4, 5))
        ids = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.scores = {piece: -score for piece, score, kind in pieces if kind == NORMAL}
        unknown = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
        as_bytes = {int(piece[3:5], 16): i for i, (piece, _, kind) in enumerate(pieces) if kind == BYTE}
        self.bytes = as_bytes if trainer.get(35, 0) else {}
        self.ids, n = ids, len(pieces)
        # Codes: ids, and after them the unknown piece by the bytes that it stands for.
        self.real = np.append(np.arange(n), np.full(4, unknown)).astype(np.int64)
        self.sizes = np.array([1 if kind == BYTE else len(piece.encode()) for piece, _, kind in pieces] + [1, 2, 3, 4])
        self.said = [str(i) for i in self.real]
        self._tables()
        self.of_byte = {i: bytes([b]) for b, i in as_bytes.items()}
        said = trainer.get(44, " ⁇ ".encode())
        self.surfaces = [{CONTROL: b"", UNKNOWN: said}.get(kind, piece.replace(SPACE, " ").encode()) for piece, _, kind in pieces]
        for i, b in self.of_byte.items():
            self.surfaces[i] = b
        self.spaced = {i for i, (piece, _, kind) in enumerate(pieces) if kind == NORMAL and piece.startswith(SPACE)}
        self.silent = {i for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.pairs = {piece[i : i + 2] for piece in ids for i in range(len(piece) - 1)}
        self.by_word = not any(a != SPACE and b == SPACE for a, b in self.pairs)

    def _tables(self) -> None:
        """Characters of pieces as numbers, and which two symbols make which piece of which rank, for ``merged_many``."""
        symbols = self.ids | {c: len(self.sizes) + k for k, c in enumerate(sorted({c for p in self.ids for c in p} - self.ids.keys()))}
        chars = sorted((ord(c), i) for c, i in symbols.items() if len(c) == 1)
        self.chars, self.char_symbols = (np.array(x, np.int64) for x in zip(*chars, strict=True))
        order = {score: k for k, score in enumerate(sorted(set(self.scores.values())))}
        found = [(symbols[p[:i]] << 32 | symbols[p[i:]], order[self.scores[p]], s) for p, s in self.ids.items() for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols]
        self.pair_keys, self.pair_ranks, self.pair_symbols = np.array(sorted(found), np.int64).reshape(-1, 3).T.copy()

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the piece that two symbols make (``NO_RANK`` for none), and its symbol."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK), self.pair_symbols[at]

    def merged_many(self, words: list[str], width: int) -> list[bytes | None]:
        """The codes of words of at most ``width`` characters as 32-bit numbers, by ``merged`` for all words at once; None for words with other characters."""
        lengths = np.array([len(w) for w in words])
        points = np.frombuffer("".join([w.ljust(width) for w in words]).encode("utf-32-le"), "<u4").reshape(-1, width).astype(np.int64)
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        columns = np.arange(width)
        symbols = np.where(self.chars[at] == points, self.char_symbols[at], STRANGE)
        symbols[columns >= lengths[:, None]] = NOTHING
        ranks = np.concatenate([self._pairs(symbols[:, :-1], symbols[:, 1:])[0], np.full((len(words), 1), NO_RANK)], axis=1)
        done, rows = symbols.copy(), np.arange(len(words))
        while len(rows):
            best = ranks.argmin(axis=1)
            live = ranks[np.arange(len(rows)), best] < NO_RANK
            done[rows[~live]] = symbols[~live]
            rows, symbols, ranks, best = rows[live], symbols[live], ranks[live], best[live]
            each = np.arange(len(rows))
            new = self._pairs(symbols[each, best], symbols[each, best + 1])[1]
            moved = np.minimum(columns + (columns > best[:, None]), width - 1)
            symbols, ranks = np.take_along_axis(symbols, moved, 1), np.take_along_axis(ranks, moved, 1)
            symbols[:, -1], ranks[:, -1] = NOTHING, NO_RANK
            symbols[each, best] = new
            ranks[each, best] = self._pairs(new, symbols[each, np.minimum(best + 1, width - 1)])[0]
            left = np.flatnonzero(best)
            ranks[left, best[left] - 1] = self._pairs(symbols[left, best[left] - 1], new[left])[0]
        kept = done != NOTHING
        ends = np.cumsum(kept.sum(axis=1)) * 4
        data = done[kept].astype("<i4").tobytes()
        strange = (kept & (done >= len(self.real))).any(axis=1).tolist()
        return [None if odd else data[a:b] for odd, a, b in zip(strange, [0, *ends.tolist()], ends.tolist())]

    def normalised(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, where in ``text`` the source of that byte begins."""
        data = np.frombuffer(text, np.uint8)
        # A character's bytes all come from its first one.
        source = np.maximum.accumulate(np.where(data & 0xC0 == 0x80, 0, np.arange(len(data))))
        out, origin, done = [], [], 0
        for at in np.flatnonzero(self.map.first[data]).tolist() if self.map.units else ():
            found = self.map.longest(text, at) if at >= done else None
            if found:
                out += [data[done:at], np.frombuffer(found[1], np.uint8)]
                origin += [source[done:at], np.full(len(found[1]), at)]
                done = at + found[0]
        data = np.concatenate([*out, data[done:]])
        source = np.concatenate([*origin, source[done:], [len(text)]])
        if self.squeeze:
            space = data == 32
            kept = ~space
            kept[1:] |= ~space[:-1]
            words = np.flatnonzero(~space)
            begin, end = (words[0], words[-1] + 1) if len(words) else (0, 0)
            kept[:begin] = kept[end:] = False
            source = np.append(source[:-1][kept], source[end])
            data = data[kept]
        if self.dummy and len(data):
            data, source = np.append(np.uint8(32), data), np.append(source[0] if self.squeeze else 0, source)
        if self.escape:
            space = data == 32
            source = np.append(np.repeat(source[:-1], np.where(space, 3, 1)), source[-1])
            return data.tobytes().replace(b" ", SPACE.encode()), source
        return data.tobytes(), source

    def merged(self, text: str) -> list[str]:
        """The symbols of ``text`` after all merges, the best score first, then the leftmost."""
        symbols, n = list(text), len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        scores, heap = self.scores, []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in scores:
                heap.append((scores[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not symbols[i] or j == n or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (more := pair + symbols[k]) in scores:
                    heapq.heappush(heap, (scores[more], i, more))
            h = before[i]
            if h >= 0 and (more := symbols[h] + pair) in scores:
                heapq.heappush(heap, (scores[more], h, more))
        return [s for s in symbols if s]

    def encoded_word(self, word: str) -> bytes:
        """The codes of a word's pieces as 32-bit numbers."""
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.pairs), len(word)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            for symbol in self.merged(word[a:b]):
                if symbol in self.ids:
                    out.append(self.ids[symbol])
                else:
                    raw = symbol.encode()
                    out += [self.bytes[x] for x in raw] if self.bytes else [len(self.real) - 5 + len(raw)]
        return struct.pack(f"<{len(out)}i", *out)


@lru_cache(maxsize=2)
def model_of(data: bytes) -> Model:
    """The parsed model, kept by the Python worker for its next task."""
    return Model(data)


class Encoder:
    """Encodes texts some at a time; remembers short words in two generations."""

    def __init__(self, model: Model):
        self.model, self.young, self.old = model, {}, {}
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall if model.by_word and model.escape else lambda text: [text] if text else []

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """The codes of ``words``; of those that are not remembered, short ones are merged together."""
        if len(self.young) >= REMEMBERED:
            self.young, self.old = {}, self.young
        young, old, out = self.young, self.old, {}
        missing: dict[int, list[str]] = {}
        for w in words:
            known = young.get(w) or old.get(w)
            if known is None:
                missing.setdefault(next((n for n in WIDTHS if len(w) <= n), 0), []).append(w)
            else:
                out[w] = young[w] = known
        for w in missing.pop(0, ()):
            out[w] = self.model.encoded_word(w)
        for width, some in missing.items():
            for begin in range(0, len(some), 10_000):
                part = some[begin : begin + 10_000]
                for w, codes in zip(part, self.model.merged_many(part, width), strict=True):
                    out[w] = young[w] = codes or self.model.encoded_word(w)
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str, np.ndarray, np.ndarray]]:
        """For each text its ids, the same in decimal with commas, and the first and one past the last byte of each piece in the text."""
        norms = [self.model.normalised(t.encode()) for t in texts]
        words = [self.words(n.decode()) for n, _ in norms]
        codes_of = self._learn({w for ws in words for w in ws})
        said = self.model.said
        for (_, source), ws in zip(norms, words, strict=True):
            codes = np.frombuffer(b"".join([codes_of[w] for w in ws]), "<i4")
            spans = source[np.append(0, np.cumsum(self.model.sizes[codes]))]
            yield self.model.real[codes], ",".join([said[i] for i in codes.tolist()]), spans[:-1], spans[1:]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: one leading space that normalisation adds or removes goes; bytes that are no UTF-8 become U+FFFD each."""
        model = self.model
        parts = [model.surfaces[i] for i in ids]
        if model.dummy or model.squeeze:
            for k, i in enumerate(ids):
                if i in model.spaced:
                    parts[k] = parts[k].lstrip(b" ") if model.squeeze else parts[k][1:]
                    if parts[k] or not model.squeeze:
                        break
                elif i not in model.silent:
                    break
        try:
            if model.silent.isdisjoint(ids):
                return b"".join(parts).decode()
        except UnicodeDecodeError:
            pass
        return self._decode_runs(ids, parts)

    def _decode_runs(self, ids: list[int], parts: list[bytes]) -> str:
        out, run = [], b""
        for i, part in [*zip(ids, parts, strict=True), (-1, b"")]:
            if i in self.model.of_byte:
                run += part
                continue
            while run:
                size = next((n for n in (1, 2, 3, 4) if _is_character(run[:n])), 0)
                out.append(run[:size].decode() if size else "�")
                run = run[size or 1 :]
            out.append(part.decode())
        return "".join(out)


def _is_character(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def _model_of(docs: DataFrame, path: str):
    """The model's bytes in a broadcast: a file of fixed size that the driver reads once."""
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, begins, ends: the pieces of each text and the bytes of it that each stands for (one past the last)."""
    data = _model_of(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_of(data.value))
        for batch in batches:
            for part in slices(batch, 100):
                rows = list(encoder.encode(texts_of(part)))
                columns = [pa.array([r[i] for r in rows], pa.list_(t)) for i, t in ((0, pa.int32()), (2, pa.int64()), (3, pa.int64()))]
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), *columns], names=["doc_id", "ids", "begins", "ends"])

    return doc_columns(docs).mapInArrow(run, "doc_id long, ids array<int>, begins array<long>, ends array<long>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with ``doc_id`` and ``ids``; NULL ids as none."""
    data = _model_of(encoded, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_of(data.value))
        for batch in batches:
            for part in slices(batch, 100):
                texts = [encoder.decode(ids or []) for ids in column_of(part, "ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_covered, spans_sha256 of each row: what ``encode`` and ``decode`` give, as digests.

    ``n_covered``: bytes of the text inside the spans of its pieces. ``spans_sha256``: of begin and end of each piece, as 64-bit numbers, little end first.
    """
    data = _model_of(docs, model)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_covered", "spans_sha256"]

    def of(encoder: Encoder, ids: np.ndarray, said: str, begins: np.ndarray, ends: np.ndarray) -> tuple:
        spans = np.stack([begins, ends], axis=1).astype("<i8")
        back = encoder.decode(ids.tolist()).encode()
        return len(ids), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(back).hexdigest(), int((ends - begins).sum()), hashlib.sha256(spans.tobytes()).hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_of(data.value))
        for batch in batches:
            for part in slices(batch, 200):
                rows = [of(encoder, *r) for r in encoder.encode(texts_of(part))]
                types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), *columns], names=names)

    return doc_columns(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_covered long, spans_sha256 string")
