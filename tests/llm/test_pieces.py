import hashlib
import random

import numpy as np
import pytest

from marquee.llm import pieces

public = pytest.importorskip("public_tokenizers")
library = pytest.importorskip("sentencepiece")

ODD = ["", " ", "  ", "a", "▁", "▁▁ a▁b", "\t\n x", "héllo  wörld ", "日本語テキスト 中文 ไทย", "😀😀 x", "\x00a\x00", "<s> </s> <unk> <0x41>", "a" * 5000, "  lead", "trail   ", "é́", "�", "ﬁ ①"]
ODD += ["abcdefghi" * 30 + "日" * 40, "x" * 31 + " " + "y" * 32 + " " + "z" * 33]


def mixed_texts(n, alphabet, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(n)]


def path():
    return public.path("piece_bpe_32k.model")


def plain():
    with open(path(), "rb") as f:
        return f.read()


def renormalised(rule, **flags):
    """The model with the compiled character map of ``rule``: of a field that comes twice, the later one counts."""
    spec = library.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
    numbers = {"dummy": 3, "squeeze": 4, "escape": 5}
    spec += b"".join(bytes([numbers[k] << 3, int(v)]) for k, v in flags.items())
    size, out = len(spec), b""
    while size > 127:
        out, size = out + bytes([size & 127 | 128]), size >> 7
    return plain() + bytes([3 << 3 | 2]) + out + bytes([size]) + spec


def loaded(data):
    sp = library.SentencePieceProcessor()
    sp.load_from_serialized_proto(data)
    return sp


def spans(sp, text):
    return [(p.begin, p.end) for p in sp.encode(text, return_type="proto").pieces]


@pytest.mark.parametrize(
    "data",
    [plain, lambda: renormalised("nmt_nfkc"), lambda: renormalised("nmt_nfkc_cf", squeeze=True), lambda: renormalised("nfkc", squeeze=False, dummy=False)],
    ids=["as it is", "nmt_nfkc", "folded case", "no dummy"],
)
def test_as_the_library(data):
    data = data()
    sp, encoder = loaded(data), pieces.Encoder(pieces.Model(data))
    texts = ODD + mixed_texts(800, "ab c▁é日😀\n.,0́ﬁ\xa0①Aｱﾞ​㌔")
    for text, (ids, said, begins, ends) in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == sp.encode(text), text
        assert said == ",".join(map(str, ids.tolist()))
        assert list(zip(begins.tolist(), ends.tolist(), strict=True)) == spans(sp, text), text
        assert encoder.decode(ids.tolist()) == sp.decode(ids.tolist()), text


def test_decodes_any_ids():
    rnd, sp, encoder = random.Random(2), loaded(plain()), pieces.Encoder(pieces.Model(plain()))
    for _ in range(2000):
        ids = [rnd.choice([rnd.randrange(3, 259), rnd.randrange(0, 32000), 29871, 0, 1, 2]) for _ in range(rnd.randrange(8))]
        assert encoder.decode(ids) == sp.decode(ids), ids


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    sp, encoder = loaded(plain()), pieces.Encoder(pieces.Model(plain()))
    for text in mixed_texts(200, "abc ", 3):
        assert next(encoder.encode([text]))[0].tolist() == sp.encode(text)
        assert len(encoder.young) < 100


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Model(b"\x0a\x05\x0a\x03abc")


def test_encode_and_decode_tables(spark, make):
    texts = [*ODD, None, "twice", "twice"]
    docs = make(texts)
    sp = loaded(plain())
    rows = {r["doc_id"]: r for r in pieces.encode(docs, path()).collect()}
    back = {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(docs, path()), path()).collect()}
    digests = {r["doc_id"]: r for r in pieces.round_trip(docs, path()).collect()}
    assert len(rows) == len(back) == len(digests) == len(texts)
    for i, text in enumerate(texts):
        ids = sp.encode(text or "")
        assert rows[i]["ids"] == ids
        assert list(zip(rows[i]["begins"], rows[i]["ends"], strict=True)) == spans(sp, text or "")
        assert back[i] == sp.decode(ids)
        d = digests[i]
        assert d["n_tokens"] == len(ids)
        assert d["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert d["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        assert d["n_covered"] == len((text or "").encode())
        assert d["spans_sha256"] == hashlib.sha256(np.array(spans(sp, text or ""), "<i8").tobytes()).hexdigest()
    assert pieces.round_trip(docs.limit(0), path()).count() == 0


def test_whole_table_as_the_library(spark):
    from marquee.llm.queries import QUERIES

    sp = loaded(plain())
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op12_pieces"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = sp.encode(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
