"""SentencePiece encoding (op13): ids, texts and source spans against the sentencepiece library."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from textmill.llm import pieces
from textmill.llm.queries import PIECE_MODEL, tokenizer_path

LETTERS = "aabbccdeé ß'sst  İΣσ 😀ﬁÅÇ̈​ \x85\x1c 12３中文▁<s>\n\t.,!-_　①ｶﾞ½ªﬃ"
SPECIAL = ["", " ", "  ", "▁", "a" * 3000, "ab " * 2000, " " * 50, " " * 3000 + "x", "the quick brown fox " * 50, "\x00", "x" + " " * 17 + "y" + " " * 7,
           "<s> </s> <unk> <0x0A>", "中文字" * 700, "é" * 1500]


def texts(n=400):
    rng = random.Random(1)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(n)] + SPECIAL


def varint(n):
    out = b""
    while n >= 128:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def variant(prefix, squeeze, mapped):
    """The model file with another normaliser: a later field of a message replaces an earlier one."""
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = dict(pieces._fields(next(v for k, v in pieces._fields(library.serialized_model_proto()) if k == 3)))
    own = (b"\x12" + varint(len(spec[2])) + spec[2] if mapped else b"") + b"\x18" + bytes([prefix]) + b"\x20" + bytes([squeeze])
    return pieces.read_model(tokenizer_path(PIECE_MODEL)) + b"\x1a" + varint(len(own)) + own


@pytest.mark.parametrize("data", [None, (1, 0, 1), (1, 1, 1), (0, 0, 1), (0, 1, 0), (1, 1, 0)])
def test_equals_library(data):
    data = variant(*data) if data else pieces.read_model(tokenizer_path(PIECE_MODEL))
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.Model(data)
    given = texts()
    offs, ids, first, last = own.encode(pa.array(given))
    decoded = own.decode(offs, ids).to_pylist()
    for k, text in enumerate(given):
        part = slice(offs[k], offs[k + 1])
        want = library.encode(text, return_type="proto")
        assert ids[part].tolist() == [p.id for p in want.pieces], text[:80]
        assert list(zip(first[part].tolist(), last[part].tolist())) == [(p.begin, p.end) for p in want.pieces], text[:80]
        assert decoded[k] == library.decode([p.id for p in want.pieces])


def test_decodes_any_ids():
    data = pieces.read_model(tokenizer_path(PIECE_MODEL))
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.Model(data)
    rng = random.Random(2)
    rows = [[rng.choice([rng.randint(0, 260), rng.randint(0, own.n - 1)]) for _ in range(rng.randint(0, 12))] for _ in range(2000)]
    rows += [[1, 1, 28705, 264], [0, 28705], [28705, 28705, 264], [200, 264], [3 + 0xE2, 3 + 0x82, 264], [259, 264], [3 + 0xF0, 3 + 0x9F, 3 + 0x98]]
    offs = np.append(0, np.cumsum([len(r) for r in rows]))
    got = own.decode(offs, np.array([x for r in rows for x in r], np.int64)).to_pylist()
    assert got == [library.decode(r) for r in rows]


def test_rows(spark):
    """Nulls, very long texts, repeated rows, clashing names, an empty table; spans cover the source."""
    path = tokenizer_path(PIECE_MODEL)
    rows = [(1, None, "y"), (None, "", "y"), (2, "Ünïcode 中文 😀", None), (2, "Ünïcode 中文 😀", None), (3, "the quick brown fox " * 60_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = pieces.round_trip(df, path)
    assert out.columns == ["doc_id", "text", "ids", "starts", "ends", "decoded"]
    for r in out.collect():
        raw = (r.text or "").encode()
        assert r.decoded == (r.text or "")
        covered = sorted((a, b) for a, b in zip(r.starts, r.ends) if b > a)
        assert b"".join(raw[a:b] for a, b in covered) == raw
    assert pieces.encode(df.limit(0), path).collect() == []
    back = pieces.decode(pieces.encode(df, path).drop("text"), path).select("doc_id", "decoded").collect()
    assert sorted((r[0] or 0, r[1]) for r in back) == sorted((r[0] or 0, r[1] or "") for r in rows)
    assert pieces.decode(spark.createDataFrame([(None,), ([264, None, 99_999],)], "ids array<int>"), path).select("decoded").collect() == [("",), ("a",)]


def test_other_models_are_refused():
    data = pieces.read_model(tokenizer_path(PIECE_MODEL))
    with pytest.raises(ValueError):
        pieces.Model(data + b"\x12\x02\x18\x01")  # model type: unigram
