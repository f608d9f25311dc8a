"""The BPE queries train the operator's full number of merges by plain BPE and return what the model makes."""

import random

import pytest

from models import plain_bpe
from textmill.plans import catalog


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Few documents of many different words: their vocabulary takes more than 200 merges."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 7))) for _ in range(400)]
    rows = [(k, " ".join(rng.choices(vocabulary, k=100))) for k in range(30)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return path, dict(rows)


def test_bpe_is_trained_in_full(spark, small):
    path, texts = small
    words = {}
    for t in texts.values():
        for w in t.split():
            words[w] = words.get(w, 0) + 1
    merges, sym = plain_bpe(words, 1000)
    assert len(merges) > 200
    want = {w: len(s) for w, s in sym.items()}
    pieces = {r.token: r for r in catalog.q_bpe_piece_rows(spark, path).collect()}
    assert {w: r.pieces for w, r in pieces.items()} == want
    assert {w: r.sym for w, r in pieces.items()} == sym
    ratios = {r.doc_id: r for r in catalog.q_token_char_ratio_bpe_rows(spark, path).collect()}
    for k, t in texts.items():
        n = sum(want[w] for w in t.split())
        assert (ratios[k].n_chars, ratios[k].n_pieces) == (len(t), n)
        assert ratios[k].ratio == pytest.approx(n / len(t))
