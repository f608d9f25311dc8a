"""Word n-gram scores (op6) against a plain model, and what they must see of a corpus."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm import wordscore

ODD = [None, "", " \t\n", "a", "Ünïcode 中文 😀", "x " * 50_000, "same text", "same text"]


def losses(corpus, vocabulary):
    """Mean -log2 of a text's words under the bigram model of ``corpus``."""
    one, ctx, two = collections.Counter(), collections.Counter(), collections.Counter()
    for t in corpus:
        w = ["<edge>", *(t or "").split()]
        for a, b in zip(w, w[1:]):
            one[b] += 1
            ctx[a] += 1
            two[a, b] += 1
    n = sum(one.values())

    def mean(t):
        w, bits = ["<edge>", *(t or "").split()], 0.0
        for a, b in zip(w, w[1:]):
            p = (one[b] + wordscore.UNSEEN) / (n + wordscore.UNSEEN * vocabulary)
            bits -= math.log2((two[a, b] + wordscore.PRIOR * p) / (ctx[a] + wordscore.PRIOR))
        return bits / max(len(w) - 1, 1)

    return mean


@pytest.mark.parametrize("chunk_bytes", [wordscore.CHUNK_BYTES, 100])
def test_scores_equal_brute_force(spark, chunk_bytes, monkeypatch):
    monkeypatch.setattr(wordscore, "CHUNK_BYTES", chunk_bytes)
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "b", "é", "中", "ab,", "A"]) for _ in range(rng.randint(0, 30))) for _ in range(60)] + ODD
    rows = [(k if k % 7 else None, t, "y") for k, t in enumerate(texts)]
    good = {k for k, *_ in rows if k and k % 3 == 0}
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = wordscore.scores(df, spark.createDataFrame([(k,) for k in good] * 2 + [(None,)], "id long"))
    assert out.columns == ["doc_id", "n_tokens", "loss_target", "loss_background", "score"]
    vocabulary = len({w for t in texts for w in (t or "").split()}) + 1
    target, background = losses([t for k, t, _ in rows if k in good], vocabulary), losses(texts, vocabulary)
    want = sorted((k or -1, len((t or "").split()), round(target(t), 6), round(background(t), 6), round(background(t) - target(t), 5)) for k, t, _ in rows)
    got = sorted((r[0] or -1, r[1], round(r[2], 6), round(r[3], 6), round(r[4], 5)) for r in out.collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [x for g in got for x in g[2:]] == pytest.approx([x for w in want for x in w[2:]], abs=3e-5)
    none = wordscore.scores(df, spark.createDataFrame([], "id long")).collect()
    assert all(r.loss_target == pytest.approx(math.log2(vocabulary) if r.n_tokens else 0) for r in none)
    assert wordscore.scores(df.limit(0), spark.createDataFrame([(1,)], "id long")).collect() == []


def test_words_of_the_target_count(spark):
    """Texts of the same bytes and byte trigrams: only whole words and phrases tell them apart."""
    def made(a, b):
        return " ".join([a, b] * 20)

    rows = [(k, made("abab", "ba")) for k in range(5)] + [(k, made("ab", "baba")) for k in range(5, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in wordscore.scores(df, df.where("doc_id < 4").select("doc_id")).collect()}
    assert got[4] > 0 > got[9]


def test_texts_are_shuffled_once(spark):
    """Counting and scoring read one exchange of the texts; a chunk that lacks a bucket gets its sums all the same."""
    rows = [(k, f"w{k} w{k % 7} " + "some longer text " * 200) for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = wordscore.scores(df, df.where("doc_id % 3 = 0").select("doc_id"))
    assert len(out.collect()) == 2000
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("FlatMapCoGroupsInArrow") == 2


def test_slices_of_a_chunk_add_up():
    texts = ["a b a", None, "", "b a b a", "c", "a b a", "é a"]
    docs = pa.table({"text": pa.chunked_array([texts[:3], texts[3:]], pa.string())})
    chosen = np.array([True, False, True, True, False, False, True])
    whole, cut = wordscore.Chunk(docs, "text"), wordscore.Chunk(docs, "text", limit=1)
    assert len(cut.parts) > len(whole.parts) and cut.hashes.tolist() == whole.hashes.tolist() == sorted(set(whole.hashes.tolist()))
    for these in (None, chosen):
        assert cut.counts(these).tolist() == whole.counts(these).tolist()
    words = whole.counts()[(whole.hashes & np.uint64(3)) == wordscore.WORD]
    assert sorted(words.tolist()) == [1, 1, 4, 7]  # c, é, b, a
