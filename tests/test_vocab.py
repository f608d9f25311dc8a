"""Vocabulary, encoding and ratio operators."""

from pyspark.sql import functions as F

from textmill.functions.tokens import word_tokens
from textmill.operators import vocab as vb


def test_word_tokens(one):
    assert one(word_tokens, "Héllo, WORLD! Ünïcödé 北京 don't") == \
        ["hello", ",", "world", "!", "unicode", "北", "京", "don", "'", "t"]


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_vocab_order_and_specials(spark):
    docs = _docs(spark, [(1, "b " * 9 + "a " * 9 + "c " * 8 + "d " * 7)])
    v = {r.token: (r.id, r.freq) for r in vb.build_vocab(docs).collect()}
    assert v["<pad>"] == (0, 0) and v["<unk>"] == (1, 0)
    assert v["a"] == (2, 9) and v["b"] == (3, 9) and v["c"] == (4, 8)
    assert "d" not in v  # below min frequency 8
    small = {r.token for r in vb.build_vocab(docs, vocab_size=3).collect()}
    assert small == {"<pad>", "<unk>", "a"}


def test_unk_ratio_and_gates(spark):
    vocab = spark.createDataFrame([("<pad>", 0, 0), ("<unk>", 1, 0), ("a", 2, 9), ("b", 3, 9)],
                                  "token string, id int, freq long")
    docs = _docs(spark, [(1, "x a x b"), (2, "a a a a a a a a a x"), (3, "a b"), (4, "   ")])
    r = {x.doc_id: x.unk_ratio for x in vb.unk_ratios(docs, vocab).collect()}
    assert r == {1: 0.5, 2: 0.1, 3: 0.0, 4: None}
    assert {x.doc_id for x in vb.unk_cut(docs, vocab, 0.1).collect()} == {2, 3}
    assert {x.doc_id for x in vb.language_filter(docs, vocab, 0.1).collect()} == {3}
    enc = {x.doc_id: (x.ids, x.n_pad) for x in vb.encode(docs, vocab, max_len=3, pad_to=3).collect()}
    assert enc[1] == ([1, 2, 1], 0) and enc[3] == ([2, 3], 1) and enc[4] == ([], 3)
    whole = {x.doc_id: (len(x.ids), x.n_pad) for x in vb.encode(docs, vocab).collect()}
    assert whole == {1: (4, 65532), 2: (10, 65526), 3: (2, 65534), 4: (0, 65536)}


def test_lookup_is_bounded(spark):
    import pytest

    rows = spark.range(5).select(F.col("id").cast("string").alias("token"), F.lit(1).alias("pieces"))
    with pytest.raises(ValueError):
        vb.Lookup(rows, "pieces", limit=4)
    docs = _docs(spark, [(1, "a"), (2, None), (3, "")])
    none = spark.createDataFrame([], "token string, id int")
    assert {x.doc_id: x.n_unk for x in vb.unk_ratios(docs, none).collect()} == {1: 1, 2: 0, 3: 0}


def test_encode_keeps_tokens_beyond_the_vocabulary_size(spark):
    vocab = spark.createDataFrame([("a", 2)], "token string, id int")
    docs = _docs(spark, [(1, "a " * 70_000)])
    r = vb.encode(docs, vocab).first()
    assert len(r.ids) == 70_000 and r.n_pad == 0


def test_token_char_ratio_and_windows(spark):
    vocab = spark.createDataFrame([("<pad>", 0, 0), ("<unk>", 1, 0), ("ab", 2, 9)], "token string, id int, freq long")
    pieces = vb.piece_table(vocab)
    docs = _docs(spark, [(1, "ab ab"), (2, "xyz ab")])
    r = {x.doc_id: x.ratio for x in vb.token_char_ratios(docs, ["doc_id"], pieces).collect()}
    assert r == {1: 2 / 5, 2: 4 / 6}
    assert {x.doc_id for x in vb.redundancy_filter(docs, pieces, threshold=0.5).collect()} == {1}
    share = {x.doc_id: (x.n_windows, x.bad_share) for x in vb.window_bad_share(docs, pieces, 3, 0.5).collect()}
    # windows "ab ", "ab" -> ratios 1/3, 1/2 (not > .5); "xyz", " ab" -> 1.0, 1/3
    assert share == {1: (2, 0.0), 2: (2, 0.5)}
    kept = {x.doc_id for x in vb.redundancy_gate(docs, pieces, 3, 0.5).collect()}
    assert kept == {1}


def test_global_rank(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    r = vb.global_rank(df, F.desc("k"))
    got = [(x.k, x.rank) for x in r.orderBy("rank").collect()]
    assert got == [(999 - i, i + 1) for i in range(1000)]


def test_shard_counts_merge_to_the_full_vocabulary(spark, tmp_path):
    """A token that is rare in every shard counts by its sum; a shard saved twice counts once."""
    import random

    rng = random.Random(2)
    docs = _docs(spark, [(k, " ".join(rng.choices("abcdefghijklmnop", weights=range(1, 17), k=30))) for k in range(40)] + [(90, "rare"), (91, None)] + [(92 + k, "rare") for k in range(8)])
    path = str(tmp_path / "counts")
    for n in (0, 1, 2, 1, 3):
        vb.save_shard_counts(docs.where(f"doc_id % 4 = {n}"), path, f"shard{n}")
    whole = sorted(map(tuple, vb.build_vocab(docs, vocab_size=15).collect()))
    assert sorted(map(tuple, vb.vocab_from_shards(spark, path, vocab_size=15).collect())) == whole
    assert ("rare", 9) in [(t, n) for t, _, n in vb.vocab_from_shards(spark, path).collect()]
