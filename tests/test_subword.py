"""BPE subword model (G5) against plain BPE in Python, and as a piece source of the gates."""

import random

import pytest
from models import plain_bpe
from pyspark.sql import functions as F

from textmill.operators import subword
from textmill.operators import vocab as vb
from textmill.operators.subword import BpeModel, train_bpe


def corpus(seed, n=300):
    rng = random.Random(seed)
    syll = ["th", "e", "an", "in", "er", "qu", "x", "é", "aa", "😀", "."]
    words = {}
    for _ in range(n):
        w = "".join(rng.choice(syll) for _ in range(rng.randint(1, 5)))
        words[w] = words.get(w, 0) + rng.randint(1, 20)
    return words


@pytest.mark.parametrize("seed, hint_words, ahead", [(3, 20_000, 128), (4, 0, 4), (5, 3, 7), (6, 40, 1)])
def test_merges_equal_plain_bpe(spark, seed, hint_words, ahead):
    """Whatever the guesses are worth, down to none at all."""
    words = corpus(seed)
    n = 60 if ahead > 100 else 25
    want, sym = plain_bpe(words, n)
    merges, pieces, model = train_bpe(spark.createDataFrame(list(words.items()), "token string, freq long"), n, hint_words=hint_words, ahead=ahead)
    assert model == want
    assert [(r.left, r.right) for r in merges.orderBy("rank").collect()] == want
    assert {r.token: r.sym for r in pieces.collect()} == sym


def test_trains_until_no_pair_is_left(spark):
    words = {"abab": 3, "ab": 2, "c": 1, "": 4}
    want, sym = plain_bpe(words, 1000)
    _, pieces, model = train_bpe(spark.createDataFrame([*words.items(), (None, 9)], "token string, freq long"))
    assert model == want and {r.token: r.sym for r in pieces.collect()} == sym
    assert train_bpe(spark.createDataFrame([], "token string, freq long"))[2] == []


def test_a_pair_learnt_twice(spark):
    """"the" comes from two pairs, so ("the", "r") may be learnt before and after the second."""
    words = {"ther": 10, "then": 9, "he": 30, "xhe": 25, "the": 12, "thr": 5, "xther": 3}
    for n in range(1, 16):
        want, sym = plain_bpe(words, n, 1)
        _, pieces, model = train_bpe(spark.createDataFrame(list(words.items()), "token string, freq long"), n, min_count=1)
        assert model == want and {r.token: r.sym for r in pieces.collect()} == sym


def test_rounds_count_only_words_that_change(spark, monkeypatch):
    words = corpus(8)
    _, _, model = train_bpe(spark.createDataFrame(list(words.items()), "token string, freq long"), 20)
    df = spark.createDataFrame(list(words.items()), "token string, freq long")
    rows = subword._steps(df, model[:10], model[10:12]).collect()
    sym = plain_bpe(words, 10)[1]
    after = plain_bpe(words, 12)[1]
    changed = {p for w in words if sym[w] != after[w] for s in (sym[w], after[w]) for p in zip(s, s[1:])}
    assert rows and {(r.a, r.b) for r in rows} <= changed | {model[10], model[11]}


def test_long_token_is_linear(spark):
    import time

    df = spark.createDataFrame([("ab" * 50_000, 1), ("abab", 3)], "token string, freq long")
    t0 = time.time()
    _, pieces, _ = train_bpe(df, n_merges=6)
    got = {len(r.token): r.pieces for r in pieces.select("token", "pieces").collect()}
    assert got[4] == 2 and got[100_000] < 13_000
    assert time.time() - t0 < 30


def test_bpe_model_applies_to_new_words(spark, tmp_path):
    words = {"there": 30, "the": 50, "then": 20, "hen": 5}
    df = spark.createDataFrame(list(words.items()), "token string, freq long")
    _, pieces, merges = train_bpe(df, n_merges=6)
    trained = {r.token: r.pieces for r in pieces.collect()}
    assert {r.token: r.pieces for r in subword.bpe_pieces(df.select("token"), merges).collect()} == trained
    BpeModel(spark, merges).save(str(tmp_path / "model"))
    model = BpeModel.load(spark, str(tmp_path / "model"))
    assert model.merges == merges
    got = {r.token: r.pieces for r in model.pieces(spark.createDataFrame([("thenthe",), ("zzz",), (None,)], "token string")).collect()}
    assert got["zzz"] == 4 and got["thenthe"] < 8 and got[None] is None
    with pytest.raises(ValueError):
        BpeModel(spark, [("a", "b")] * (subword.MAX_MERGES + 1))


@pytest.fixture(scope="module")
def many(spark):
    """More different words than a vocabulary holds, with a model and its piece table."""
    rng = random.Random(9)
    rows = [(k, " ".join("".join(rng.choices("abcdefgh", k=rng.randint(4, 7))) for _ in range(400)) + (" the the the" * 40 if k % 3 else "")) for k in range(250)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, "  ")], "doc_id long, text string").repartition(4).checkpoint()
    assert vb.word_counts(docs).count() > vb.VOCAB_SIZE
    model = subword.bpe_model(docs, n_merges=60)
    return docs, model, subword.bpe_pieces(vb.token_rows(docs, [], "text"), model.merges).select("token", "pieces").checkpoint()


def test_gates_take_models_of_any_vocabulary(spark, many):
    docs, model, table = many
    ratios = {r.doc_id: r.ratio for r in vb.token_char_ratios(docs, ["doc_id"], table).collect()}
    limit = sorted(r for r in ratios.values() if r)[120]
    want = {k for k, r in ratios.items() if r is not None and r < limit}
    narrow = vb.redundancy_filter(docs, model, threshold=limit)
    assert {r.doc_id for r in narrow.collect()} == want and 100 < len(want) < 200
    assert "Exchange" not in narrow._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        vb.redundancy_filter(docs, table)


def test_windows_equal_the_join(spark, many):
    from textmill.functions.segment import char_windows

    docs, model, _ = many
    wins = docs.select("doc_id", F.posexplode(char_windows(F.coalesce("text", F.lit("")), 100)).alias("w", "text"))
    by_window = vb.token_char_ratios(wins, ["doc_id", "w"], window_pieces(wins, model))
    limit = by_window.agg(F.percentile_approx("ratio", 0.85)).first()[0]
    want = {r.doc_id: (r.n, r.share) for r in by_window.groupBy("doc_id").agg(F.count("*").alias("n"), F.avg((F.col("ratio") > limit).cast("double")).alias("share")).collect()}
    got = vb.window_bad_share(docs, model, 100, limit)
    assert {r.doc_id: (r.n_windows, round(r.bad_share, 9)) for r in got.collect() if r.n_windows} == {k: (n, round(s, 9)) for k, (n, s) in want.items()}
    kept = vb.redundancy_gate(docs, model, 100, limit)
    assert {r.doc_id for r in kept.collect()} == set(ratio_kept(want)) | {900, 901}
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def window_pieces(wins, model):
    """The pieces of the windows' tokens; a window's edge may cut a word."""
    return subword.bpe_pieces(vb.token_rows(wins, [], "text"), model.merges).select("token", "pieces")


def ratio_kept(shares):
    return [k for k, (_, s) in shares.items() if s <= 0.10]


def test_corpus_job_with_a_bpe_model(spark, many):
    """J1 with a subword model: one exchange (the dedup), the documents whose windows pass."""
    from textmill.plans.jobs import process_corpus

    docs, model, _ = many
    own = docs.where("text IS NOT NULL").select("doc_id", F.lit("Pile-CC").alias("subset"), "text")
    plain = process_corpus(own, min_text_length=100, normalize=False)
    wins = plain.select("doc_id", F.posexplode(F.expr("transform(sequence(1, length(text), 100), i -> substring(text, i, 100))")).alias("w", "text")).checkpoint()
    scores = vb.token_char_ratios(wins, ["doc_id", "w"], window_pieces(wins, model))
    limit = scores.agg(F.percentile_approx("ratio", 0.85)).first()[0]
    want = {r.doc_id for r in scores.groupBy("doc_id").agg(F.avg((F.col("ratio") > limit).cast("double")).alias("s")).where("s <= 0.10").collect()}
    gated = process_corpus(own, min_text_length=100, normalize=False, pieces=model, sp_filter_ratio=limit)
    assert {r.doc_id for r in gated.collect()} == want and 0 < len(want) < 250
    assert gated._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
    assert gated._jdf.queryExecution().sparkPlan().toString().count("Exchange") <= 1
