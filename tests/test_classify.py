"""Classifier operators."""

from pyspark.sql import functions as F

from textmill.operators import classify as cl


def test_labels(spark):
    df = spark.createDataFrame([(["Fiction", "x"],), (["Nonfiction"],), (["Poetry"],), (["Nonfiction", "Fiction"],)],
                               "categories array<string>")
    assert [r.l for r in df.select(cl.label_from_categories("categories").alias("l")).collect()] == [1, 0, 2, 1]


def test_bow(spark):
    counts = spark.createDataFrame([(1, 5, 3), (1, 6, 4), (2, 5, 6000)], "k long, id int, c long")
    got = {(r.k, r.id): round(r.weight, 9) for r in cl.bow_from_counts(counts, "k").collect()}
    assert got == {(1, 5): 0.6, (1, 6): 0.8, (2, 5): 1.0}


def test_bow_keeps_documents_without_tokens(spark):
    vocab = spark.createDataFrame([("a", 2)], "token string, id int")
    docs = spark.createDataFrame([(1, "a a"), (2, ""), (3, None)], "doc_id long, text string")
    got = {(r.doc_id, r.id) for r in cl.bow_long(docs, vocab).collect()}
    assert got == {(1, 2), (1, 0), (2, 0), (3, 0)}
    vectors = {r.doc_id: r.features for r in cl.bow_vectors(cl.bow_long(docs, vocab)).collect()}
    assert vectors[2].size == 65536 and vectors[2][0] == 1.0


def test_report_from_published_confusion(spark):
    rows = [(0, 0)] * 775 + [(0, 1)] * 49 + [(1, 0)] * 37 + [(1, 1)] * 2406
    pred = spark.createDataFrame(rows, "label int, prediction int")
    rep = {r.row: (r.precision, r.recall, r.f1, r.support) for r in cl.classification_report(pred).collect()}
    assert rep["0"] == (0.954, 0.941, 0.947, 824)
    assert rep["1"] == (0.98, 0.985, 0.982, 2443)
    assert rep["accuracy"][2] == 0.974 and rep["accuracy"][3] == 3267
    assert rep["macro avg"][:3] == (0.967, 0.963, 0.965)
    assert rep["weighted avg"][:3] == (0.974, 0.974, 0.974)


def test_stratified_split_is_exact(spark):
    df = spark.range(0, 103).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    s = cl.stratified_split(df, seed=42).groupBy("label").agg(F.sum(F.col("is_test").cast("int")).alias("t"),
                                                              F.count(F.lit(1)).alias("n"))
    for r in s.collect():
        assert r.t == round(0.2 * r.n)
    again = cl.stratified_split(df, seed=42).where("is_test").select("doc_id")
    assert sorted(x.doc_id for x in again.collect()) == \
        sorted(x.doc_id for x in cl.stratified_split(df, seed=42).where("is_test").collect())


def test_train_predict(spark):
    from pyspark.ml.linalg import Vectors

    data = [(i, Vectors.sparse(4, [0, 1], [1.0, 0.0]) if i % 2 else Vectors.sparse(4, [2], [1.0]), i % 2)
            for i in range(40)]
    df = spark.createDataFrame(data, ["doc_id", "features", "label"])
    model = cl.train_classifier(df, kind="logreg")
    pred = cl.predict(model, df)
    assert pred.where(F.col("prediction") != F.col("label")).count() == 0
    assert cl.keep_positive(pred).count() == 20


def test_vectors_need_no_shuffle(spark):
    vocab = spark.createDataFrame([("a", 2), ("b", 3)], "token string, id int")
    docs = spark.createDataFrame([(1, "a a b x"), (2, ""), (3, None), (None, "b " * 70_000 + "a " * 6000)], "doc_id long, text string")
    vectors = cl.document_vectors(docs, vocab)
    assert "Exchange" not in vectors._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: {int(i): round(float(w), 9) for i, w in zip(r.features.indices, r.features.values)} for r in vectors.collect()}
    n = (5000**2 + 4 + 1 + 1) ** 0.5
    assert got[1] == {0: round(5000 / n, 9), 1: round(1 / n, 9), 2: round(2 / n, 9), 3: round(1 / n, 9)}
    assert got[2] == got[3] == {0: 1.0}
    assert got[None] == {2: round(0.5**0.5, 9), 3: round(0.5**0.5, 9)}
    long = {(r.doc_id, r.id): round(r.weight, 9) for r in cl.bow_long(docs, vocab).collect()}
    assert long == {(k, i): w for k, v in got.items() for i, w in v.items()}
    assert cl.document_vectors(docs.limit(0), vocab).collect() == []


def test_split_equals_a_sort_and_moves_no_row(spark):
    import hashlib

    rows = [(k, None if k % 11 == 0 else k % 3, "payload") for k in range(5000)] + [(9000, 7, "alone"), (9001, 8, "x"), (9002, 8, "y"), (9003, 8, "z")]
    df = spark.createDataFrame(rows, "doc_id long, label int, text string")
    split = cl.stratified_split(df)
    want = set()
    for label in {r[1] for r in rows}:
        own = sorted((hashlib.md5(f"{k}:42".encode()).hexdigest(), k) for k, y, _ in rows if y == label)
        want |= {k for _, k in own[: int(0.2 * len(own) + 0.5)]}
    assert {r.doc_id for r in split.where("is_test").collect()} == want
    assert split.count() == len(rows) and split.columns == [*df.columns, "is_test"]
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    twice = cl.stratified_split(df.union(df).where("label = 7"), test_size=0.5)
    assert twice.where("is_test").count() == 2  # rows that repeat a key stay together
    assert cl.stratified_split(df.limit(0)).collect() == []


def test_features_that_tell_classes_apart(spark):
    rows = [(k % 2, [0, 5, 6 if k % 2 else 7, 8 if k % 4 == 1 else 9, 6]) for k in range(40)]
    df = spark.createDataFrame(rows, "label int, ids array<int>")

    def chi2(i):
        n, n1 = len(rows), sum(y for y, _ in rows)
        a, m = sum(y for y, ids in rows if i in ids), sum(i in ids for _, ids in rows)
        if m in (0, n):
            return 0
        return sum((o - e) ** 2 / e for o, e in ((a, m * n1 / n), (m - a, m * (n - n1) / n), (n1 - a, (n - m) * n1 / n), (n - n1 - m + a, (n - m) * (n - n1) / n)))

    want = sorted((i for i in range(10) if chi2(i) > 0), key=lambda i: (-chi2(i), i))
    assert cl.select_features(df) == sorted(want) and want[0] == 7
    assert cl.select_features(df, 1) == [7]
    assert cl.select_features(df.where("label = 1")) == [0]  # nothing to tell apart


def test_genre_model_learns_separable_books(spark, tmp_path):
    """Unseen books of two vocabularies: the test report beats the larger class's share."""
    import random

    from textmill.plans.jobs import predict_genre, train_genre_model

    rng = random.Random(1)
    rows = [(f"b{k}", int(k % 3 == 0), [rng.randint(2, 60) for _ in range(30)] + [rng.choice([900, 901, 60_000] if k % 3 == 0 else [902, 903, 904])]) for k in range(200)]
    model, train, test = train_genre_model(spark.createDataFrame(rows, "book_name string, label int, tokens array<int>"), max_iter=5, n_features=20)
    share = {r.row: r for r in test.collect()}
    assert share["0"].support + share["1"].support == share["accuracy"].support == round(0.2 * 67) + round(0.2 * 133)
    assert share["accuracy"].f1 >= 0.95 > share["0"].support / share["accuracy"].support
    cl.save_model(model, str(tmp_path / "model"))
    vocab = spark.createDataFrame([("u", 900), ("v", 902)], "token string, id int")
    lines = spark.createDataFrame([(1, "u", "kept"), (2, "v", None), (3, None, "x")], "line_no long, text string, features string")
    kept = predict_genre(lines, cl.load_model(str(tmp_path / "model")), vocab)
    assert [tuple(r) for r in kept.collect()] == [(1, "u", "kept")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
