"""The genre job reads each text once for the training and the reports."""

from pyspark.sql import functions as F

from textmill.operators import classify as cl
from textmill.plans.jobs import train_genre_model


def test_training_encodes_each_book_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def tokens(k):
        seen.add(1)
        return [2 + k % 7, 900 + k % 2]

    books = spark.range(60).select(F.concat(F.lit("b"), "id").alias("book_name"), (F.col("id") % 2).cast("int").alias("label"), tokens("id").alias("tokens"))
    _, train, test = train_genre_model(books, max_iter=2, n_features=8)
    by_row = {r.row: r.support for r in train.union(test).where("row = 'accuracy'").collect()}
    assert set(by_row) == {"accuracy"} and test.where("row = '0'").first().f1 == 1.0
    assert seen.value == 60


def test_report_makes_the_predictions_once(spark):
    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1), (None, 0), (None, 0), (1, None)], "label int, prediction int")
    report = cl.classification_report(pred)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and "Join" not in plan and "Union" not in plan
    got = sorted((str(r.row), r.precision, r.recall, r.f1, r.support) for r in report.collect())
    assert got == sorted([("0", 0.333, 0.5, 0.4, 2), ("1", 0.5, 0.667, 0.571, 3), ("2", 0.0, 0.0, 0.0, 1),
                          ("None", 0.0, 0.0, 0.0, 2), ("None", 0.0, 0.0, 0.0, 0), ("accuracy", None, None, 0.375, 8),
                          ("macro avg", 0.167, 0.233, 0.194, 8), ("weighted avg", 0.271, 0.375, 0.314, 8)])
    assert [r.row for r in cl.classification_report(pred.limit(0)).collect()] == ["accuracy", "macro avg", "weighted avg"]
