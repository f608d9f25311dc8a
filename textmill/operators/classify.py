"""Book-genre style document classifier.

Features are bag-of-words counts over the word vocabulary, clipped and L2-normalised.  They
are made where the ids are: a row's ids are sorted and run-length counted in Arrow batches
(``bow_column``), so neither the long form (``doc_id, id, weight``) nor the vectors need a
shuffle.  The stratified split is exact without a sort: a histogram of hash prefixes is
refined to the k-th hash of each label, then a narrow comparison marks the rows.  Training
keeps the ids that tell the classes apart best (chi-square of presence counts, a distributed
aggregate) and hands them to Spark ML (gradient-boosted trees or logistic regression).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators import vocab as vb
from textmill.session import checkpoint_dir

FICTION, NONFICTION, UNKNOWN = 1, 0, 2
BOW_CLIP = 5000
#: Ids that the trees see (at most), and labels that a split may have.
N_FEATURES, MAX_LABELS = 1024, 1000


def label_from_categories(categories) -> F.Column:
    """H1: ``Fiction`` in the categories -> 1, else ``Nonfiction`` -> 0, else 2."""
    c = F.col(categories) if isinstance(categories, str) else categories
    return (F.when(F.array_contains(c, "Fiction"), F.lit(FICTION))
            .when(F.array_contains(c, "Nonfiction"), F.lit(NONFICTION))
            .otherwise(F.lit(UNKNOWN)))


def split_by_label(meta: DataFrame, label_col: str = "label") -> tuple[DataFrame, DataFrame, DataFrame]:
    """H2: (nonfiction, fiction, unknown)."""
    return tuple(meta.where(F.col(label_col) == v) for v in (NONFICTION, FICTION, UNKNOWN))


def class_counts(meta: DataFrame, label_col: str = "label") -> DataFrame:
    """Books per class."""
    return meta.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_books"))


def attach_books(meta: DataFrame, books: DataFrame, on: str = "book_name") -> DataFrame:
    """metadata <-> book text by file name (inner equi-join)."""
    return meta.join(books, on, "inner")


def concat_labelled(fiction: DataFrame, nonfiction: DataFrame, label_col: str = "label") -> DataFrame:
    """F8: the two class sets with constant labels, concatenated."""
    return (fiction.withColumn(label_col, F.lit(FICTION))
            .unionByName(nonfiction.withColumn(label_col, F.lit(NONFICTION))))


def bow_long(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text_col: str = "text", clip: int = BOW_CLIP) -> DataFrame:
    """G6 in long form: ``key, id, weight`` (see ``bow_from_ids``)."""
    return bow_from_ids(vb.encode(docs, vocab, key, text_col), key, clip)


def bow_column(ids: Column, n_pad: Column, clip: int = BOW_CLIP) -> Column:
    """G6 of one row, without a shuffle: ``struct<id, weight>`` of two arrays, by id.  Counts per id with the
    left padding counted as id 0 (never materialised), clipped at ``clip``, L2-normalised.  A row
    without ids is all padding: weight 1 at id 0."""

    def own(lists: pa.ListArray, pads: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        pad = pc.fill_null(pads, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        padded = np.flatnonzero(pad > 0)
        row = np.concatenate([np.repeat(np.arange(len(sizes)), sizes), padded])
        key = (row << 32) | np.concatenate([pc.fill_null(lists.flatten(), vb.UNK_ID).to_numpy(zero_copy_only=False).astype(np.int64), np.full(len(padded), vb.PAD_ID)])
        key, at = np.unique(key, return_inverse=True)
        count = np.bincount(at, weights=np.concatenate([np.ones(int(sizes.sum())), pad[padded]]), minlength=len(key))
        row, c = key >> 32, np.minimum(count, clip)
        norm = np.sqrt(np.bincount(row, weights=c * c, minlength=len(sizes)))
        offs = pa.array(np.searchsorted(row, np.arange(len(sizes) + 1)).astype(np.int32))
        parts = [(key & 0xFFFFFFFF).astype(np.int32), c / norm[row]]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offs, pa.array(x)) for x in parts], names=["id", "weight"])

    @F.arrow_udf("struct<id:array<int>,weight:array<double>>")
    def run(lists: pa.Array, pads: pa.Array) -> pa.Array:
        return vb.in_slices(own, pa.concat_arrays([lists]), pads)

    return run(ids, n_pad)


def bow_from_ids(encoded: DataFrame, key: str = "doc_id", clip: int = BOW_CLIP) -> DataFrame:
    """G6 from ``key, ids, n_pad`` in long form (see ``bow_column``)."""
    bow = encoded.select(key, bow_column(F.col("ids"), F.col("n_pad"), clip).alias("b"))
    pairs = F.arrays_zip(F.col("b.id").alias("id"), F.col("b.weight").alias("weight"))
    return bow.select(key, F.explode(pairs).alias("p")).select(key, "p.id", "p.weight")


def bow_from_counts(counts: DataFrame, key: str, clip: int = BOW_CLIP) -> DataFrame:
    """G6 from ``key, id, c`` counts: clip, then L2-normalise per document."""
    c = F.least(F.col("c"), F.lit(clip)).cast("double")
    clipped = counts.select(key, F.col("id").cast("int").alias("id"), c.alias("c"))
    norm = F.sqrt(F.sum(F.col("c") * F.col("c")).over(Window.partitionBy(key)))
    return clipped.select(key, "id", (F.col("c") / norm).alias("weight"))


@F.arrow_udf(VectorUDT())
def _sparse(size: pa.Array, ids: pa.Array, ws: pa.Array) -> pa.Array:
    """One sparse ML vector per document, the id and weight lists as they are (Spark SQL cannot build a UDT value)."""
    kind = pa.array(np.zeros(len(ids), np.int8))
    return pa.StructArray.from_arrays([kind, size, ids, ws], names=["type", "size", "indices", "values"])


def vector_column(bow: Column, size: int = vb.VOCAB_SIZE) -> Column:
    """G7 of one row: the sparse vector over ``size`` ids of a ``bow_column``."""
    return _sparse(F.lit(size), bow["id"], bow["weight"])


def document_vectors(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text_col: str = "text", size: int = vb.VOCAB_SIZE) -> DataFrame:
    """G3 + G6 + G7: ``key, features`` of every text, row by row."""
    bow = vb.encode(docs, vocab, key, text_col).select(key, bow_column(F.col("ids"), F.col("n_pad")).alias("b"))
    return bow.select(key, vector_column(F.col("b"), size).alias("features"))


def bow_vectors(long: DataFrame, size: int = vb.VOCAB_SIZE, key: str = "doc_id") -> DataFrame:
    """G7 from the long form: one sparse vector over all ``size`` ids per document (``key,
    features``); ``document_vectors`` makes them without the shuffle."""
    packed = long.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("id", "weight"))).alias("p"))
    return packed.select(key, _sparse(F.lit(size), F.col("p.id"), F.col("p.weight")).alias("features"))


def _last_of_test(rows: DataFrame, test_size: float) -> dict:
    """By label: a text that the hashes of the ``round(test_size * n)`` first rows precede, and no others.

    ``rows`` has ``y, h`` (hex hashes).  Counts by the first four digits give the bin in which the last
    such row lies, four more digits of that bin the next, until a bin ends with it."""
    sizes = rows.groupBy("y").agg(F.round(F.count(F.lit(1)) * F.lit(test_size)).cast("long").alias("k")).limit(MAX_LABELS + 1).collect()
    if len(sizes) > MAX_LABELS:
        raise ValueError(f"a split may have at most {MAX_LABELS} labels")
    found, left, prefix, width = {r.y: "" for r in sizes}, {r.y: r.k for r in sizes if r.k}, {r.y: "" for r in sizes}, 0
    while left:
        width += 4
        y = F.col("y")
        mine = [(y.eqNullSafe(F.lit(v)), v) for v in left]
        inside, k = F.lit(False), F.lit(None).cast("long")
        for same, v in mine:
            inside, k = inside | (same & F.col("h").startswith(prefix[v])), F.when(same, left[v]).otherwise(k)
        bins = rows.where(inside).groupBy("y", F.substring("h", 1, width).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        upto = bins.withColumn("upto", F.sum("n").over(Window.partitionBy("y").orderBy("p")))
        for r in upto.where(F.col("upto") >= k).groupBy("y").agg(F.min(F.struct("p", "n", "upto")).alias("b")).collect():
            prefix[r.y], rest = r.b.p, left[r.y] - (r.b.upto - r.b.n)
            if rest == r.b.n or width >= 32:
                found[r.y] = r.b.p + "g"  # behind every hash that begins so
                del left[r.y]
            else:
                left[r.y] = rest
    return found


def stratified_split(df: DataFrame, label_col: str = "label", key: str = "doc_id", test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """H3: adds ``is_test``: per label, the ``round(test_size * n)`` rows with the smallest ``md5(key:seed)`` go
    to the test set (exact, reproducible; rows that repeat a key stay together).  Only labels and hashes
    are counted; no row is sorted, moved or written."""
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    found = _last_of_test(df.select(F.col(label_col).alias("y"), h.alias("h")), test_size)
    is_test = F.lit(False)
    for label, end in found.items():
        is_test = F.when(F.col(label_col).eqNullSafe(F.lit(label)), h < F.lit(end)).otherwise(is_test)
    return df.withColumn("is_test", is_test)


def select_features(rows: DataFrame, n_features: int = N_FEATURES, ids_col: str = "ids", label_col: str = "label") -> list[int]:
    """The ids whose presence tells class 1 from the others best: the ``n_features`` largest chi-square values
    of (id, label) document counts (ties by id; without any difference, the pad id), in order."""
    y = F.col(label_col) == FICTION
    n, n1 = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(y.cast("long")), F.lit(0))).first()
    seen = (rows.select(y.alias("y"), F.explode(F.array_distinct(ids_col)).alias("id")).groupBy("id")
            .agg(F.sum(F.col("y").cast("long")).cast("double").alias("a"), F.count(F.lit(1)).cast("double").alias("m")))
    # (n (a (n0 - b) - b (n1 - a))^2) / (m (n - m) n1 n0) with b = m - a
    off = F.col("a") * F.lit(float(n)) - F.col("m") * F.lit(float(n1))
    chi2 = F.try_divide(off * off * F.lit(float(n)), F.col("m") * (F.lit(float(n)) - F.col("m")) * F.lit(float(n1)) * F.lit(float(n - n1)))
    top = seen.select("id", F.coalesce(chi2, F.lit(0.0)).alias("chi2")).where("chi2 > 0").orderBy(F.desc("chi2"), "id").limit(n_features).collect()
    return sorted(r.id for r in top) or [vb.PAD_ID]


def train_classifier(train: DataFrame, label_col: str = "label", kind: str = "gbt", seed: int = 123,
                     max_iter: int = 20, features: list[int] | None = None) -> PipelineModel:
    """H4: gradient-boosted trees (log-loss), or logistic regression as a fast baseline; over the ids of
    ``features`` only (the model takes whole vectors and picks them), or over all."""
    stages, column = [], "features"
    if features is not None:
        stages, column = [VectorSlicer(inputCol="features", outputCol="selected", indices=features)], "selected"
    if kind == "gbt":
        est = GBTClassifier(featuresCol=column, labelCol=label_col, seed=seed, maxIter=max_iter)
    else:
        est = LogisticRegression(featuresCol=column, labelCol=label_col, maxIter=max_iter)
    model = Pipeline(stages=[*stages, est]).fit(train.withColumn(label_col, F.col(label_col).cast("double")))
    if kind == "gbt":
        return model
    # A fitted regression holds its training summary, and with it the session, which can't be sent
    # to tasks once the session has run counters (Observation); the saved model has none.
    path = f"{checkpoint_dir(train.sparkSession)}/model-{uuid.uuid4().hex}"
    save_model(model, path)
    return load_model(path)


def predict(model: PipelineModel, feats: DataFrame) -> DataFrame:
    """H5: adds ``prediction`` (0/1 as int)."""
    out = model.transform(feats)
    return out.withColumn("prediction", F.col("prediction").cast("int"))


def keep_positive(pred: DataFrame) -> DataFrame:
    """Rows predicted as class 1."""
    return pred.where(F.col("prediction") == 1)


def classification_report(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """Per-class precision / recall / F1 / support, then accuracy, macro and
    weighted averages (rounded to 3 digits), from one confusion-count aggregate.

    Columns: ``row, precision, recall, f1, support``.
    """
    conf = pred.groupBy(F.col(label_col).cast("int").alias("y"), F.col(pred_col).cast("int").alias("p")) \
               .agg(F.count(F.lit(1)).alias("n"))
    # Both sides of each count in one go, so that the predictions are made once (rows without a class stay apart).
    sides = conf.select("y", "p", "n", F.explode(F.array(F.lit("y"), F.lit("p"))).alias("side"))
    c, of_y, of_p = F.when(F.col("side") == "y", F.col("y")).otherwise(F.col("p")), F.col("side") == "y", F.col("side") == "p"
    per = (sides.withColumn("c", c).groupBy("c", F.when(F.col("c").isNull(), F.col("side")).alias("_no"))
           .agg(*[F.coalesce(F.sum(F.when(x, F.col("n"))), F.lit(0)).alias(name)
                  for name, x in (("tp", of_y & (F.col("y") == F.col("p"))), ("pp", of_p), ("support", of_y))]))
    per = (per.withColumn("precision", F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(0.0))
              .withColumn("recall", F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0))
              .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                       2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                          .otherwise(0.0)))
    r3 = lambda c: F.round(c, 3)

    def line(row, precision, recall, f1, support):
        return F.struct(row.cast("string").alias("row"), r3(precision).alias("precision"), r3(recall).alias("recall"),
                        r3(f1).alias("f1"), support.cast("long").alias("support"))

    own = line(*[F.col(x) for x in ("c", "precision", "recall", "f1", "support")])
    tot = per.agg(F.collect_list(own).alias("own"), F.sum("support").alias("N"), F.sum("tp").alias("TP"), F.count(F.lit(1)).alias("K"),
                  F.sum("precision").alias("sp"), F.sum("recall").alias("sr"), F.sum("f1").alias("sf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    over = lambda total, *sums: [F.try_divide(F.col(x), F.col(total)) for x in sums]
    summary = F.array(line(F.lit("accuracy"), F.lit(None).cast("double"), F.lit(None).cast("double"), *over("N", "TP"), F.col("N")),
                      line(F.lit("macro avg"), *over("K", "sp", "sr", "sf"), F.col("N")),
                      line(F.lit("weighted avg"), *over("N", "wp", "wr", "wf"), F.col("N")))
    return tot.select(F.inline(F.concat("own", summary)))


def save_model(model: PipelineModel, path: str) -> None:
    """B6."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """B6."""
    return PipelineModel.load(path)


BOOK_META_SCHEMA = T.StructType([T.StructField("book_name", T.StringType()),
                                 T.StructField("categories", T.ArrayType(T.StringType()))])
