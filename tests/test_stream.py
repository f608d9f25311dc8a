"""Streaming = batch."""

import os

from conftest import SF_SMALL
from textmill.plans import catalog


def test_stream_equals_batch(spark):
    stream = catalog.QUERIES["q_stream_dedup"](spark, SF_SMALL)
    batch = catalog.QUERIES["q_process_corpus_nogates"](spark, SF_SMALL)
    assert sorted(r.hash for r in stream.collect()) == sorted(r.hash for r in batch.collect())


def test_stream_dedup_across_batches(spark, tmp_path):
    from pyspark.sql import functions as F

    from textmill.streaming.incremental import run_stream_dedup

    src = tmp_path / "src"
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(12)]
    for part in range(3):
        spark.createDataFrame(rows[part * 4:(part + 1) * 4], "doc_id long, text string") \
            .coalesce(1).write.parquet(str(src / f"p{part}"))
    schema = spark.read.parquet(str(src / "p0")).schema

    def prepare(s):
        return s.select("doc_id", F.md5("text").alias("hash"))

    out = run_stream_dedup(spark, os.path.join(str(src), "p*"), schema, prepare, order=["doc_id"],
                           name="t_stream", max_files_per_trigger=1, mode="table")
    got = sorted((r.doc_id, r.hash) for r in out.collect())
    assert len(got) == 1 + 8  # one "same text" survivor (the earliest) plus 8 unique texts
    assert got[0][0] == 0
    state = run_stream_dedup(spark, os.path.join(str(src), "p*"), schema, prepare, order=["doc_id"],
                             name="t_stream_state", max_files_per_trigger=1, mode="state")
    assert sorted((r.doc_id, r.hash) for r in state.collect()) == got


def test_batch_writer_replay_is_idempotent(spark, tmp_path):
    from pyspark.sql import functions as F

    from textmill.streaming.incremental import dedup_batch_writer

    out, hashes = str(tmp_path / "out"), str(tmp_path / "hashes")
    write = dedup_batch_writer(out, hashes, order=["doc_id"])
    b0 = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h1")], "doc_id long, hash string")
    b1 = spark.createDataFrame([(4, "h2"), (5, "h3")], "doc_id long, hash string")
    write(b0, 0)
    write(b1, 1)
    write(b1, 1)  # a replayed micro-batch (e.g. after a lost executor / driver restart)
    got = sorted((r.doc_id, r.hash) for r in spark.read.parquet(out).collect())
    assert got == [(1, "h1"), (2, "h2"), (5, "h3")]
    assert spark.read.parquet(hashes).where(F.col("batch_id") == 1).count() == 1


def test_replay_with_partly_visible_hashes_loses_no_row(spark, tmp_path):
    """Only hashes of earlier batches count: a replay that already sees some of its own
    batch's hashes (as a store without atomic renames may show) gives the same output."""
    from textmill.streaming.incremental import dedup_batch_writer

    out, hashes = str(tmp_path / "out"), str(tmp_path / "hashes")
    write = dedup_batch_writer(out, hashes, order=["doc_id"])
    write(spark.createDataFrame([(1, "h1")], "doc_id long, hash string"), 0)
    spark.createDataFrame([("h3", 1)], "hash string, batch_id int").write.mode("append").partitionBy("batch_id").parquet(hashes)
    b1 = spark.createDataFrame([(4, "h1"), (5, "h3"), (6, "h4"), (7, "h5")], "doc_id long, hash string")
    write(b1, 1)
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == [1, 5, 6, 7]
    assert sorted(r.hash for r in spark.read.parquet(hashes).collect()) == ["h1", "h3", "h4", "h5"]


def test_state_goes_on_after_a_restart_and_is_not_reread(spark, tmp_path):
    """Later files meet the state that earlier runs left; nulls, repeated rows, ties and types stay as they are."""
    from textmill.streaming.incremental import run_stream_dedup

    src = str(tmp_path / "src")
    schema = "hash string, doc_id long, note string, score double"
    big = 2**53 + 1

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        out = run_stream_dedup(spark, src, schema, lambda s: s, order=["doc_id", "note"], name=f"t_restart_{tmp_path.name}")
        return sorted(map(tuple, out.collect()), key=repr)

    arrive(("a", big + 1, "x", 0.1), ("a", big, "y", None), ("a", big, None, 2.5), (None, 1, "n", 0.0), ("b", None, 'q"\n\u0001', 1e300), ("b", 0, "z", 1.0))
    first = [("a", big, None, 2.5), ("b", None, 'q"\n\u0001', 1e300), (None, 1, "n", 0.0)]
    assert run() == sorted(first, key=repr)
    assert run() == sorted(first, key=repr)  # nothing new
    arrive(("a", 0, "late", 1.0), (None, 0, "late", 1.0), ("c", 5, "c", -0.5), ("c", 5, "c", -0.5), ("c", 6, "c", 0.0))
    assert run() == sorted([*first, ("c", 5, "c", -0.5)], key=repr)


def test_hot_key_is_combined_before_the_shuffle(spark):
    from textmill.streaming.incremental import _smallest_first

    rows = spark.range(30_000, numPartitions=4).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) hash")
    left = rows.mapInArrow(_smallest_first("hash", ["id"]), rows.schema)
    assert left.where("hash = 'hot'").count() <= 8
    assert left.where("hash <> 'hot'").count() == 20_000
