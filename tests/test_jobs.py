"""Dedup (F1-F5, B7) and the corpus job J1: fixtures and invariants."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from textmill.operators import dedup as dd
from textmill.plans.jobs import process_corpus
from textmill.sources.tables import docs_markup


def test_md5(one):
    assert one(F.md5, "é") == "66ddcd97cfdeabb2f6fb8a999b4bc76f"


def test_dedup_and_known_list(spark):
    df = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h1")], "doc_id long, hash string")
    uniq = dd.dedup_exact(df, order=["doc_id"])
    assert sorted((r.hash, r.doc_id) for r in uniq.collect()) == [("h1", 1), ("h2", 2)]
    known = spark.createDataFrame([("h2",)], "hash string")
    out = dd.drop_known(uniq, known)
    assert [(r.hash, r.doc_id) for r in out.collect()] == [("h1", 1)]
    assert dd.duplicate_count(df, out) == 2
    assert sorted(r.hash for r in dd.union_hashes(known, out).collect()) == ["h1", "h2"]


def test_hash_list_roundtrip(spark):
    path = os.path.join(tempfile.mkdtemp(), "hashes")
    assert dd.load_hash_list(spark, path).count() == 0
    dd.save_new_hashes(spark.createDataFrame([("a",), ("b",)], "hash string"), path)
    dd.save_new_hashes(spark.createDataFrame([("c",)], "hash string"), path)
    assert sorted(r.hash for r in dd.load_hash_list(spark, path).collect()) == ["a", "b", "c"]


def _run(spark, **kw):
    docs = docs_markup(spark, SF_SMALL)
    return process_corpus(docs, min_text_length=200, max_text_length=1500, chunk_text=True, text_chunk_size=512,
                          **kw)


def test_corpus_invariants(spark):
    out = _run(spark).cache()
    rows = out.collect()
    assert rows, "the job keeps some documents"
    assert all(len(r.text) >= 200 for r in rows)
    assert len({r.hash for r in rows}) == len(rows)
    assert out.where(F.md5("text") != F.col("hash")).count() == 0
    # re-running with the run's own hash list emits nothing
    again = _run(spark, hash_list=out.select("hash"))
    assert again.count() == 0


def test_corpus_rejects_bad_options(spark):
    import pytest

    docs = docs_markup(spark, SF_SMALL)
    with pytest.raises(ValueError):
        process_corpus(docs, ["Unknown source"])
    with pytest.raises(ValueError):
        process_corpus(docs, min_text_length=0)


def test_corpus_counters(spark):
    counters = {}
    out = process_corpus(docs_markup(spark, SF_SMALL), min_text_length=200, max_text_length=1500,
                         counters=counters)
    n = out.count()
    gated, rows, emitted = (counters[k].get["n"] for k in ("gated", "rows", "emitted"))
    assert emitted == n and rows >= emitted and gated > 0


def test_file_jobs(spark, tmp_path):
    import json

    from textmill.plans.jobs import filter_language_files, normalize_files, process_corpus_files

    src = tmp_path / "in"
    src.mkdir()
    body = "This is a clean sentence with plenty of words. " * 8
    docs = [{"text": body + f"Number {i}.", "meta": {"pile_set_name": "Pile-CC"}} for i in range(3)]
    docs.append(docs[0])  # an exact duplicate
    (src / "00.jsonl").write_text("\n".join(json.dumps(d) for d in docs) + "\n")
    hashes = str(tmp_path / "hashes")
    c1 = process_corpus_files(spark, str(src), str(tmp_path / "out1"), deduplicate=hashes, min_text_length=50)
    assert c1["emitted"] == 3 and c1["duplicates"] == 1
    c2 = process_corpus_files(spark, str(src), str(tmp_path / "out2"), deduplicate=hashes, min_text_length=50)
    assert c2["emitted"] == 0 and c2["duplicates"] == 4
    c3 = process_corpus_files(spark, str(src), str(tmp_path / "out3"), min_text_length=50)  # no hash list: no dedup
    assert c3["emitted"] == 4 and c3["duplicates"] == 0

    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.jsonl").write_text(json.dumps("«Hi» — there…") + "\n" + json.dumps("the the the") + "\n")
    normalize_files(spark, str(lines), str(tmp_path / "norm"))
    got = sorted(json.loads(x) for x in spark.read.text(str(tmp_path / "norm")).toPandas()["value"])
    assert got == ['"Hi" - there...', "the the the"]
    vocab = spark.createDataFrame([("<pad>", 0, 0), ("<unk>", 1, 0), ("the", 2, 9)], "token string, id int, freq long")
    filter_language_files(spark, str(lines), str(tmp_path / "lang"), vocab)
    kept = [r.value for r in spark.read.text(str(tmp_path / "lang")).collect()]
    assert kept == [json.dumps("the the the")]


def test_corpus_plan_moves_text_only_for_dedup(spark):
    """The only exchange in J1's plan is the dedup shuffle by hash, with both gates on
    (broadcasts off, as for a large input), and AQE stays on."""
    from textmill.operators.vocab import build_vocab, piece_table
    from textmill.sources.tables import table

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vocab = build_vocab(table(spark, SF_SMALL, "documents").where(F.col("lang") == "en"))
        out = process_corpus(docs_markup(spark, SF_SMALL), min_text_length=200, vocab=vocab, pieces=piece_table(vocab))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    exchanges = [ln for ln in plan.splitlines() if "Exchange" in ln]
    assert len(exchanges) == 1 and "hashpartitioning(hash" in exchanges[0], plan


def test_book_files_end_to_end(spark, tmp_path):
    """A3, A4 -> J4 -> B4, B5 -> A6 -> J5 -> B6 -> A2 -> J6 -> B3."""
    import json

    from textmill.plans.jobs import predict_genre_files, prepare_books_files, train_genre_files

    books = tmp_path / "books"
    books.mkdir()
    meta = []
    for k in range(40):
        genre = ["Fiction", "Nonfiction"][k % 2]
        text = ("dragon castle magic sword " if k % 2 == 0 else "method result table figure ") * (5 + k % 3)
        (books / f"b{k}.txt").write_text(" \n" if k == 6 else text)
        meta.append({"book_name": f"b{k}.txt", "categories": [genre, "x"] if k % 3 else genre})
    meta.append({"book_name": "missing.txt", "categories": "Fiction"})
    meta.append({"book_name": "b0.txt", "categories": "Poetry"})
    (tmp_path / "meta.json").write_text(json.dumps(meta))
    out, vocab, model = (str(tmp_path / x) for x in ("tokens", "vocab", "model"))
    counts = prepare_books_files(spark, str(tmp_path / "meta.json"), str(books), out, vocab)
    assert counts == {0: 20, 1: 21, 2: 1}
    from textmill.sources import io

    back = {r.book_name: (r.label, r.tokens) for r in io.read_tokenized_books(spark, out).collect()}
    assert len(back) == 40 and back["b6.txt"] == (1, []) and back["b1.txt"][0] == 0 and len(back["b1.txt"][1]) == 24
    train, test = train_genre_files(spark, out, model, kind="logreg")
    assert {r.row: r.support for r in test.collect()}["accuracy"] == 8
    lines = tmp_path / "lines"
    lines.mkdir()
    raw = [json.dumps(t) for t in ("dragon castle magic sword " * 6, "method result table figure " * 6, "")]
    (lines / "a.jsonl").write_text("\n".join(raw) + "\n")
    predict_genre_files(spark, str(lines), str(tmp_path / "kept"), model, vocab)
    kept = {r.value for r in spark.read.text(str(tmp_path / "kept")).collect()}
    assert raw[1] not in kept and raw[0] in kept and kept <= set(raw)


def test_hash_list_in_buckets_is_not_shuffled(spark, tmp_path):
    """F3 + B7: the corpus job's dedup deals the rows like the saved list; the anti join moves neither."""
    import re

    path = str(tmp_path / "hash's list")
    df = spark.createDataFrame([(k, f"text {k % 700}") for k in range(2000)] + [(5000, None)], "doc_id long, text string")
    dd.save_new_hashes(dd.with_hash(df).where("doc_id < 300 OR text IS NULL").distinct(), path)
    dd.save_new_hashes(dd.with_hash(df).where("doc_id BETWEEN 300 AND 399"), path)
    known = dd.load_hash_list(spark, path)
    assert known.columns == ["hash"] and known.count() == 400
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = dd.drop_known(dd.dedup_exact(dd.with_hash(df), order=["doc_id"]), known)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Bucketed: true" in plan
        got = sorted((r.doc_id for r in new.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [*range(400, 700), 5000]
    other = spark.newSession()  # the layout is found again by its path
    assert dd.load_hash_list(other, path).count() == 400
    plain = str(tmp_path / "plain")
    spark.createDataFrame([("a",)], "hash string").write.parquet(plain)
    dd.save_new_hashes(spark.createDataFrame([("b",), (None,)], "hash string"), plain)
    assert sorted(r.hash for r in dd.load_hash_list(spark, plain).collect()) == ["a", "b"]
