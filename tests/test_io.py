"""Sources and sinks (A1-A6, B1-B4, B8) as round trips in scratch folders."""

import hashlib
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from textmill.sources import io


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_documents_jsonl(spark):
    d = tempfile.mkdtemp()
    _write(os.path.join(d, "07.jsonl"), "\n".join(json.dumps(o, ensure_ascii=False) for o in [
        {"text": "héllo", "meta": {"pile_set_name": "Pile-CC"}},
        {"text": "b", "meta": {"pile_set_name": "Books3"}, "extra": 1}]) + "\n")
    rows = io.read_documents(spark, d).orderBy("text").collect()
    assert [(r.subset, r.text, r.shard) for r in rows] == [("Books3", "b", "07"), ("Pile-CC", "héllo", "07")]


def test_malformed_and_missing_abort(spark):
    d = tempfile.mkdtemp()
    _write(os.path.join(d, "x.jsonl"), '{"text": "a", "meta": {"pile_set_name": "Books3"}}\n{not json\n')
    with pytest.raises(Exception):
        io.read_documents(spark, d).collect()
    d2 = tempfile.mkdtemp()
    _write(os.path.join(d2, "x.jsonl"), '{"meta": {"pile_set_name": "Books3"}}\n')
    with pytest.raises(Exception):
        io.read_documents(spark, d2).collect()


def test_json_strings_roundtrip(spark):
    d = tempfile.mkdtemp()
    vals = ["a \"quoted\" line\nnext", "ünï", "tab\there"]
    _write(os.path.join(d, "in.jsonl"), "\n".join(json.dumps(v) for v in vals) + "\n")
    df = io.read_json_strings(spark, d)
    assert sorted(r.text for r in df.collect()) == sorted(vals)
    out = os.path.join(tempfile.mkdtemp(), "out")
    io.write_json_strings(df, out)
    back = [json.loads(x) for x in spark.read.text(out).toPandas()["value"]]
    assert sorted(back) == sorted(vals)
    raw_out = os.path.join(tempfile.mkdtemp(), "raw")
    io.write_raw_lines(df.where(F.col("text").startswith("ü")), raw_out)
    assert spark.read.text(raw_out).first()["value"] == json.dumps("ünï")


@pytest.mark.parametrize("line", ['"broken', '"a","b"', '{"x": 1}', "3", "[]", '"a" "b"', "", "null"])
def test_malformed_json_string_aborts(spark, line):
    d = tempfile.mkdtemp()
    _write(os.path.join(d, "x.jsonl"), '"good"\n' + line + "\n")
    with pytest.raises(Exception):
        io.read_json_strings(spark, d).collect()


def test_json_string_keeps_unicode_line_separators(spark):
    text = "a\u2028b\u0085c"
    got = spark.createDataFrame([(text,)], "t string").select(io.json_string("t").alias("j")).first().j
    assert json.loads(got) == text


def test_books_and_metadata(spark):
    d = tempfile.mkdtemp()
    _write(os.path.join(d, "a.txt"), "Once upon a time.\nEnd.")
    _write(os.path.join(d, "b.txt"), "x" * 50)
    books = {r.book_name: r.text for r in io.read_books(spark, d, head_chars=10).collect()}
    assert books == {"a.txt": "Once upon ", "b.txt": "x" * 10}
    assert {r.book_name: len(r.text) for r in io.read_books(spark, d).collect()} == {"a.txt": 22, "b.txt": 50}
    meta = os.path.join(d, "meta.json")
    _write(meta, json.dumps([{"book_name": "a.txt", "categories": ["Fiction", "Fantasy"]},
                             {"book_name": "b.txt", "categories": "Science Fiction"}]))
    m = {r.book_name: (r.categories, r.categories_text) for r in io.read_book_metadata(spark, meta).collect()}
    assert m["a.txt"] == (["Fiction", "Fantasy"], None)
    assert m["b.txt"] == (["Science Fiction"], "Science Fiction")


def test_corpus_and_tokenized_sinks(spark):
    df = spark.createDataFrame([("Books3", "é text", "h1"), ("Pile-CC", "b", "h2")], "subset string, text string, hash string")
    out = os.path.join(tempfile.mkdtemp(), "corpus")
    io.write_corpus(df, out, by_subset=True)
    assert {"subset=Books3", "subset=Pile-CC"} <= set(os.listdir(out))
    lines = open([os.path.join(out, "subset=Books3", f) for f in os.listdir(os.path.join(out, "subset=Books3"))
                  if f.endswith(".json")][0], encoding="utf-8").read()
    assert "é text" in lines
    toks = spark.createDataFrame([("a.txt", ["Fiction"], 1, [0, 5, 7])], "book_name string, categories array<string>, label int, tokens array<int>")
    tout = os.path.join(tempfile.mkdtemp(), "tok")
    io.write_tokenized_books(toks, tout)
    back = io.read_tokenized_books(spark, tout).collect()
    assert back[0].tokens == [0, 5, 7] and back[0].label == 1


def test_counters(spark):
    df = spark.range(10)
    obs_df, obs = io.with_counters(df, "c", rows=F.count(F.lit(1)), even=F.sum((F.col("id") % 2 == 0).cast("int")))
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 10, "even": 5}


def test_empty_book_files_are_books(spark, tmp_path):
    """A3 + G3: a file of zero bytes is a book without tokens, all padding."""
    from textmill.operators import vocab as vb

    for name, text in {"a.txt": "one two", "empty one é+%20.txt": "", "sub.md": "", "none.txt": "", "c d.txt": "x\ny\n"}.items():
        (tmp_path / name).write_text(text)
    books = io.read_books(spark, str(tmp_path))
    assert {r.book_name: r.text for r in books.collect()} == {"a.txt": "one two", "empty one é+%20.txt": "", "none.txt": "", "c d.txt": "x\ny\n"}
    vocab = spark.createDataFrame([("one", 2)], "token string, id int")
    enc = {r.book_name: (r.ids, r.n_pad) for r in vb.encode(books, vocab, "book_name").collect()}
    assert enc["none.txt"] == ([], 65536) and enc["a.txt"] == ([2, 1], 65534)
    only = tmp_path / "only"
    only.mkdir()
    (only / "x.txt").write_text("")
    assert [tuple(r) for r in io.read_books(spark, str(only)).collect()] == [("x.txt", "")]


def test_books_are_written_many_in_a_folder(spark, tmp_path, monkeypatch):
    """A file each, but no folder each; no name comes to the driver where no file is empty."""
    from textmill.plans import catalog

    docs = [(i, None if i == 3 else f"text {i}\n") for i in range(40)]
    spark.createDataFrame([*docs, (7, "again")], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(catalog, "_scratch", lambda s, name: str(tmp_path / name))
    monkeypatch.setattr(catalog, "FOLDER_BOOKS", 10)
    monkeypatch.setattr(type(spark.range(0)), "inputFiles", lambda self: pytest.fail("names were fetched"))
    got = [r.text_md5 for r in catalog.q_read_books(spark, str(tmp_path)).collect()]
    texts = {**{i: t or "" for i, t in docs}, 7: "text 7\n\nagain"}
    assert sorted(got) == sorted(hashlib.md5(f"{t}\n".encode()).hexdigest() for t in texts.values())
    folders = [p for p in (tmp_path / "books").iterdir() if p.is_dir()]
    assert 1 < len(folders) <= 5 and sum(len([f for f in p.iterdir() if f.suffix == ".txt"]) for p in folders) == 40


def test_short_books_are_read_many_in_a_task(spark, tmp_path):
    """By Spark's count of megabytes a file, these would be dozens of tasks; none has a book more or less."""
    texts = {f"{i} é+%20.txt": "" if i == 7 else f"book {i}\n\nline\r\nlast {'x' * (i % 5)}" for i in range(400)}
    for i, (name, text) in enumerate(texts.items()):
        folder = tmp_path / f"folder={i % 3}"
        folder.mkdir(exist_ok=True)
        (folder / name).write_bytes(text.encode())
    books = io.read_books(spark, str(tmp_path))
    assert {r.book_name: r.text for r in books.collect()} == texts and books.count() == 400
    (tmp_path / "folder=1" / "7 é+%20.txt").write_text("full")
    assert io.read_books(spark, str(tmp_path)).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("local, folder_books", [(True, 40), (True, 5), (False, 40)])
def test_books_are_written_as_files_of_their_own(spark, tmp_path, monkeypatch, local, folder_books):
    """One file a book, local ones without checksum files (Hadoop starts processes for these); other stores by Spark's writer."""
    texts = ["one", "", None, "two\nlines\n", " é", *(f"{i}" for i in range(95))]
    rows = [*enumerate(texts), (3, None), (3, "again"), (None, "no id"), (None, "nor here")]
    want = sorted(f"{t}\n".encode() for t in [*(t or "" for k, t in enumerate(texts) if k != 3), "two\nlines\n\n\nagain", "no id\nnor here"])
    if not local:
        monkeypatch.setattr(io, "_local_folder", lambda *a: None)
    path = tmp_path / "books"
    io.write_books(spark.createDataFrame(rows, "id long, text string").coalesce(1), f"file://{path}", "id", folder_books)
    files = [p for p in path.glob("folder=*/*") if p.name.startswith("part-")]
    assert sorted(p.read_bytes() for p in files) == want
    assert all(p.suffix == ".txt" for p in files) and 1 < len(list(path.glob("folder=*"))) <= (3 if folder_books == 40 else 40)
    assert not local or not list(path.rglob("*.crc"))
    assert not local or len(list(path.glob("_attempt-*"))) == 1 or folder_books == 5  # one large partition is dealt out
    assert folder_books == 40 or len(list(path.glob("_attempt-*"))) > 1
    assert sorted(r.text.encode() for r in io.read_books(spark, str(path)).collect()) == want
    with pytest.raises(Exception, match="exist"):
        io.write_books(spark.createDataFrame([(1, "x")], "id long, text string"), str(path), "id", 40)


def test_books_of_other_stores_are_not_taken_for_local(spark, tmp_path):
    assert io._local_folder(spark, str(tmp_path)) == io._local_folder(spark, f"file:{tmp_path}") == str(tmp_path)
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.books.link./in", f"file://{tmp_path}")
    try:
        assert io._local_folder(spark, "viewfs://books/in/x") is None
    finally:
        conf.unset("fs.viewfs.mounttable.books.link./in")


def test_packed_books_are_read_unpacked(spark, tmp_path):
    import gzip

    (tmp_path / "a b.txt.gz").write_bytes(gzip.compress("é one\n".encode()))
    (tmp_path / "c.txt").write_text("two")
    (tmp_path / "none.txt").write_text("")
    assert {r.book_name: r.text for r in io.read_books(spark, str(tmp_path), pattern="*").collect()} == {"a b.txt.gz": "é one\n", "c.txt": "two", "none.txt": ""}
    assert {r.book_name: r.text for r in io.read_books(spark, str(tmp_path), head_chars=2).collect()} == {"c.txt": "tw", "none.txt": ""}
