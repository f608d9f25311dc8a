"""User-facing jobs (J1-J6) composed from the operators.

J1 ``process_corpus`` plan, for a 100 TB input:

1. scan -> source and raw-length gates (pushed into the parquet scan where
   pushable);
2. unknown-token ratio: token lists against the broadcast vocabulary (at most
   2^16 rows by construction), row by row: narrow;
3. cleaning and normalising: one projection of column expressions per row
   (JVM, no Python), behind a generator barrier so no later filter re-runs it;
4. redundancy gate: character windows, narrow like 2; then long-document
   chunking and md5 per row;
5. dedup: a map-side-combined ``min`` per hash, the job's one shuffle of the
   output text, then an anti join with the saved hash list.
"""

from __future__ import annotations

import uuid
from itertools import groupby
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import normalize as nz
from textmill.functions.segment import join_lines, pack_paragraphs, sentence_pack
from textmill.functions.text import let
from textmill.functions.tokens import word_tokens
from textmill.operators import dedup as dd
from textmill.operators import vocab as vb
from textmill.operators.profiles import clean_by_subset, validate_subsets
from textmill.session import checkpoint_dir

ALL_SUBSETS = ["Books3", "Gutenberg (PG-19)", "OpenWebText2", "Pile-CC", "Wikipedia (en)"]


def clean_paragraphs(text, subset, subsets, normalize: bool, chunk_text: bool, text_chunk_size: int) -> Column:
    """C14 -> D25 -> (E9) -> C10: the cleaned paragraph list of one document."""
    paras = clean_by_subset(text, subset, subsets)
    if normalize:
        paras = F.transform(paras, nz.normalize_text)
    if chunk_text:
        paras = pack_paragraphs(paras, text_chunk_size)
    return F.filter(paras, lambda p: F.length(p) > 5)


def chunk_document(text, min_text_length: int, max_text_length: int) -> Column:
    """C3 + E11 + C4: no row if shorter than ``min_text_length``; one row if
    shorter than ``max_text_length``; else sentence-packed chunks of at least
    ``min_text_length`` chars."""

    def body(t):
        n = F.length(t)
        return (F.when(n < min_text_length, F.array().cast("array<string>"))
                .when(n < max_text_length, F.array(t))
                .otherwise(F.filter(sentence_pack(t, max_text_length), lambda c: F.length(c) >= min_text_length)))

    return let(text, body)


def process_corpus(docs: DataFrame, subsets: list[str] | None = None, *, min_text_length: int = 10,
                   max_text_length: int = 1_000_000_000, chunk_text: bool = False, text_chunk_size: int = 1024,
                   max_unk_ratio: float = 0.1, sp_filter_ratio: float = 0.3, vocab: DataFrame | None = None,
                   pieces=None, normalize: bool = True, deduplicate: bool = True,
                   hash_list: DataFrame | None = None,
                   counters: dict | None = None) -> DataFrame:
    """``doc_id, chunk_no, subset, text, hash`` for the kept documents.

    ``docs`` needs ``doc_id, subset, text``.  ``vocab`` enables the unknown
    token cut (C5), ``pieces`` the redundancy gate (C7; a piece table of at most
    2^16 rows, or a BPE model for any vocabulary), ``hash_list`` the
    cross-run dedup (F3).  Pass a dict as ``counters`` to receive B8 run
    counters (``Observation`` objects, filled by the first action on the
    result): ``gated`` documents after C1/C2, ``rows`` before dedup and
    ``emitted`` after it; duplicates = rows - emitted.
    """
    from pyspark.sql import Observation

    def observe(df, name):
        if counters is None:
            return df
        counters[name] = Observation(name)
        return df.observe(counters[name], F.count(F.lit(1)).alias("n"))

    subsets = list(subsets or ALL_SUBSETS)
    validate_subsets(subsets)
    if min_text_length < 1:
        raise ValueError("min_text_length must be >= 1")
    d = docs.select("doc_id", "subset", "text").where(
        F.col("subset").isin(*subsets) & (F.length("text") >= min_text_length))          # C1, C2
    d = observe(d, "gated")
    if vocab is not None:
        d = vb.unk_cut(d, vocab, max_unk_ratio)                                            # C5
    paras = clean_paragraphs(F.col("text"), F.col("subset"), subsets, normalize, chunk_text, text_chunk_size)
    # The generator is a barrier: the cleaned text is computed once per row.
    d = d.select("doc_id", "subset", F.explode(F.array(join_lines(paras))).alias("text"))  # E12
    d = d.where(F.length("text") >= min_text_length)                                       # C3
    if pieces is not None:
        d = vb.redundancy_gate(d, pieces, min_text_length, sp_filter_ratio)                # C7
    out = d.select("doc_id", "subset",
                   F.posexplode(chunk_document(F.col("text"), min_text_length, max_text_length))
                   .alias("chunk_no", "text"))                                              # E11, C4
    out = observe(dd.with_hash(out), "rows")                                               # F1, B8
    if deduplicate:
        out = dd.dedup_exact(out, order=["subset", "doc_id", "chunk_no"])                  # F2
        if hash_list is not None:
            out = dd.drop_known(out, hash_list)                                            # F3
    out = out.select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), "subset", "text", "hash")
    return observe(out, "emitted")


def normalize_corpus(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """The default normaliser chain over one document per row."""
    return lines.withColumn(text_col, nz.normalize_text(F.col(text_col)))


def filter_language(docs: DataFrame, vocab: DataFrame, unk_threshold: float = 0.05, head_chars: int | None = None,
                    text_col: str = "text") -> DataFrame:
    """Keep the documents whose unknown-token share is below the threshold
    (C6); returns the documents that pass, unchanged.  ``head_chars`` scores
    only the first so many characters (C15, the reference's memory guard; off)."""
    return vb.language_filter(docs, vocab, unk_threshold, text_col=text_col, head_chars=head_chars)


# ---------------------------------------------------------------------------
# The genre classifier
# ---------------------------------------------------------------------------

def prepare_books(meta: DataFrame, books: DataFrame, vocab: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Label the metadata (H1), attach the book texts (F6), build the
    vocabulary over all books if none is given (G2) and encode (G3).  Returns
    ``(tokenized, vocab)``; ``tokenized`` has ``book_name, categories, label,
    tokens`` for every fiction and nonfiction book, also those without tokens
    (label 2, unknown, is set aside as in the reference)."""
    from textmill.operators import classify as cl

    labelled = meta.select("book_name", "categories").withColumn("label", cl.label_from_categories("categories"))
    joined = cl.attach_books(labelled.where(F.col("label") != cl.UNKNOWN), books.select("book_name", "text"))
    if vocab is None:
        vocab = vb.build_vocab(books)
    toks = word_tokens(F.coalesce(F.col("text"), F.lit("")))
    ids = vb.Lookup(vocab, "id").column(toks, "array<int>", vb._ids)
    return joined.select("book_name", "categories", "label", ids.alias("tokens")), vocab


def book_vectors(tokenized: DataFrame, size: int = vb.VOCAB_SIZE) -> DataFrame:
    """G6 + G7 of ``tokens``: every row with ``ids`` (its different ids) and ``features`` (one vector over all ids)."""
    from textmill.operators import classify as cl

    pad = F.greatest(F.lit(0), F.lit(vb.VOCAB_SIZE) - F.coalesce(F.size("tokens"), F.lit(0)))
    bow = tokenized.withColumn("_b", cl.bow_column(F.col("tokens"), pad))
    return bow.select(*tokenized.columns, F.col("_b.id").alias("ids"), cl.vector_column(F.col("_b"), size).alias("features"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the session's checkpoint folder and read again, for what is read several times."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def train_genre_model(tokenized: DataFrame, kind: str = "gbt", seed: int = 42, size: int = vb.VOCAB_SIZE, n_features: int | None = None, **kw):
    """BOW features over all ids (G6/G7), exact stratified 80/20 split (H3), the
    ``n_features`` ids that tell the classes of the training part apart best, GBT training (H4),
    predictions on train and test (H5) and their classification reports (G9).
    Returns ``(model, train_report, test_report)``.  The books' vectors are written once: choosing the features,
    the trees' passes over the training part and the reports all read them."""
    from textmill.operators import classify as cl

    split = cl.stratified_split(tokenized.select("book_name", "label", "tokens"), key="book_name", seed=seed)
    data = saved(book_vectors(split, size).drop("book_name", "tokens"), "book-vectors")
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    chosen = cl.select_features(train.select("label", "ids"), n_features or cl.N_FEATURES)
    model = cl.train_classifier(train.select("label", "features"), kind=kind, features=chosen, **kw)
    return (model, cl.classification_report(cl.predict(model, train)),
            cl.classification_report(cl.predict(model, test)))


def predict_genre(lines: DataFrame, model, vocab: DataFrame, key: str = "line_no", text_col: str = "text",
                  size: int = vb.VOCAB_SIZE) -> DataFrame:
    """J6 (H6): encode each line, vectorise, predict, keep the class-1 lines (C16);
    returns the input rows unchanged.  Row by row (no shuffle, no join back); lines without tokens
    are scored, too."""
    from textmill.operators import classify as cl

    row = lines.withColumn("_row", F.struct(*lines.columns)).select("_row", F.col(text_col).alias("_text"))
    feats = cl.document_vectors(row, vocab, "_row", "_text", size)
    return cl.keep_positive(cl.predict(model, feats)).select("_row.*")


# ---------------------------------------------------------------------------
# File-to-file forms of the three command-line jobs (options as parameters)
# ---------------------------------------------------------------------------

def process_corpus_files(spark, input_path: str, output_path: str, deduplicate: str = "", vocab=None,
                         pieces=None, by_subset: bool = False, **options) -> dict:
    """J1 end to end: JSONL documents (A1/A5) -> ``process_corpus`` -> corpus
    JSONL (B1).  As in the reference, rows are deduplicated only when
    ``deduplicate`` names a hash-list folder (B7): loaded if it exists
    (missing -> empty), used for in-run and cross-run dedup, and the run's new
    hashes are appended to it.  Returns the run counters (B8): documents
    gated, rows, emitted, duplicates."""
    from textmill.sources import io

    docs = io.read_documents(spark, input_path)
    hashes = dd.load_hash_list(spark, deduplicate) if deduplicate else None
    counters: dict = {}
    out = process_corpus(docs, vocab=vocab, pieces=pieces, hash_list=hashes, counters=counters,
                         deduplicate=bool(deduplicate), **options)
    if deduplicate:
        # Write once, then derive the new hashes from the written corpus
        # rather than recomputing the job.
        io.write_corpus(out, output_path, by_subset=by_subset)
        written = spark.read.schema("subset string, text string, hash string").json(output_path)
        dd.save_new_hashes(written, deduplicate)
    else:
        io.write_corpus(out, output_path, by_subset=by_subset)
    got = {k: v.get["n"] for k, v in counters.items()}
    got["duplicates"] = got.get("rows", 0) - got.get("emitted", 0)
    return got


def process_shards(spark, input_path: str, output_path: str, deduplicate: bool = True, vocab=None, pieces=None, by_folder: bool = False, **options) -> dict:
    """J1 shard by shard (A5), resumable: every input file under ``input_path`` (a folder or glob) is a shard, or with
    ``by_folder`` all files of a folder, whose corpus goes to ``<output_path>/corpus/shard=<name>`` and its hashes to ``<output_path>/hashes/shard=<name>``.  A shard
    counts as done once its row stands in ``<output_path>/done``, which is written last: a
    run that is started again leaves out the done shards, writes an unfinished one anew, and
    compares with the hashes of done shards only, so it gives what an unbroken run gives.  Shards
    are taken by name.  With ``deduplicate`` a text that an earlier shard (or run) has emitted is dropped.
    Returns the rows emitted by this run, by shard."""
    from textmill.sources import io

    docs = io.read_documents(spark, input_path)
    schema = "shard string, n long"
    done_path, hashes_path = f"{output_path}/done", f"{output_path}/hashes"

    def done() -> DataFrame:
        return spark.read.schema(schema).parquet(done_path) if dd._exists(spark, done_path) else spark.createDataFrame([], schema)

    files = spark.createDataFrame([(unquote(f),) for f in docs.inputFiles()], "file string")  # Spark lists URIs
    name = F.regexp_extract("file", r"([^/]*)/[^/]*$" if by_folder else r"([^/]*?)(\.[^./]*)?$", 1)
    todo = files.select(name.alias("shard"), "file").join(done(), "shard", "left_anti").orderBy("shard").collect()
    emitted: dict = {}
    for shard, group in groupby(todo, key=lambda r: r.shard):
        own = io.read_documents(spark, [r.file for r in group])
        known = None
        if deduplicate and dd._exists(spark, hashes_path):
            known = spark.read.schema("hash string, shard string").parquet(hashes_path).join(F.broadcast(done().select("shard")), "shard", "left_semi").select("hash")
        out = process_corpus(own, vocab=vocab, pieces=pieces, deduplicate=deduplicate, hash_list=known, **options)
        place = quote(shard)
        io.write_corpus(out, f"{output_path}/corpus/shard={place}")
        written = spark.read.schema("subset string, text string, hash string").json(f"{output_path}/corpus/shard={place}")
        written.select("hash").write.mode("overwrite").parquet(f"{hashes_path}/shard={place}")
        emitted[shard] = spark.read.parquet(f"{hashes_path}/shard={place}").count()
        spark.createDataFrame([(shard, emitted[shard])], schema).coalesce(1).write.mode("append").parquet(done_path)
    return emitted


def normalize_files(spark, input_path: str, output_path: str) -> None:
    """J2 end to end: JSON strings (A2) -> normaliser (D25) -> JSON strings (B2)."""
    from textmill.sources import io

    io.write_json_strings(normalize_corpus(io.read_json_strings(spark, input_path)), output_path)


def filter_language_files(spark, input_path: str, output_path: str, vocab, unk_threshold: float = 0.05) -> None:
    """J3 end to end: JSON strings (A2) -> language filter (C6) -> the passing
    input lines, unchanged (B3)."""
    from textmill.sources import io

    lines = io.read_json_strings(spark, input_path)
    kept = filter_language(lines, vocab, unk_threshold)
    io.write_raw_lines(kept, output_path)


def prepare_books_files(spark, metadata_path: str, books_path: str, output_path: str, vocab_path: str) -> dict:
    """J4 end to end: metadata (A4) and text files (A3) -> vocabulary, loaded or
    built over all books and saved (B5) -> tokenised books, one folder per class
    (B4).  Returns the class counts of the metadata (G10, B8)."""
    from textmill.operators import classify as cl
    from textmill.sources import io

    meta, books = io.read_book_metadata(spark, metadata_path), io.read_books(spark, books_path)
    vocab = vb.load_or_build_vocab(books, vocab_path)
    tokenized, _ = prepare_books(meta, books, vocab)
    io.write_tokenized_books(tokenized, output_path)
    labelled = meta.withColumn("label", cl.label_from_categories("categories"))
    return {r.label: r.n_books for r in cl.class_counts(labelled).collect()}


def train_genre_files(spark, tokenized_path: str, model_path: str, **options) -> tuple[DataFrame, DataFrame]:
    """J5 end to end: tokenised books (A6) -> model (H3-H5), saved.
    Returns the train and test reports (G9)."""
    from textmill.operators import classify as cl
    from textmill.sources import io

    model, train, test = train_genre_model(io.read_tokenized_books(spark, tokenized_path), **options)
    cl.save_model(model, model_path)
    return train, test


def predict_genre_files(spark, input_path: str, output_path: str, model_path: str, vocab_path: str) -> None:
    """J6 end to end: JSON strings (A2) -> saved model and vocabulary (B6, B5) ->
    the input lines predicted as class 1, unchanged (B3)."""
    from textmill.operators import classify as cl
    from textmill.sources import io

    lines = io.read_json_strings(spark, input_path)
    model = cl.load_model(model_path)
    kept = predict_genre(lines, model, spark.read.parquet(vocab_path))
    io.write_raw_lines(kept, output_path)
