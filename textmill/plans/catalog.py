"""Query catalogue: one Spark query and (where SQL can say it) one DuckDB
oracle per operator of the inventory.

Every query reads the driver's tables (or ``docs_markup``, which Spark
derives from ``documents``) in full.  Vocabularies are trained on all
documents, except where "is it English" is the question (``english_vocab``:
the unknown-token cut, the language filter and the corpus job).  Array results are exploded to rows
(``*_no`` positions are 0-based) so that both engines return flat tables
with the same column names.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import normalize as nz
from textmill.functions import segment as sg
from textmill.functions import text as tx
from textmill.functions.tokens import word_tokens
from textmill.operators import profiles as pr
from textmill.operators import vocab as vb
from textmill.functions import rx
from textmill.operators import dedup as dd
from textmill.operators import classify as cl
from textmill.plans.jobs import (filter_language, filter_language_files, normalize_files, predict_genre, prepare_books, process_corpus,
                                 saved, train_genre_model)
from textmill.plans import duck as dk
from textmill.sources import io
from textmill.sources.tables import book_files, book_metadata, book_metadata_duckdb, docs_markup, docs_markup_duckdb, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MARKUP = f"({docs_markup_duckdb()}) AS m"

# Query parameters (FIXTURES.md §3).
MIN_LEN, MAX_LEN, CHUNK = 500, 4000, 1024
GATE_SUBSETS = ["Books3", "OpenWebText2", "Wikipedia (en)"]


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _explode(df: DataFrame, keys: list[str], arr, pos: str, val: str) -> DataFrame:
    return (df.select(*keys, F.posexplode(arr).alias(pos, val))
            .withColumn(pos, F.col(pos).cast("long")))


def _duck_explode(keys: str, arr_sql: str, pos: str, val: str, src: str) -> str:
    return (f"SELECT {keys}, unnest(generate_series(0, len(arr) - 1)) AS {pos}, unnest(arr) AS {val} "
            f"FROM (SELECT {keys}, {arr_sql} AS arr FROM {src}) q")


# ---------------------------------------------------------------------------
# C1, C2
# ---------------------------------------------------------------------------

register("q_subset_length_gate",
         f"SELECT doc_id, subset, CAST(length(text) AS BIGINT) AS n_chars FROM {MARKUP} "
         f"WHERE subset IN ({', '.join(dk.lit(s) for s in GATE_SUBSETS)}) AND length(text) >= {MIN_LEN}")(
    lambda spark, d: docs_markup(spark, d)
    .where(F.col("subset").isin(*GATE_SUBSETS) & (F.length("text") >= MIN_LEN))
    .select("doc_id", "subset", F.length("text").cast("long").alias("n_chars")))


# ---------------------------------------------------------------------------
# One text -> text step each, over docs_markup
# ---------------------------------------------------------------------------

STEPS = {
    "q_strip_indent": (tx.strip_indent, dk.strip_indent),
    "q_mojibake": (tx.fix_mojibake, dk.fix_mojibake),
    "q_italics": (tx.unwrap_italics, dk.unwrap_italics),
    "q_brackets": (tx.unwrap_brackets, dk.unwrap_brackets),
    "q_blockquote": (tx.blockquote_to_space, dk.blockquote_to_space),
    "q_md_headers": (tx.drop_md_headers, dk.drop_md_headers),
    "q_bold_lines": (tx.drop_bold_lines, dk.drop_bold_lines),
    "q_chapter_lines": (tx.drop_chapter_lines, dk.drop_chapter_lines),
    "q_bold_markers": (tx.bold_markers_to_space, dk.bold_markers_to_space),
    "q_url_scrub": (tx.scrub_urls, dk.scrub_urls),
    "q_illustration_books": (tx.drop_illustrations_books, dk.drop_illustrations_books),
    "q_illustration_pg": (tx.drop_illustrations_pg, dk.drop_illustrations_pg),
    "q_license_cut": (tx.cut_license, dk.cut_license),
    "q_header_strip": (tx.strip_headers, dk.strip_headers),
    "q_collapse_spaces": (tx.collapse_spaces, dk.collapse_spaces),
    "q_strip_ws": (tx.strip_ws, dk.strip_ws),
    "q_list_runs_bold": (tx.drop_bold_runs, dk.drop_bold_runs),
    "q_list_runs_numbered": (tx.drop_numbered_runs, dk.drop_numbered_runs),
    "q_list_runs_short": (tx.drop_short_line_runs, dk.drop_short_line_runs),
    "q_list_runs_contents": (tx.drop_contents_runs, dk.drop_contents_runs),
}


def _step_query(fn):
    return lambda spark, d: docs_markup(spark, d).select("doc_id", fn(F.col("text")).alias("text"))


for _name, (_sf, _df) in STEPS.items():
    register(_name, f"SELECT doc_id, {_df('text')} AS text FROM {MARKUP}")(_step_query(_sf))


@register("q_url_scrub_pages", f"SELECT page_id, {dk.scrub_urls('html')} AS text FROM pages")
def q_url_scrub_pages(spark, d):
    """D10 on raw web pages (URLs in links and text)."""
    return table(spark, d, "pages").select("page_id", tx.scrub_urls(F.col("html")).alias("text"))


# ---------------------------------------------------------------------------
# C9-C13 predicates over lines / chapters
# ---------------------------------------------------------------------------

@register("q_paragraph_quality",
          "SELECT doc_id, line_no, " + dk.paragraph_ok("line") + " AS ok FROM ("
          + _duck_explode("doc_id", dk.split("text", "\\n"), "line_no", "line", MARKUP) + ") z")
def q_paragraph_quality(spark, d):
    """C9 on every line."""
    lines = _explode(docs_markup(spark, d), ["doc_id"], sg.split_lines("text"), "line_no", "line")
    return lines.select("doc_id", "line_no", tx.paragraph_ok(F.col("line")).alias("ok"))


@register("q_upper_lines",
          "SELECT doc_id, line_no, " + dk.has_non_space("line") + " AND NOT " + dk.is_upper("line")
          + " AS kept FROM (" + _duck_explode("doc_id", dk.split("text", "\\n"), "line_no", "line", MARKUP) + ") z")
def q_upper_lines(spark, d):
    """Blank and all-upper-case lines are dropped."""
    lines = _explode(docs_markup(spark, d), ["doc_id"], sg.split_lines("text"), "line_no", "line")
    return lines.select("doc_id", "line_no", (tx.has_non_space(F.col("line")) & ~tx.is_upper(F.col("line"))).alias("kept"))


@register("q_short_chapters",
          _duck_explode("doc_id", f"list_filter({dk.split('text', '\\n\\n\\n+')}, "
                        "lambda ch: length(ch) > 5)", "chapter_no", "chapter", MARKUP))
def q_short_chapters(spark, d):
    """E1 + C11: chapters of more than 5 chars."""
    chapters = F.filter(sg.split_chapters_books("text"), lambda ch: F.length(ch) > 5)
    return _explode(docs_markup(spark, d), ["doc_id"], chapters, "chapter_no", "chapter")


@register("q_short_paragraphs",
          _duck_explode("doc_id", f"list_filter({dk.clean_webcrawl('text')}, lambda p: length(p) > 5)",
                        "para_no", "para", MARKUP))
def q_short_paragraphs(spark, d):
    """Paragraphs of the webcrawl cleaner longer than 5 chars."""
    paras = F.filter(pr.clean_webcrawl("text"), lambda p: F.length(p) > 5)
    return _explode(docs_markup(spark, d), ["doc_id"], paras, "para_no", "para")


@register("q_wiki_backmatter",
          _duck_explode("doc_id", dk.clean_wiki("text"), "para_no", "para", MARKUP))
def q_wiki_backmatter(spark, d):
    """C13 (inside E16): back-matter paragraphs removed."""
    return _explode(docs_markup(spark, d), ["doc_id"], pr.clean_wiki("text"), "para_no", "para")


# ---------------------------------------------------------------------------
# E: splits, cleaners, dispatch, segmentation
# ---------------------------------------------------------------------------

@register("q_split_chapters_pg", _duck_explode("doc_id", dk.split("text", "\\n\\n\\n+|(?:\\* *){5}"),
                                               "chapter_no", "chapter", MARKUP))
def q_split_chapters_pg(spark, d):
    """E3."""
    return _explode(docs_markup(spark, d), ["doc_id"], sg.split_chapters_pg("text"), "chapter_no", "chapter")


@register("q_split_chapters_web", _duck_explode("doc_id", dk.split("text", "\\n\\n+"), "chapter_no", "chapter", MARKUP))
def q_split_chapters_web(spark, d):
    """E2."""
    return _explode(docs_markup(spark, d), ["doc_id"], sg.split_chapters_web("text"), "chapter_no", "chapter")


for _name, _sp, _dq, _doc in [
    ("q_clean_books", pr.clean_books3, dk.clean_books3, "E13"),
    ("q_clean_gutenberg", pr.clean_gutenberg, dk.clean_gutenberg, "E14"),
    ("q_clean_web", pr.clean_webcrawl, dk.clean_webcrawl, "E15"),
    ("q_clean_wiki", pr.clean_wiki, dk.clean_wiki, "E16"),
]:
    def _q(spark, d, _sp=_sp):
        return _explode(docs_markup(spark, d), ["doc_id"], _sp(F.col("text")), "para_no", "para")
    _q.__doc__ = f"{_doc}: cleaner over every document."
    register(_name, _duck_explode("doc_id", _dq("text"), "para_no", "para", MARKUP))(_q)


ALL = list(pr.profiles())


@register("q_dispatch", _duck_explode("doc_id, subset", dk.clean_by_subset("text", "subset", ALL),
                                      "para_no", "para", MARKUP))
def q_dispatch(spark, d):
    """C14: the cleaner picked by each row's source name."""
    return _explode(docs_markup(spark, d), ["doc_id", "subset"],
                    pr.clean_by_subset(F.col("text"), F.col("subset"), ALL), "para_no", "para")


@register("q_sentence_bounds", _duck_explode("doc_id", dk.sentence_boundaries("text"), "bound_no", "end_pos",
                                             "documents"))
def q_sentence_bounds(spark, d):
    """Sentence boundary end offsets of every document."""
    df = _explode(table(spark, d, "documents"), ["doc_id"], sg.sentence_boundaries("text"), "bound_no", "end_pos")
    return df.withColumn("end_pos", F.col("end_pos").cast("long"))


@register("q_sentence_pack", _duck_explode("doc_id", dk.sentence_pack("text", CHUNK), "seg_no", "segment",
                                           "documents"))
def q_sentence_pack(spark, d):
    """Every document packed into segments below 1024 chars."""
    return _explode(table(spark, d, "documents"), ["doc_id"], sg.sentence_pack("text", CHUNK), "seg_no", "segment")


@register("q_chunk_paragraphs",
          _duck_explode("doc_id", f"flatten(list_transform({dk.clean_webcrawl('text')}, lambda para: "
                                  f"{dk.sentence_pack('para', CHUNK)}))", "seg_no", "segment", MARKUP))
def q_chunk_paragraphs(spark, d):
    """Cleaned paragraphs, each packed, flattened."""
    return _explode(docs_markup(spark, d), ["doc_id"], sg.pack_paragraphs(pr.clean_webcrawl("text"), CHUNK),
                    "seg_no", "segment")


@register("q_char_windows", _duck_explode("doc_id", dk.char_windows("text", MIN_LEN), "win_no", "window",
                                          "documents"))
def q_char_windows(spark, d):
    """500-char windows of every document."""
    return _explode(table(spark, d, "documents"), ["doc_id"], sg.char_windows("text", MIN_LEN), "win_no", "window")


@register("q_md5", "SELECT doc_id, md5(text) AS hash FROM documents")
def q_md5(spark, d):
    """F1."""
    return table(spark, d, "documents").select("doc_id", tx.md5_hex("text").alias("hash"))


# ---------------------------------------------------------------------------
# G, F7, C5-C8, C15: vocabulary and token ratios
# ---------------------------------------------------------------------------

VOCAB = dk.vocab_cte()
VOCAB_EN = dk.vocab_cte("documents WHERE lang = 'en'")
WINDOW = MIN_LEN


def corpus_vocab(spark, d):
    """The word vocabulary of all documents."""
    return vb.build_vocab(table(spark, d, "documents"))


def english_vocab(spark, d):
    """The word vocabulary of the English documents, for telling English from other text."""
    return vb.build_vocab(table(spark, d, "documents").where(F.col("lang") == "en"))


@register("q_word_tokens", _duck_explode("doc_id", dk.word_tokens("text"), "tok_no", "token", MARKUP))
def q_word_tokens(spark, d):
    """G1: word / punctuation tokens of every markup document."""
    return _explode(docs_markup(spark, d), ["doc_id"], word_tokens("text"), "tok_no", "token")


@register("q_vocab_topk", f"WITH {VOCAB} SELECT token, id, freq FROM vocab")
def q_vocab_topk(spark, d):
    """Top 2^16 tokens (with the two specials) of frequency >= 8."""
    return corpus_vocab(spark, d)


@register("q_encode", f"WITH {VOCAB} SELECT doc_id, tok_no, CAST(coalesce(v.id, 1) AS INTEGER) AS id FROM ("
          + _duck_explode("doc_id", dk.word_tokens("text"), "tok_no", "token", MARKUP)
          + ") t LEFT JOIN vocab v USING (token)")
def q_encode(spark, d):
    """G3 + F7: ids in text order, exploded."""
    enc = vb.encode(docs_markup(spark, d), corpus_vocab(spark, d))
    return _explode(enc, ["doc_id"], F.col("ids"), "tok_no", "id")


@register("q_unk_ratio", f"WITH {VOCAB}, {dk.unk_ratio_cte('documents')} SELECT * FROM ratios")
def q_unk_ratio(spark, d):
    """Unknown-token ratio per document."""
    return vb.unk_ratios(table(spark, d, "documents"), corpus_vocab(spark, d))


@register("q_pipeline_unk_cut", f"WITH {VOCAB_EN}, {dk.unk_ratio_cte('documents')} "
          "SELECT doc_id FROM ratios WHERE unk_ratio <= 0.1")
def q_pipeline_unk_cut(spark, d):
    """Documents with unknown ratio <= 0.1."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return vb.unk_cut(docs, english_vocab(spark, d), 0.1).select("doc_id")


@register("q_lang_filter", f"WITH {VOCAB_EN}, {dk.unk_ratio_cte('documents')} "
          "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM ratios WHERE unk_ratio < 0.05)")
def q_lang_filter(spark, d):
    """J3 = C6: documents with unknown ratio < 0.05."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return filter_language(docs, english_vocab(spark, d)).select("doc_id", "lang")


@register("q_lang_filter_head",
          f"WITH {VOCAB_EN}, {dk.unk_ratio_cte('(SELECT doc_id, substr(text, 1, 300) AS text FROM documents)')} "
          "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM ratios WHERE unk_ratio < 0.05)")
def q_lang_filter_head(spark, d):
    """The language filter's head option, here 300 characters (the feature itself)."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return filter_language(docs, english_vocab(spark, d), head_chars=300).select("doc_id", "lang")


@register("q_token_char_ratio",
          f"WITH {VOCAB}, {dk.piece_count_cte('documents', 'doc_id', 'text', 'pc')} "
          "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, coalesce(pc.n_pieces, 0) AS n_pieces, "
          "coalesce(pc.n_pieces, 0) / length(text) AS ratio FROM documents LEFT JOIN pc USING (doc_id)")
def q_token_char_ratio(spark, d):
    """Pieces per character of every document."""
    pieces = vb.piece_table(corpus_vocab(spark, d))
    r = vb.token_char_ratios(table(spark, d, "documents"), ["doc_id"], pieces)
    return r.withColumn("n_chars", F.col("n_chars").cast("long"))


@register("q_redundancy_filter",
          f"WITH {VOCAB}, {dk.piece_count_cte('documents', 'doc_id', 'text', 'pc')} "
          "SELECT doc_id FROM documents LEFT JOIN pc USING (doc_id) "
          "WHERE coalesce(pc.n_pieces, 0) / length(text) < 0.25")
def q_redundancy_filter(spark, d):
    """Documents whose token/char ratio is below 0.25."""
    pieces = vb.piece_table(corpus_vocab(spark, d))
    docs = table(spark, d, "documents").select("doc_id", "text")
    return vb.redundancy_filter(docs, pieces).select("doc_id")


_WIN_SRC = ("(" + _duck_explode("doc_id", dk.char_windows("text", WINDOW), "win", "wtext", "documents") + ")")


@register("q_redundancy_gate",
          f"WITH {VOCAB}, {dk.piece_count_cte(_WIN_SRC, 'doc_id, win', 'wtext', 'pc')}, "
          f"w AS {_WIN_SRC}, r AS (SELECT w.doc_id, coalesce(pc.n_pieces, 0) / length(w.wtext) AS ratio "
          "FROM w LEFT JOIN pc USING (doc_id, win)), "
          "s AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_windows, avg(CASE WHEN ratio > 0.3 THEN 1.0 ELSE 0.0 END) "
          "AS bad_share FROM r GROUP BY doc_id) "
          "SELECT doc_id, n_windows, bad_share, NOT (bad_share > 0.1) AS kept FROM s")
def q_redundancy_gate(spark, d):
    """C7 + G8 + E10: share of 500-char windows with token/char ratio > 0.3; kept if <= 0.10."""
    pieces = vb.piece_table(corpus_vocab(spark, d))
    s = vb.window_bad_share(table(spark, d, "documents").select("doc_id", "text"), pieces, WINDOW, 0.3).drop("text")
    return s.withColumn("kept", ~(F.col("bad_share") > 0.1))


# A small given model, as a user may have saved it; the first merges that the documents teach.
GIVEN_MERGES = [("▁", "e"), ("t", "h"), ("o", "n"), ("▁", "th"), ("r", "e"), ("i", "n"), ("▁", "a"), ("▁", "."), ("t", "i"), ("▁", "o"), ("h", "e"), ("n", "d"),
                ("e", "r"), ("l", "e"), ("▁", ","), ("e", "n"), ("▁th", "e"), ("▁e", "r"), ("s", "t"), ("c", "h"), ("a", "n"), ("▁", "d"), ("ti", "on"), ("▁", "on"),
                ("▁e", "n"), ("h", "a"), ("o", "u"), ("l", "y"), ("o", "r"), ("in", "g"), ("a", "t"), ("n", "t"), ("e", "a"), ("b", "le"), ("w", "h"), ("▁a", "n")]


@register("q_redundancy_gate_bpe",
          f"WITH w AS {_WIN_SRC}, t AS (SELECT doc_id, win, unnest({dk.word_tokens('wtext')}) AS token FROM w), "
          f"p AS (SELECT token, {dk.bpe_pieces('token', GIVEN_MERGES)} AS pieces FROM (SELECT DISTINCT token FROM t)), "
          "pc AS (SELECT doc_id, win, sum(pieces) AS n FROM t JOIN p USING (token) GROUP BY ALL), "
          "r AS (SELECT doc_id, coalesce(n, 0) / length(wtext) AS ratio FROM w LEFT JOIN pc USING (doc_id, win)), "
          "s AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_windows, avg(CASE WHEN ratio > 0.65 THEN 1.0 ELSE 0.0 END) AS bad_share FROM r GROUP BY doc_id) "
          "SELECT doc_id, n_windows, bad_share, NOT (bad_share > 0.1) AS kept FROM s")
def q_redundancy_gate_bpe(spark, d):
    """C7 + G5 with a BPE model: the pieces of every token are made where the text is."""
    from textmill.operators.subword import BpeModel

    s = vb.window_bad_share(table(spark, d, "documents").select("doc_id", "text"), BpeModel(spark, GIVEN_MERGES), WINDOW, 0.65).drop("text")
    return s.withColumn("kept", ~(F.col("bad_share") > 0.1))


@register("q_redundancy_filter_bpe",
          f"WITH t AS (SELECT doc_id, unnest({dk.word_tokens('text')}) AS token FROM documents), "
          f"p AS (SELECT token, {dk.bpe_pieces('token', GIVEN_MERGES)} AS pieces FROM (SELECT DISTINCT token FROM t)), "
          "pc AS (SELECT doc_id, sum(pieces) AS n FROM t JOIN p USING (token) GROUP BY doc_id) "
          "SELECT doc_id FROM documents LEFT JOIN pc USING (doc_id) WHERE coalesce(n, 0) / length(text) < 0.6")
def q_redundancy_filter_bpe(spark, d):
    """C8 with a BPE model."""
    from textmill.operators.subword import BpeModel

    docs = table(spark, d, "documents").select("doc_id", "text")
    return vb.redundancy_filter(docs, BpeModel(spark, GIVEN_MERGES), threshold=0.6).select("doc_id")


_TRAINED: dict = {}


def _bpe_model(spark, d):
    """The model of all words of ``documents`` (the operator's 1000 merges), trained once for the queries below."""
    from textmill.operators.subword import BpeModel, bpe_model

    key = spark.sparkContext.applicationId, d
    if key not in _TRAINED:
        _TRAINED[key] = bpe_model(table(spark, d, "documents")).merges
    return BpeModel(spark, _TRAINED[key])


@register("q_bpe_pieces",
          f"SELECT token, true AS joins_back, true AS in_range, true AS marked FROM "
          f"(SELECT DISTINCT unnest({dk.word_tokens('text')}) AS token FROM documents)")
def q_bpe_pieces(spark, d):
    """BPE subword model (the operator's 1000 merges) trained on all words and applied
    to every word.  SQL checks the words and that each word's pieces join back to it, that
    there are 1 to length + 1 of them, and that the first one bears the word mark; the pieces
    themselves are q_bpe_piece_rows."""
    from textmill.operators.subword import WORD_START

    p = q_bpe_piece_rows(spark, d)
    n = F.size("sym")
    return p.select("token", (F.array_join("sym", "") == F.concat(F.lit(WORD_START), "token")).alias("joins_back"),
                    ((n >= 1) & (n <= F.length("token") + 1)).alias("in_range"), F.get("sym", 0).startswith(WORD_START).alias("marked"))


@register("q_bpe_piece_rows")
def q_bpe_piece_rows(spark, d):
    """The pieces of every word (rows only: an iterative training has no SQL form)."""
    return _bpe_model(spark, d).pieces(vb.word_counts(table(spark, d, "documents")))


@register("q_token_char_ratio_bpe",
          "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, true AS in_range FROM documents")
def q_token_char_ratio_bpe(spark, d):
    """G5 + C8 with the BPE pieces: token/char ratio of every document.  SQL checks
    the documents and that the pieces lie between the words and the characters plus one mark a word;
    the counts and ratios themselves are q_token_char_ratio_bpe_rows."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    r = q_token_char_ratio_bpe_rows(spark, d)
    n = docs.select("doc_id", F.size(word_tokens("text")).alias("w"))
    ok = (F.col("n_pieces") >= F.col("w")) & (F.col("n_pieces") <= 2 * F.col("n_chars") + F.col("w"))
    return r.join(n, "doc_id").select("doc_id", "n_chars", ok.alias("in_range"))


@register("q_token_char_ratio_bpe_rows")
def q_token_char_ratio_bpe_rows(spark, d):
    """G5 + C8: characters, BPE pieces and their ratio by document (rows only), by the pieces of every
    word; tests hold this join against the model that makes pieces where the text is."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    pieces = _bpe_model(spark, d).pieces(vb.word_counts(docs)).select("token", "pieces")
    return vb.token_char_ratios(docs, ["doc_id"], pieces).withColumn("n_chars", F.col("n_chars").cast("long"))


# ---------------------------------------------------------------------------
# Dedup within and across runs
# ---------------------------------------------------------------------------

_HASHED = "(SELECT doc_id, lang, md5(text) AS hash FROM documents)"
_NEW = f"(SELECT hash, min(doc_id) AS doc_id FROM {_HASHED} GROUP BY hash)"
_SAVED = "(SELECT DISTINCT md5(text) AS hash FROM documents WHERE lang = 'en')"
_EMITTED = f"(SELECT hash, doc_id FROM {_NEW} n WHERE hash NOT IN (SELECT hash FROM {_SAVED}))"


def _hashed_docs(spark, d):
    return dd.with_hash(table(spark, d, "documents").select("doc_id", "lang", "text")).select("doc_id", "lang", "hash")


def _saved_list(spark, d):
    """The hash list a previous run left: it processed the English documents."""
    return _hashed_docs(spark, d).where(F.col("lang") == "en").select("hash").distinct()


def _emitted(spark, d):
    new = dd.dedup_exact(_hashed_docs(spark, d).select("hash", "doc_id"), order=["doc_id"])
    return dd.drop_known(new, _saved_list(spark, d))


@register("q_dedup_exact", f"SELECT hash, doc_id FROM {_NEW}")
def q_dedup_exact(spark, d):
    """one document per text hash (smallest doc_id survives)."""
    return dd.dedup_exact(_hashed_docs(spark, d).select("hash", "doc_id"), order=["doc_id"])


@register("q_dedup_incremental", f"SELECT hash, doc_id FROM {_EMITTED}")
def q_dedup_incremental(spark, d):
    """this run's unique documents minus those a previous run saved."""
    return _emitted(spark, d)


@register("q_hash_union", f"SELECT hash FROM {_SAVED} UNION ALL SELECT hash FROM {_EMITTED}")
def q_hash_union(spark, d):
    """the hash list after the run."""
    return dd.union_hashes(_saved_list(spark, d), _emitted(spark, d))


@register("q_dup_count", f"SELECT CAST(count(*) - (SELECT count(*) FROM {_EMITTED}) AS BIGINT) AS duplicates "
          "FROM documents")
def q_dup_count(spark, d):
    """rows dropped as in-run or cross-run duplicates."""
    before = table(spark, d, "documents").select(F.lit(1).alias("w"))
    after = _emitted(spark, d).select(F.lit(-1).alias("w"))
    return before.unionByName(after).agg(F.sum("w").cast("long").alias("duplicates"))


# ---------------------------------------------------------------------------
# J1 (flagship), J2
# ---------------------------------------------------------------------------

ALL_SUBSETS = list(rx.SUBSET_PROFILES)


def _j1_duck(normalize: bool = True, gates: bool = True) -> str:
    subs = ", ".join(dk.lit(x) for x in ALL_SUBSETS)
    paras = dk.clean_by_subset("text", "subset", ALL_SUBSETS)
    if normalize:
        paras = f"list_transform({paras}, lambda np: {dk.normalize_text('np')})"
    paras = f"flatten(list_transform({paras}, lambda pp: {dk.sentence_pack('pp', CHUNK)}))"
    text = f"array_to_string(list_filter({paras}, lambda p5: length(p5) > 5), chr(10))"
    win = "(" + _duck_explode("doc_id", dk.char_windows("text", MIN_LEN), "win", "wtext", "c3") + ")"
    chunks = (f"CASE WHEN length(text) < {MAX_LEN} THEN [text] ELSE "
              f"list_filter({dk.sentence_pack('text', MAX_LEN)}, lambda cc: length(cc) >= {MIN_LEN}) END")
    return (
        f"WITH {VOCAB_EN}, m AS {MARKUP[:-5]}, "
        f"g AS (SELECT doc_id, subset, text FROM m WHERE subset IN ({subs}) AND length(text) >= {MIN_LEN}), "
        f"{dk.unk_ratio_cte('g')}, "
        + (f"g2 AS (SELECT g.* FROM g JOIN ratios USING (doc_id) WHERE unk_ratio <= 0.1), " if gates else
           "g2 AS (SELECT * FROM g), ") +
        f"c AS (SELECT doc_id, subset, {text} AS text FROM g2), "
        f"c3 AS (SELECT * FROM c WHERE length(text) >= {MIN_LEN}), "
        f"w AS {win}, {dk.piece_count_cte('w', 'doc_id, win', 'wtext', 'pc')}, "
        f"sh AS (SELECT w.doc_id, avg(CASE WHEN coalesce(pc.n_pieces, 0) / length(w.wtext) > 0.3 THEN 1.0 ELSE 0.0 END) "
        f"AS bad_share FROM w LEFT JOIN pc USING (doc_id, win) GROUP BY w.doc_id), "
        + (f"c7 AS (SELECT c3.* FROM c3 LEFT JOIN sh USING (doc_id) WHERE NOT (coalesce(sh.bad_share, 0) > 0.1)), "
           if gates else "c7 AS (SELECT * FROM c3), ") +
        f"ch AS (SELECT doc_id, subset, {chunks} AS arr FROM c7), "
        f"r AS (SELECT doc_id, subset, unnest(generate_series(0, len(arr) - 1)) AS chunk_no, unnest(arr) AS text FROM ch), "
        f"h AS (SELECT *, md5(text) AS hash, row_number() OVER (PARTITION BY md5(text) ORDER BY subset, doc_id, chunk_no) AS rn FROM r) "
        f"SELECT doc_id, chunk_no, subset, text, hash FROM h WHERE rn = 1")


def _j1(spark, d, normalize=True, gates=True):
    docs = docs_markup(spark, d)
    vocab = english_vocab(spark, d) if gates else None
    return process_corpus(docs, ALL_SUBSETS, min_text_length=MIN_LEN, max_text_length=MAX_LEN, chunk_text=True,
                          text_chunk_size=CHUNK, max_unk_ratio=0.1, sp_filter_ratio=0.3, vocab=vocab,
                          pieces=vb.piece_table(vocab) if gates else None, normalize=normalize)


@register("q_process_corpus", _j1_duck(True))
def q_process_corpus(spark, d):
    """J1 (flagship): gates, unknown-token cut, per-source cleaning, normalising,
    sentence chunking, redundancy gate, long-document chunking, md5 and dedup."""
    return _j1(spark, d, True)


@register("q_process_corpus_raw", _j1_duck(False))
def q_process_corpus_raw(spark, d):
    """J1 with the normaliser switched off (its ``normalize=False`` option)."""
    return _j1(spark, d, False)


_FIRST_RUN = ["Books3", "Wikipedia (en)"]


def _j1_incremental_duck() -> str:
    base = _j1_duck(True, False)
    head, tail = base.rsplit("SELECT doc_id, chunk_no, subset, text, hash FROM h WHERE rn = 1", 1)
    first = ", ".join(dk.lit(x) for x in _FIRST_RUN)
    return (head + "SELECT doc_id, chunk_no, subset, text, hash FROM h WHERE rn = 1 AND hash NOT IN "
            f"(SELECT hash FROM h WHERE subset IN ({first}))" + tail)


@register("q_process_corpus_incremental", _j1_incremental_duck())
def q_process_corpus_incremental(spark, d):
    """J1 twice with a persisted hash list (F3, F4, B7 inside the job): a first
    run over the Books3 and Wikipedia documents saves its hashes; the second
    run over all sources drops every text the first run emitted."""
    docs = docs_markup(spark, d)
    kw = dict(min_text_length=MIN_LEN, max_text_length=MAX_LEN, chunk_text=True, text_chunk_size=CHUNK)
    first = process_corpus(docs, _FIRST_RUN, **kw)
    path = _scratch(spark, "hash_list")
    dd.save_new_hashes(first, path)
    return process_corpus(docs, ALL_SUBSETS, hash_list=dd.load_hash_list(spark, path), **kw)


@register("q_process_corpus_nogates", _j1_duck(True, False))
def q_process_corpus_nogates(spark, d):
    """J1 without a vocabulary (no unknown-token cut, no redundancy gate): the
    cleaning, normalising, chunking and dedup path over every document."""
    return _j1(spark, d, True, False)


# ---------------------------------------------------------------------------
# classifier
# ---------------------------------------------------------------------------

_META = f"({book_metadata_duckdb()})"
_LABELLED = (f"(SELECT m.book_name, CASE WHEN list_contains(m.categories, 'Fiction') THEN 1 "
             f"WHEN list_contains(m.categories, 'Nonfiction') THEN 0 ELSE 2 END AS label FROM {_META} m)")
_BOOKS = f"(SELECT 'doc' || CAST(doc_id AS VARCHAR) || '.txt' AS book_name, text FROM {MARKUP})"
_TRAINSET = f"(SELECT l.book_name, l.label, b.text FROM {_LABELLED} l JOIN {_BOOKS} b USING (book_name) WHERE l.label <> 2)"


def _labelled(spark, d):
    return book_metadata(spark, d).withColumn("label", cl.label_from_categories("categories"))


def _trainset(spark, d):
    """F6 + H1 + H2: labelled fiction / nonfiction books with their text."""
    lab = _labelled(spark, d).where(F.col("label") != cl.UNKNOWN).select("book_name", "label")
    return cl.attach_books(lab, book_files(spark, d))


@register("q_labels", f"SELECT book_name, label FROM {_LABELLED}")
def q_labels(spark, d):
    """H1: genre label from the categories."""
    return _labelled(spark, d).select("book_name", "label")


@register("q_class_counts", f"SELECT label, count(*) AS n_books FROM {_LABELLED} GROUP BY label")
def q_class_counts(spark, d):
    """G10 + H2: books per class (0 nonfiction, 1 fiction, 2 unknown)."""
    return cl.class_counts(_labelled(spark, d))


@register("q_attach_books", f"SELECT book_name, label, CAST(length(text) AS BIGINT) AS n_chars FROM {_TRAINSET}")
def q_attach_books(spark, d):
    """metadata joined to the book texts by file name."""
    return _trainset(spark, d).select("book_name", "label", F.length("text").cast("long").alias("n_chars"))


@register("q_concat_labelled", f"SELECT book_name, label FROM {_TRAINSET}")
def q_concat_labelled(spark, d):
    """F8: fiction set (label 1) and nonfiction set (label 0) concatenated."""
    nonfic, fic, _ = cl.split_by_label(_labelled(spark, d))
    return cl.concat_labelled(fic.select("book_name"), nonfic.select("book_name")).select("book_name", "label")


_BOW_SQL = (
    f"WITH {VOCAB}, t AS ("
    + _duck_explode("book_name", dk.word_tokens("text"), "pos", "token", _TRAINSET + " tr")
    + "), ids AS (SELECT book_name, coalesce(v.id, 1) AS id FROM t LEFT JOIN vocab v USING (token)), "
    "c AS (SELECT book_name, id, count(*) AS c FROM ids GROUP BY book_name, id UNION ALL "
    f"SELECT b.book_name, 0, 65536 - count(ids.id) FROM {_TRAINSET} b LEFT JOIN ids USING (book_name) GROUP BY b.book_name "
    "HAVING count(ids.id) < 65536), "
    "cl AS (SELECT book_name, id, CAST(least(c, 5000) AS DOUBLE) AS c FROM c) "
    "SELECT book_name, CAST(id AS INTEGER) AS id, c / sqrt(sum(c * c) OVER (PARTITION BY book_name)) AS weight FROM cl")


@register("q_bow", _BOW_SQL)
def q_bow(spark, d):
    """Clipped, L2-normalised bag of words (pad id 0 counted) per labelled book."""
    return cl.bow_long(_trainset(spark, d).select("book_name", "text"), corpus_vocab(spark, d), key="book_name")


@register("q_bow_vectors", _BOW_SQL)
def q_bow_vectors(spark, d):
    """The same features as one sparse vector per book, taken apart again."""
    vectors = cl.document_vectors(_trainset(spark, d).select("book_name", "text"), corpus_vocab(spark, d), "book_name")
    entries = vectors.select("book_name", F.unwrap_udt("features").alias("v"))
    pairs = F.arrays_zip(F.col("v.indices").alias("id"), F.col("v.values").alias("weight"))
    return entries.select("book_name", F.explode(pairs).alias("e")).select("book_name", "e.id", "e.weight")


@register("q_split", f"SELECT book_name, label, row_number() OVER (PARTITION BY label ORDER BY md5(book_name || ':42')) "
          f"<= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test FROM {_TRAINSET}")
def q_split(spark, d):
    """H3: exact stratified 80/20 split, seed 42."""
    return cl.stratified_split(_trainset(spark, d).select("book_name", "label"), key="book_name", seed=42)


_REPORT_SQL = (
    f"WITH {VOCAB_EN}, {dk.unk_ratio_cte('documents')}, "
    "pred AS (SELECT CASE WHEN d.lang = 'en' THEN 1 ELSE 0 END AS y, CASE WHEN r.unk_ratio < 0.05 THEN 1 ELSE 0 END AS p "
    "FROM documents d JOIN ratios r USING (doc_id)), "
    "conf AS (SELECT y, p, count(*) AS n FROM pred GROUP BY y, p), "
    "cls AS (SELECT y AS c FROM conf UNION SELECT p FROM conf), "
    "per AS (SELECT c, coalesce((SELECT sum(n) FROM conf WHERE y = c AND p = c), 0) AS tp, "
    "coalesce((SELECT sum(n) FROM conf WHERE p = c), 0) AS pp, coalesce((SELECT sum(n) FROM conf WHERE y = c), 0) AS support FROM cls), "
    "m AS (SELECT *, CASE WHEN pp > 0 THEN tp / pp ELSE 0 END AS pr, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS rc FROM per), "
    "m2 AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END AS f1 FROM m) "
    "SELECT CAST(c AS VARCHAR) AS row, round(pr, 3) AS precision, round(rc, 3) AS recall, round(f1, 3) AS f1, "
    "CAST(support AS BIGINT) AS support FROM m2 "
    "UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 3), CAST(sum(support) AS BIGINT) FROM m2 "
    "UNION ALL SELECT 'macro avg', round(avg(pr), 3), round(avg(rc), 3), round(avg(f1), 3), CAST(sum(support) AS BIGINT) FROM m2 "
    "UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 3), round(sum(rc * support) / sum(support), 3), "
    "round(sum(f1 * support) / sum(support), 3), CAST(sum(support) AS BIGINT) FROM m2")


@register("q_class_report", _REPORT_SQL)
def q_class_report(spark, d):
    """Classification report of the unknown-ratio language filter (C6) as a
    detector of English documents (truth: the ``lang`` column)."""
    docs = table(spark, d, "documents")
    r = vb.unk_ratios(docs, english_vocab(spark, d)).select("doc_id", "unk_ratio")
    pred = docs.join(r, "doc_id").select((F.col("lang") == "en").cast("int").alias("label"),
                                         F.coalesce(F.col("unk_ratio") < 0.05, F.lit(False)).cast("int").alias("prediction"))
    return cl.classification_report(pred)


_TOKENS_SQL = (
    f"WITH {dk.vocab_cte(_BOOKS)}, t AS ("
    + _duck_explode("book_name", dk.word_tokens("text"), "pos", "token", _TRAINSET + " tr")
    + ") SELECT b.book_name, b.label, count(t.token) AS n_tokens, "
    "md5(coalesce(string_agg(CAST(coalesce(v.id, 1) AS VARCHAR), ' ' ORDER BY t.pos) FILTER (t.token IS NOT NULL), '')) AS ids_md5 "
    f"FROM {_TRAINSET} b LEFT JOIN t USING (book_name) LEFT JOIN vocab v ON v.token = t.token GROUP BY b.book_name, b.label")


def _tokenized(spark, d):
    """J4 -> B4 -> A6: tokenised books written one folder per class and read again."""
    tok, vocab = prepare_books(book_metadata(spark, d), book_files(spark, d))
    path = _scratch(spark, "tokenized")
    io.write_tokenized_books(tok, path)
    return io.read_tokenized_books(spark, path), vocab


@register("q_prepare_books", _TOKENS_SQL)
def q_prepare_books(spark, d):
    """J4 with B4 and A6: every labelled book's ids, through the files."""
    return _tokenized(spark, d)[0].select(
        "book_name", "label", F.size("tokens").cast("long").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("ids_md5"))


def _genre_files(spark, d):
    """J4 -> J5 -> B6: (tokenised books, vocabulary, model path, train and test report)."""
    tok, vocab = _tokenized(spark, d)
    model, train, test = train_genre_model(tok)
    path = _scratch(spark, "genre_model")
    cl.save_model(model, path)
    return tok, vocab, model, path, train, test


@register("q_train_report",
          f"WITH s AS (SELECT label, count(*) AS n FROM {_TRAINSET} GROUP BY label), "
          "r AS (SELECT label, n, round(0.2 * n) AS test FROM s) "
          "SELECT part, CAST(label AS VARCHAR) AS row, CAST(CASE part WHEN 'test' THEN test ELSE n - test END AS BIGINT) AS support, true AS better_than_majority "
          "FROM r, (VALUES ('train'), ('test')) p(part) UNION ALL "
          "SELECT part, 'accuracy', CAST(sum(CASE part WHEN 'test' THEN test ELSE n - test END) AS BIGINT), true "
          "FROM r, (VALUES ('train'), ('test')) p(part) GROUP BY part")
def q_train_report(spark, d):
    """J5 (H3-H5, G6-G9, B6): the genre model's reports.  SQL checks the classes,
    their exact supports in the stratified split, and that the train accuracy is
    at least the larger class's share (the test part only has to be there)."""
    *_, train, test = _genre_files(spark, d)

    def part(report, name, check):
        top = report.where(F.col("row").isin("0", "1")).agg(F.max("support").alias("m"), F.sum("support").alias("n"))
        ok = (F.col("f1") >= F.round(F.col("m") / F.col("n"), 3)) if check else F.lit(True)
        return report.where(F.col("row").isin("0", "1", "accuracy")).crossJoin(F.broadcast(top)).select(
            F.lit(name).alias("part"), "row", "support", F.when(F.col("row") == "accuracy", ok).otherwise(True).alias("better_than_majority"))

    return part(train, "train", True).unionByName(part(test, "test", False))


_BY_LANG = "(SELECT concat('doc', doc_id, '.txt') AS book_name, CAST(lang = 'en' AS INT) AS label FROM documents WHERE lang IS NOT NULL)"


@register("q_genre_separable",
          f"WITH s AS (SELECT label, count(*) AS n FROM {_BY_LANG} GROUP BY label) "
          "SELECT CAST(label AS VARCHAR) AS row, CAST(round(0.2 * n) AS BIGINT) AS support, true AS learnt FROM s "
          "UNION ALL SELECT 'accuracy', CAST(sum(round(0.2 * n)) AS BIGINT), true FROM s "
          "UNION ALL SELECT 'kept lines', CAST(sum(n) AS BIGINT), true FROM s")
def q_genre_separable(spark, d):
    """J5 + J6 on books that a word vocabulary can tell apart (English or not): the report of the test part.
    SQL checks its supports, that on unseen books the model makes at most half the errors of naming the
    larger class, with precision and recall of both classes over a half, and that the kept lines are the
    English ones but for one in twenty."""
    docs = table(spark, d, "documents").where("lang IS NOT NULL")
    books = docs.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("book_name"), "text", (F.col("lang") == "en").cast("int").alias("label"))
    vocab = corpus_vocab(spark, d)
    tokens = vb.encode(books, vocab, "book_name").select("book_name", F.col("ids").alias("tokens"))
    model, _, test = train_genre_model(books.select("book_name", "label").join(tokens, "book_name"))
    by_class = test.where(F.col("row").isin("0", "1")).agg(F.max("support").alias("most"), F.sum("support").alias("all"))
    better = F.when(F.col("row") == "accuracy", 2 * (1 - F.col("f1")) <= 1 - F.col("most") / F.col("all")).otherwise(
        (F.col("precision") > 0.5) & (F.col("recall") > 0.5))
    report = test.where(F.col("row").isin("0", "1", "accuracy")).crossJoin(F.broadcast(by_class)).select("row", "support", better.alias("learnt"))
    kept = predict_genre(books, model, vocab, key="book_name").select("book_name", F.lit(1).alias("kept"))
    wrong = (F.col("kept").isNotNull() != (F.col("label") == 1)).cast("long")
    lines = books.join(kept, "book_name", "left").agg(F.count(F.lit(1)).alias("support"), F.sum(wrong).alias("wrong"))
    return report.unionByName(lines.select(F.lit("kept lines").alias("row"), "support", (F.col("wrong") * 20 <= F.col("support")).alias("learnt")))


@register("q_predict_filter",
          "SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) AS BIGINT) AS kept_plus_dropped, "
          "CAST(0 AS BIGINT) AS differ_after_reload FROM documents")
def q_predict_filter(spark, d):
    """J6 (H6, C16, B6): every document scored by the genre model as trained and as
    saved and loaded again.  SQL checks that kept and dropped lines make up all
    lines and that both models agree on each."""
    _, vocab, model, path, _, _ = _genre_files(spark, d)
    lines = table(spark, d, "documents").select(F.col("doc_id").alias("line_no"), "text")
    feats = saved(cl.document_vectors(lines, vocab, "line_no"), "line-vectors")  # both models read them
    both = cl.predict(model, feats).select("line_no", F.col("prediction").alias("own")).join(
        cl.predict(cl.load_model(path), feats).select("line_no", F.col("prediction").alias("loaded")), "line_no")
    kept = predict_genre(lines, model, vocab).select("line_no", F.lit(1).alias("kept"))
    one = lines.select("line_no").join(both, "line_no", "left").join(kept, "line_no", "left")
    dropped = F.col("kept").isNull() & (F.col("own") == 0)
    return one.agg(F.count("*").alias("n_lines"), F.sum(((F.col("kept") == 1) | dropped).cast("long")).alias("kept_plus_dropped"),
                   F.sum((~F.col("own").eqNullSafe(F.col("loaded"))).cast("long")).alias("differ_after_reload"))


# ---------------------------------------------------------------------------
# normaliser
# ---------------------------------------------------------------------------

def _paras(spark, d):
    """Cleaned paragraphs of every document (webcrawl cleaner), one row each."""
    return _explode(docs_markup(spark, d), ["doc_id"], pr.clean_webcrawl("text"), "para_no", "para")


_PARAS_SQL = "(" + _duck_explode("doc_id", dk.clean_webcrawl("text"), "para_no", "para", MARKUP) + ")"

for _name, _sfn, _dfn, _doc in [
    ("q_special_map", nz.special_normalize, dk.special_map, "D21: special map + NFKC on every cleaned paragraph."),
    ("q_punct_norm", nz.moses_punct_normalize, dk.moses_punct_normalize, "D20: punctuation normalisation."),
    ("q_ws_collapse", nz.fix_tokenized, dk.fix_tokenized, "D24 (+D23): whitespace split and detokenise."),
    ("q_normalize", nz.normalize_text, dk.normalize_text, "D25 / J2: the default normaliser chain."),
]:
    def _q(spark, d, _sfn=_sfn):
        return _paras(spark, d).select("doc_id", "para_no", _sfn(F.col("para")).alias("text"))
    _q.__doc__ = _doc
    register(_name, f"SELECT doc_id, para_no, {_dfn('para')} AS text FROM {_PARAS_SQL} z")(_q)


@register("q_lower", "SELECT doc_id, lower(text) AS text FROM documents")
def q_lower(spark, d):
    """D19."""
    return table(spark, d, "documents").select("doc_id", nz.lowerize("text").alias("text"))


@register("q_unescape", "SELECT page_id, replace(replace(replace(replace(html, '&quot;', '\"'), '&middot;', '·'), "
          "'&copy;', '©'), '&amp;', '&') AS text FROM pages")
def q_unescape(spark, d):
    """HTML entities of the raw pages decoded."""
    return table(spark, d, "pages").select("page_id", nz.unescape_html("html").alias("text"))


def _entity_names():
    """(place, name, characters) of every HTML 5 name."""
    from html.entities import html5

    return [(k, n, html5[n]) for k, n in enumerate(sorted(html5))]


_NAMES_SQL = "(VALUES " + ", ".join(f"({k}, {dk.lit(n)}, {dk.lit(v)})" for k, n, v in _entity_names()) + ") e(k, name, chars)"


@register("q_unescape_html5",
          f"SELECT page_id, e.k, concat('<b>', chars, '</b>', replace(replace(replace(replace(html, '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')) AS text "
          f"FROM pages, (VALUES (0), (1), (2)) j(j), {_NAMES_SQL} WHERE e.k = (3 * page_id + j) % {len(_entity_names())}")
def q_unescape_html5(spark, d):
    """Every page with three of all HTML 5 names (with and without semicolon), decoded."""
    names = spark.createDataFrame(_entity_names(), "k int, name string, chars string")
    pages = table(spark, d, "pages").select("page_id", "html", F.explode(F.array(*[F.lit(j) for j in range(3)])).alias("j"))
    text = F.concat(F.lit("<b>&"), "name", F.lit("</b>"), "html")
    joined = pages.withColumn("k", ((3 * F.col("page_id") + F.col("j")) % len(_entity_names())).cast("int")).join(F.broadcast(names), "k")
    return joined.select("page_id", "k", nz.unescape_html(text).alias("text"))


@register("q_moses_tok", _duck_explode("doc_id", dk.moses_tokenize("text"), "tok_no", "token", MARKUP))
def q_moses_tok(spark, d):
    """Moses-style tokens of every markup document."""
    return _explode(docs_markup(spark, d), ["doc_id"], nz.moses_tokenize("text"), "tok_no", "token")


# ---------------------------------------------------------------------------
# JSON sources and sinks as round trips
# ---------------------------------------------------------------------------

def _scratch(spark, name):
    import os
    import uuid

    from textmill.session import checkpoint_dir

    return os.path.join(checkpoint_dir(spark), f"{name}_{uuid.uuid4().hex}")


@register("q_jsonl_roundtrip", f"SELECT subset, text, md5(text) AS hash FROM {MARKUP}")
def q_jsonl_roundtrip(spark, d):
    """A1 + B1: documents written as Pile-style JSONL, read back with the
    document source, and written / read again as the corpus sink."""
    path = _scratch(spark, "pile_jsonl")
    io.write_pile_jsonl(docs_markup(spark, d), path)
    docs = io.read_documents(spark, path)
    out = _scratch(spark, "corpus_jsonl")
    io.write_corpus(dd.with_hash(docs), out)
    return spark.read.schema("subset string, text string, hash string").json(out)


_JSON_LIST = ("'[' || array_to_string(list_transform({arr}, lambda js: "
              "regexp_extract(to_json([js]), '^\\[(.*)\\]$', 1)), ', ') || ']'")


@register("q_json_roundtrip", "SELECT " + _JSON_LIST.format(arr=dk.clean_webcrawl("text")) + " AS json FROM documents")
def q_json_roundtrip(spark, d):
    """A2 + B2 + D26: documents written one JSON string per line, read back, and
    each line cleaned through the JSON wrapper (JSON list of paragraphs out)."""
    path = _scratch(spark, "json_strings")
    io.write_json_strings(table(spark, d, "documents"), path)
    lines = io.read_json_strings(spark, path)
    return lines.select(io.process_jsonl(F.col("raw"), pr.clean_webcrawl).alias("json"))


# ---------------------------------------------------------------------------
# Sources, sinks and jobs as file round trips; the public API
# ---------------------------------------------------------------------------

#: Files in a folder of q_read_books, about.
FOLDER_BOOKS = 1024


@register("q_read_books", "SELECT md5(coalesce(text, '') || chr(10)) AS text_md5 FROM documents")
def q_read_books(spark, d):
    """A3: every document written as a text file of its own and read as a whole file
    (the writer ends each with a newline).  Rows of one partition that share an id share a file."""
    path = _scratch(spark, "books")
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    io.write_books(docs, path, "doc_id", FOLDER_BOOKS)
    return io.read_books(spark, path, pattern="*").select(F.md5("text").alias("text_md5"))


#: Books in a file of q_book_metadata, about.
METADATA_ITEMS = 10_000


@register("q_book_metadata", f"SELECT book_name, array_to_string(categories, '|') AS categories FROM {_META} m")
def q_book_metadata(spark, d):
    """A4: the metadata written as JSON arrays of about METADATA_ITEMS books a file (lists, and
    plain strings for single categories) and read back as one folder."""
    path = _scratch(spark, "metadata")
    meta = book_metadata(spark, d)
    cats = F.when(F.size("categories") > 1, F.to_json("categories")).otherwise(F.to_json(F.array(F.get("categories", 0))).substr(F.lit(2), F.length(F.to_json(F.array(F.get("categories", 0)))) - 2))
    item = F.concat(F.lit('{"book_name": '), io.json_string("book_name"), F.lit(', "categories": '), cats, F.lit("}"))
    files = -(-meta.count() // METADATA_ITEMS) or 1
    arrays = meta.groupBy(F.pmod(F.xxhash64("book_name"), F.lit(files)).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(item), ",\n"), F.lit("]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return io.read_book_metadata(spark, path).select("book_name", F.array_join("categories", "|").alias("categories"))


@register("q_shards", "SELECT doc_id % 4 AS split, CAST(count(*) AS BIGINT) AS n_docs, CAST(1 AS BIGINT) AS n_shards FROM documents GROUP BY 1")
def q_shards(spark, d):
    """A5: four shards of several files each read in one run; each document's shard is the
    write that its file's name bears (part-<number>-<write>-<...>)."""
    path = _scratch(spark, "shards")
    docs = table(spark, d, "documents").select(F.concat((F.col("doc_id") % 4).cast("string"), F.lit(" "), F.coalesce("text", F.lit(""))).alias("text"),
                                               F.lit("Pile-CC").alias("subset"), (F.col("doc_id") % 4).alias("split"))
    for k in range(4):
        io.write_pile_jsonl(docs.where(F.col("split") == k), f"{path}/split{k}")
    read = io.read_documents(spark, f"{path}/*").withColumn("shard", F.regexp_extract("shard", r"^part-\d+-([0-9a-f]+(-[0-9a-f]+){4})", 1))
    return read.groupBy(F.split("text", " ")[0].cast("long").alias("split")).agg(
        F.count("*").alias("n_docs"), F.countDistinct("shard").alias("n_shards"))


@register("q_vocab_artifact", f"WITH {VOCAB} SELECT token, id, freq FROM vocab")
def q_vocab_artifact(spark, d):
    """The vocabulary built and saved, then loaded (the second call gets documents
    without a token, so a rebuilt one would be empty)."""
    path = _scratch(spark, "vocab")
    docs = table(spark, d, "documents")
    vb.load_or_build_vocab(docs, path)
    return vb.load_or_build_vocab(docs.withColumn("text", F.lit(" ")), path)


def _counters_duck() -> str:
    base = _j1_duck(True, False).rsplit("SELECT doc_id, chunk_no, subset, text, hash FROM h WHERE rn = 1", 1)[0]
    return (base + "SELECT CAST((SELECT count(*) FROM g) AS BIGINT) AS gated, CAST((SELECT count(*) FROM h) AS BIGINT) AS rows, "
            "CAST((SELECT count(*) FROM h WHERE rn = 1) AS BIGINT) AS emitted")


@register("q_run_counters", _counters_duck())
def q_run_counters(spark, d):
    """The corpus job's run counters, gathered while it writes its corpus (B1)."""
    counters: dict = {}
    out = process_corpus(docs_markup(spark, d), ALL_SUBSETS, min_text_length=MIN_LEN, max_text_length=MAX_LEN,
                         chunk_text=True, text_chunk_size=CHUNK, counters=counters)
    io.write_corpus(out, _scratch(spark, "counted"))
    got = [counters[k].get["n"] for k in ("gated", "rows", "emitted")]
    return spark.createDataFrame([got], "gated long, rows long, emitted long")


@register("q_filter_language_files",
          f"WITH {VOCAB_EN}, {dk.unk_ratio_cte('documents')} "
          "SELECT md5(text) AS text_md5 FROM documents JOIN ratios USING (doc_id) WHERE unk_ratio < 0.05")
def q_filter_language_files(spark, d):
    """J3 with A2 and B3: JSON strings in, the passing lines out as they were."""
    src, out = _scratch(spark, "lines_in"), _scratch(spark, "lines_out")
    io.write_json_strings(table(spark, d, "documents").where("text IS NOT NULL"), src)
    filter_language_files(spark, src, out, english_vocab(spark, d))
    kept = spark.read.text(out).join(spark.read.text(src).distinct(), "value", "left_semi")
    return kept.select(F.md5(io.decode_json_string("value")).alias("text_md5"))


@register("q_normalize_files", f"SELECT md5({dk.normalize_text('text')}) AS text_md5 FROM {MARKUP}")
def q_normalize_files(spark, d):
    """J2 with A2 and B2: JSON strings in, normalised JSON strings out."""
    src, out = _scratch(spark, "raw_in"), _scratch(spark, "normal_out")
    io.write_json_strings(docs_markup(spark, d), src)
    normalize_files(spark, src, out)
    return io.read_json_strings(spark, out).select(F.md5("text").alias("text_md5"))


@register("q_user_profile", _duck_explode("doc_id", "list_transform(list_filter(string_split(text, chr(10)), lambda p: length(p) > 20), lambda p: '* ' || p)",
                                          "para_no", "para", "documents"))
def q_user_profile(spark, d):
    """U1 + U2: a plain Python cleaner registered for a source of its own and dispatched to."""
    pr.register_profile("bullets", lambda text: [f"* {p}" for p in text.split("\n") if len(p) > 20], subsets=["Bullets"], python=True)
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit("Bullets").alias("subset"))
    paras = docs.withColumn("paras", pr.clean_by_subset("text", "subset", ["Bullets"]))
    return _explode(paras, ["doc_id"], F.col("paras"), "para_no", "para")


@register("q_public_api",
          " UNION ALL ".join(f"SELECT doc_id, '{n}' AS cleaner, md5(array_to_string({fn('text')}, chr(10))) AS paras_md5 FROM {MARKUP}" for n, fn in [
              ("books3", dk.clean_books3), ("gutenberg", dk.clean_gutenberg), ("webcrawl", dk.clean_webcrawl), ("wiki", dk.clean_wiki),
              ("sentences", lambda x: dk.sentence_pack(x, CHUNK))]))
def q_public_api(spark, d):
    """The public cleaners and the sentence splitter, by their public names."""
    from textmill import api

    fns = {"books3": api.process_books3, "gutenberg": api.process_gutenberg, "webcrawl": api.process_webcrawls, "wiki": api.process_wiki,
           "sentences": lambda c: api.naive_sentence_split(c, CHUNK)}
    docs = docs_markup(spark, d)
    one = docs.select("doc_id", F.explode(F.array(*(F.struct(F.lit(n).alias("cleaner"), F.md5(F.array_join(fn("text"), "\n")).alias("paras_md5"))
                                                    for n, fn in fns.items()))).alias("r"))
    return one.select("doc_id", "r.cleaner", "r.paras_md5")


# ---------------------------------------------------------------------------
# The corpus job as a stream
# ---------------------------------------------------------------------------

#: Documents in a file of q_stream_dedup and q_process_shards, about.
FILE_DOCS = 1_000


def _files_a_quarter(docs) -> int:
    """The files of FILE_DOCS documents that a quarter of ``docs`` fills."""
    return -(-docs.count() // (4 * FILE_DOCS)) or 1


@register("q_stream_dedup", _j1_duck(True, False).replace("SELECT doc_id, chunk_no, subset, text, hash FROM h WHERE rn = 1",
                                                        "SELECT hash FROM h WHERE rn = 1"))
def q_stream_dedup(spark, d):
    """S1 + S2: the vocabulary-free corpus job over a stream of document files
    (availableNow, several micro-batches), deduplicated across them through the
    persisted hash table.  The hashes equal the batch job's; which of several
    equal texts stays depends on the batch that brings it first."""
    import os
    import uuid

    from textmill.sources.tables import DOCS_MARKUP_SQL
    from textmill.streaming.incremental import run_stream_dedup

    # Four micro-batches of as many files each, so that duplicates meet across batches.
    source = _scratch(spark, "stream_source")
    docs = table(spark, d, "documents")
    files = _files_a_quarter(docs)
    docs.repartition(4 * files).write.parquet(source)

    def prepare(stream):
        docs = spark.sql(DOCS_MARKUP_SQL, documents=stream)
        return process_corpus(docs, ALL_SUBSETS, min_text_length=MIN_LEN, max_text_length=MAX_LEN, chunk_text=True,
                              text_chunk_size=CHUNK, deduplicate=False)

    out = run_stream_dedup(spark, os.path.join(source, "*.parquet"), docs.schema, prepare,
                           order=["subset", "doc_id", "chunk_no"], name=f"stream_dedup_{uuid.uuid4().hex}", max_files_per_trigger=files)
    return out.select("hash")


@register("q_process_shards", _j1_duck(True, False).replace("SELECT doc_id, chunk_no, subset, text, hash FROM h WHERE rn = 1",
                                                          "SELECT hash FROM h WHERE rn = 1"))
def q_process_shards(spark, d):
    """A5 + J1: the vocabulary-free corpus job over four folders of files, a resumable shard each; no text is
    emitted by two of them.  The hashes equal the batch job's."""
    from textmill.plans.jobs import process_shards

    source, out = _scratch(spark, "shard_source"), _scratch(spark, "shard_runs")
    docs = docs_markup(spark, d)
    files = _files_a_quarter(table(spark, d, "documents"))
    for k in range(4):
        io.write_pile_jsonl(docs.where(F.coalesce(F.pmod("doc_id", F.lit(4)), F.lit(0)) == k).repartition(files), f"{source}/shard{k}")
    process_shards(spark, f"{source}/*/*.json", out, by_folder=True, subsets=ALL_SUBSETS, min_text_length=MIN_LEN, max_text_length=MAX_LEN, chunk_text=True, text_chunk_size=CHUNK)
    return spark.read.schema("hash string, shard string").parquet(f"{out}/hashes").select("hash")


@register("q_vocab_shards", ORACLES["q_vocab_topk"])
def q_vocab_shards(spark, d):
    """G2 + B5: the vocabulary from the saved token counts of four shards of the documents."""
    path = _scratch(spark, "shard_counts")
    docs = table(spark, d, "documents")
    for n in range(4):
        vb.save_shard_counts(docs.where(F.pmod(F.col("doc_id"), F.lit(4)) == n), path, f"shard{n}")
    return vb.vocab_from_shards(spark, path)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
