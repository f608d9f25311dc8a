"""The training-data pipeline: documents in, token ids out, one operator of ``textmill.llm`` by stage.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept; all but
the last return the columns of ``documents``.  Rows with nulls, empty texts or repeated ids pass
through the operators as those state; extra columns are kept; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import bpe, decontam, langid, lines, minhash
from textmill.llm.queries import table, tokenizer_path
from textmill.llm.store import saved

#: Near duplicates of the pipeline: shingles of five words, Jaccard similarity.
SIMILARITY = 0.8


def _columns(docs: DataFrame, text: Column | None = None) -> list[Column]:
    """The columns of ``docs``; where the text has changed, ``n_chars`` is counted anew."""
    return [F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" and text is not None else F.col(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language: null or letterless texts, and those that no
    language's model codes in fewer than eight bits a byte.  Without labelled documents to learn from,
    only the former go."""
    found = langid.predict(docs, langid.train(docs.where(~langid.held_out())))
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return found.where(letters & ((F.col("lang_pred") == langid.UNDETERMINED) | (F.col("bits_per_byte") < 8))).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines whose template recurs across documents, several templates a leaf; all documents stay."""
    return lines.drop_recurring_lines(docs, several=True).select(*_columns(docs, F.col("text")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (the smallest id), then one copy of each long
    line that documents still share (before, near copies would lose what makes them alike)."""
    once = saved(minhash.drop_near_duplicates(docs, threshold=SIMILARITY), "near-dedup")
    return lines.drop_copied_passages(once).select(*_columns(docs, F.col("text")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontam.remove_documents(decontam.scan(docs, table(spark, sf_dir, "benchmark"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole texts, and the text that they decode to."""
    return bpe.round_trip(docs.select("doc_id", "text"), tokenizer_path()).select("doc_id", "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

#: SQL can express neither the language models nor the near-duplicate groups.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
