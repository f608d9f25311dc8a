"""Loading the driver's parquet tables, and the ``docs_markup`` stand-in input.

``documents`` carries no markup, blank lines, URLs or keywords, so the source
cleaners would have nothing to do on it.  ``docs_markup`` gives rows in the
schema the cleaners expect (``doc_id, lang, source, subset, text``): it only
prepends / appends fixed markup snippets and varies the newline spacing of the
original text.  The same SQL text runs in Spark and in the DuckDB oracle.  No
job reads anything from how this input is built.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

DOCS_MARKUP_SQL = """
SELECT doc_id, lang, source,
  CASE doc_id % 5 WHEN 0 THEN 'Books3' WHEN 1 THEN 'Gutenberg (PG-19)' WHEN 2 THEN 'OpenWebText2'
                  WHEN 3 THEN 'Pile-CC' ELSE 'Wikipedia (en)' END AS subset,
  CASE WHEN doc_id % 101 = 7 THEN '' WHEN doc_id % 101 = 8 THEN concat('  ', chr(10), ' ') ELSE concat(
    CASE doc_id % 11
      WHEN 0 THEN concat('😀😀😀 opening', chr(10), 'left\u2028right | a &#124; b', chr(10))
      WHEN 1 THEN concat('1ª EDICIÓN', chr(10), 'Nº 5', chr(10), 'ﬁne Ａ１ ① ｶ', chr(10))
      WHEN 2 THEN concat('你好 世界 and 日本 語の. Mr. Smith said... wait. No. 5 is it. e.g. this. End', chr(10))
      ELSE '' END,
    CASE doc_id % 8
      WHEN 0 THEN concat('# Heading ', doc_id, chr(10), '**Part One** extra', chr(10), '**Part Two** extra', chr(10))
      WHEN 1 THEN concat('1 alpha', chr(10), '2 beta', chr(10), '3 gamma', chr(10))
      WHEN 2 THEN concat('> quoted _term ', doc_id, '_ and [note]', chr(10), chr(10), chr(10))
      WHEN 3 THEN concat('Visit http://example.com/a?b=', doc_id, ' or www.site.org/x now. end.Next one', chr(10), chr(10))
      WHEN 4 THEN repeat(concat('x', chr(10)), 12)
      WHEN 5 THEN concat('Produced by someone', chr(10), chr(10), 'Chapter I', chr(10), 'Chapter II', chr(10), 'Chapter IV', chr(10), chr(10))
      WHEN 6 THEN concat('Copyright 1999 someone', chr(10), chr(10), 'References', chr(10), chr(10), 'See also things', chr(10), chr(10))
      ELSE concat('[Illustration: line one', chr(10), 'line two]', chr(10), chr(10), concat('it', chr(226), chr(128), chr(153), 's Ã© “yes” — it’s'), chr(10), chr(10), 'IN CAPITALS', chr(10), '  indented **bold** words', chr(10), chr(10))
    END,
    CASE doc_id % 3 WHEN 0 THEN text
      WHEN 1 THEN replace(text, chr(10), concat(chr(10), chr(10)))
      ELSE replace(text, chr(10), concat(chr(10), chr(10), chr(10))) END,
    CASE WHEN doc_id % 8 = 5 THEN concat(chr(10), '*** END OF THIS TEXT ***', chr(10), 'legal words here') ELSE '' END
  ) END AS text
FROM {documents}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    for n in names or TABLES:
        p = os.path.join(sf_dir, f"{n}.parquet")
        if os.path.exists(p):
            spark.read.parquet(p).createOrReplaceTempView(n)


def docs_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaner input view (see module doc)."""
    return spark.sql(DOCS_MARKUP_SQL, documents=table(spark, sf_dir, "documents"))


def docs_markup_duckdb() -> str:
    """The same view as a DuckDB sub-query over the pre-registered ``documents``."""
    return DOCS_MARKUP_SQL.replace("{documents}", "documents")


# Stand-in book metadata for the classifier jobs: one record per document, in
# the (book_name, categories) schema.  Labelled documents get a genre category
# from their quality label (1 -> Fiction, 0 -> Nonfiction) plus "Adult" when
# flagged toxic; unlabelled ones get "General".
BOOK_META_SQL = """
SELECT concat('doc', CAST(d.doc_id AS STRING), '.txt') AS book_name,
  CASE WHEN l.quality IS NULL THEN array('General')
       WHEN l.quality = 1 AND l.toxic = 1 THEN array('Fiction', 'Adult')
       WHEN l.quality = 1 THEN array('Fiction')
       WHEN l.toxic = 1 THEN array('Nonfiction', 'Adult')
       ELSE array('Nonfiction') END AS categories
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""


def book_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BOOK_META_SQL, documents=table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))


def book_metadata_duckdb() -> str:
    return (BOOK_META_SQL.replace("{documents}", "documents").replace("{labels}", "labels")
            .replace("AS STRING", "AS VARCHAR").replace("array(", "list_value("))


def book_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book texts as (book_name, text) rows."""
    return docs_markup(spark, sf_dir).select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("book_name"), "text")
