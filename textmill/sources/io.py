"""Sources (A1-A6) and sinks (B1-B4, B8) for corpora, book sets and run reports."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("meta", T.StructType([T.StructField("pile_set_name", T.StringType())])),
])
TOKENIZED_BOOK_SCHEMA = T.StructType([
    T.StructField("book_name", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("label", T.IntegerType()),
    T.StructField("tokens", T.ArrayType(T.IntegerType())),
])


def _required(c: Column, what: str) -> Column:
    return F.when(c.isNull(), F.raise_error(F.lit(f"missing {what}"))).otherwise(c)


def read_documents(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """A1 (+A5): JSONL documents with ``text`` and ``meta.pile_set_name``.

    Malformed JSON aborts the job (FAILFAST); with ``strict`` a missing key
    aborts it too.  ``shard`` is the input file name (one run over all shards),
    ``doc_id`` a per-row id that is stable for a fixed input file layout.
    """
    df = spark.read.schema(DOC_SCHEMA).option("mode", "FAILFAST").json(path)
    text, subset = F.col("text"), F.col("meta.pile_set_name")
    if strict:
        text, subset = _required(text, "text"), _required(subset, "meta.pile_set_name")
    return df.select(F.monotonically_increasing_id().alias("doc_id"), subset.alias("subset"), text.alias("text"),
                     F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("shard"))


def decode_json_string(c) -> Column:
    """A2 decoding of one JSON string literal; anything else (malformed JSON,
    another type, several values) aborts the job and names the line."""
    c = F.col(c) if isinstance(c, str) else c
    items = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>", {"mode": "FAILFAST"})
    one = F.regexp_like(c, F.lit(r'\A[ \t\r\n]*+"')) & (F.size(items) == 1)
    bad = F.raise_error(F.concat(F.lit("not a JSON string: "), F.coalesce(F.substring(c, 1, 200), F.lit("null"))))
    return F.when(one, F.get(items, 0)).otherwise(bad)


def read_json_strings(spark: SparkSession, path: str) -> DataFrame:
    """A2: one JSON-encoded string per line: ``line_no, raw, text`` (fails fast)."""
    lines = spark.read.text(path)
    return lines.select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("raw"),
                        decode_json_string("value").alias("text"))


#: Short books that one task reads, about; by Spark's count it would be a few.
TASK_BOOKS = 2048
#: Names of files that Spark's text reader decompresses.
PACKED = r"\.(bz2|deflate|gz|lz4|snappy|zst)$"


def read_books(spark: SparkSession, path: str, head_chars: int | None = None, pattern: str = "*.txt") -> DataFrame:
    """A3: whole text files (``book_name, text``), files of zero bytes as empty books.
    ``head_chars`` keeps only the first so many characters of each (the reference's memory guard; off).

    Plain files are read as bytes: the text reader copies Hadoop's whole configuration for each file."""
    scan = spark.read.format("binaryFile").load(path, pathGlobFilter=pattern)
    n_listed = len(scan._jdf.inputFiles())  # no name has to come to the driver
    n_found, n_bytes, n_packed = (scan.select("path", "length").coalesce(_tasks(spark, n_listed))
                                  .agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.count_if(F.rlike("path", F.lit(PACKED)))).first())
    if n_packed:
        scan = spark.read.text(path, wholetext=True, pathGlobFilter=pattern)
        # Spark gives file names as in a URI.
        name, text = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))), F.col("value")
    else:
        name, text = F.substring_index("path", "/", -1), F.col("content").cast("string")
    books = scan.select(name.alias("book_name"), (text if head_chars is None else F.substring(text, 1, head_chars)).alias("text"))
    books = books.coalesce(_tasks(spark, n_found, n_bytes))
    if n_listed == n_found:
        return books
    return books.unionByName(_empty_files(spark, path, pattern).select("book_name", F.lit("").alias("text")))


def _tasks(spark: SparkSession, n_files: int, n_bytes: int = 0) -> int:
    """Tasks that read so many files, of so many bytes in all: Spark counts each file as some megabytes more."""
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return max(spark.sparkContext.defaultParallelism, -(-n_files // TASK_BOOKS), -(-n_bytes // split))


def write_books(df: DataFrame, path: str, key: str, folder_books: int) -> None:
    """Every ``text`` in a text file of its own (for A3), with a newline after it; rows of one partition that share
    ``key`` share a file, in their order.  About ``folder_books`` files share a folder: many are listed side by side."""
    place = _local_folder(df.sparkSession, path)
    if place is None:
        _write_books_to_store(df, path, key, folder_books)
        return
    rows = df.select(F.struct(F.spark_partition_id(), key).alias("book"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("binary").alias("text"))
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    if max(sizes, default=0) > max(8 * folder_books, 2 * sum(sizes) / df.sparkSession.sparkContext.defaultParallelism):
        # A few partitions have most rows, as of a table with one row group.
        rows = rows.repartition(-(-sum(sizes) // folder_books), "book").sortWithinPartitions("row")
    # Hadoop would write a checksum beside each local file, and start a process (chmod) or more for both.
    os.makedirs(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, numbers = f"_attempt-{TaskContext.get().taskAttemptId()}", {}
        for batch in batches:
            part, book = batch.column(0).flatten()
            for *book, text in zip(part.to_pylist(), book.to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = numbers.setdefault(tuple(book), len(numbers))
                folder = f"{place}/{own}/{n // folder_books}"
                if n % folder_books == 0:
                    os.makedirs(folder, exist_ok=True)
                with open(f"{folder}/part-{n:09d}.txt", "ab") as f:
                    f.write((text or b"") + b"\n")
        yield pa.RecordBatch.from_pydict({"folder": [f"{own}/{k}" for k in range(-(-len(numbers) // folder_books))]}, pa.schema([("folder", pa.string())]))

    # Only the folders of tasks whose results count are seen by readers.
    done = rows.select("book", "text").mapInArrow(run, "folder string").collect()
    for k, r in enumerate(done):
        os.rename(f"{place}/{r.folder}", f"{place}/folder={k}")


def _write_books_to_store(df: DataFrame, path: str, key: str, folder_books: int) -> None:
    """The same by Spark's own writer: a task's files are in one folder, which is renamed as a whole when the job commits."""
    rows = df.select(F.col(key).alias("key"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), "text")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("row", "text"))), lambda r: F.coalesce(r["text"], F.lit("")))
    dealt = rows.repartition(-(-rows.count() // folder_books) or 1, "part", "key")
    (dealt.groupBy("part", "key").agg(F.array_join(lines, "\n").alias("value")).select("value", F.spark_partition_id().alias("folder"))
     .write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path))


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """``path`` as the machines' own file system names it, if it is there (on a cluster: mounted by all)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(place).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _empty_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``book_name`` of the files of zero bytes, which a scan skips: those that Spark's file index lists and a
    scan of names and lengths (no content is read) does not."""
    scan = spark.read.format("binaryFile").load(path, pathGlobFilter=pattern)
    listed = spark.createDataFrame([(f, unquote(f.rsplit("/", 1)[-1])) for f in scan.inputFiles()], "file string, book_name string")

    def place(c):  # file:/x and file:///x are one place
        return F.regexp_replace(c, "^([A-Za-z0-9+.-]+):/+", "$1:/").alias("file")

    return listed.select(place("file"), "book_name").join(scan.select(place(F.col("_metadata.file_path"))), "file", "left_anti").select("book_name")


def read_book_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A4: one JSON array of ``{book_name, categories}`` objects; ``categories``
    may be a list or a plain string.  Returns ``book_name, categories`` (list)
    and ``categories_text`` (the plain string, else NULL)."""
    schema = T.StructType([T.StructField("book_name", T.StringType()),
                           T.StructField("categories", T.StringType())])
    df = spark.read.option("multiLine", True).schema(schema).json(path)
    raw = F.col("categories")
    is_list = F.startswith(F.ltrim(raw), F.lit("["))
    return df.select(
        "book_name",
        F.when(is_list, F.from_json(raw, "array<string>")).otherwise(F.array(raw)).alias("categories"),
        F.when(~is_list, raw).alias("categories_text"))


def read_tokenized_books(spark: SparkSession, path: str) -> DataFrame:
    """JSONL books with ``tokens`` id lists (``label`` from the partition path if written by B4)."""
    return spark.read.schema(TOKENIZED_BOOK_SCHEMA).json(path)


def write_corpus(df: DataFrame, path: str, by_subset: bool = False, mode: str = "overwrite") -> None:
    """B1: JSONL with ``subset, text, hash``; non-ASCII text is written as is."""
    w = df.select("subset", "text", "hash").write.mode(mode)
    if by_subset:
        w = w.partitionBy("subset")
    w.json(path)


def json_string(c) -> Column:
    """B2 encoding: the JSON string literal of a text (quotes and escapes)."""
    c = F.col(c) if isinstance(c, str) else c
    encoded = F.to_json(F.array(c))
    return F.substring(encoded, F.lit(2), F.length(encoded) - 2)


def write_json_strings(df: DataFrame, path: str, text_col: str = "text", mode: str = "overwrite") -> None:
    """B2: one JSON string per line (one line per document)."""
    df.select(json_string(text_col).alias("value")).write.mode(mode).text(path)


def write_raw_lines(df: DataFrame, path: str, raw_col: str = "raw", mode: str = "overwrite") -> None:
    """The kept input lines, unchanged."""
    df.select(F.col(raw_col).alias("value")).write.mode(mode).text(path)


def write_tokenized_books(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Books with metadata and ``tokens``, one directory per class (``label=``)."""
    df.write.mode(mode).partitionBy("label").json(path)


def with_counters(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Run counters gathered while the job runs (no extra pass over the data).
    ``Observation.get`` returns them after the first action."""
    obs = Observation(name)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs


def json_list(arr) -> Column:
    """A JSON list of strings, items separated by ``", "`` (Python ``json.dumps`` layout)."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    return F.concat(F.lit("["), F.array_join(F.transform(arr, json_string), ", "), F.lit("]"))


def process_jsonl(c, cleaner) -> Column:
    """JSON string in -> cleaner -> JSON list of paragraphs out."""
    return json_list(cleaner(decode_json_string(c)))


def write_pile_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Documents (``subset, text``) as Pile-style JSONL (``text``, ``meta.pile_set_name``)."""
    df.select("text", F.struct(F.col("subset").alias("pile_set_name")).alias("meta")).write.mode(mode).json(path)
