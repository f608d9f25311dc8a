"""Vocabulary, encoding and token-ratio operators.

* The vocabulary is a ``groupBy(token).count()`` (map-side combined, so a hot
  token such as "the" costs one row per partition, not one per occurrence),
  pruned by a count histogram, then ranked by a distributed global rank.
* It has at most ``VOCAB_SIZE`` rows by construction, so it is sent to every
  task once and each text is scored where it is: ids, unknown counts and piece
  counts are narrow (no shuffle), by an Arrow-batched lookup of the token
  lists that the JVM makes.
* The gates also take a BPE model (``subword.BpeModel``): its bounded merge list
  goes to every task and makes the pieces of any token, so no vocabulary is too
  large.  Piece tables of any size go through a join of (row, token) counts
  instead (``token_char_ratios``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.segment import prefix_sums
from textmill.functions.tokens import word_tokens

PAD, UNK = "<pad>", "<unk>"
PAD_ID, UNK_ID = 0, 1
VOCAB_SIZE = 2**16
MIN_FREQ = 2**3
#: Tokens that a task works on at a time; longer single lists are taken alone.
SLICE_TOKENS = 2**18


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """1-based rank over the whole DataFrame in ``order`` without a single task.

    A range-partitioned sort, per-partition row counts (one row per partition,
    broadcast) and their running offsets.  The sorted data is checkpointed
    first so that both uses see the same partitions.
    """
    from textmill.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    s = (df.orderBy(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_pos", F.monotonically_increasing_id() - F.spark_partition_id().cast("long") * (1 << 33))
         .checkpoint())
    sizes = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (s.join(F.broadcast(offs), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("long"))
            .drop("_pid", "_pos", "_off"))


def token_rows(df: DataFrame, keys: list[str], text_col: str = "text", pos: bool = False) -> DataFrame:
    """One row per word token (``token`` column, ``pos`` if asked)."""
    toks = word_tokens(F.col(text_col))
    if pos:
        return df.select(*keys, F.posexplode(toks).alias("pos", "token"))
    return df.select(*keys, F.explode(toks).alias("token"))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Token frequencies over a corpus: ``token, freq``."""
    return token_rows(docs, [], text_col).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))


def build_vocab(docs: DataFrame, text_col: str = "text", vocab_size: int = VOCAB_SIZE,
                min_freq: int = MIN_FREQ) -> DataFrame:
    """``token, id, freq``; ``<pad>``=0, ``<unk>``=1, then the most frequent
    tokens with at least ``min_freq`` occurrences (ties by token), up to
    ``vocab_size`` entries including the two specials."""
    return rank_vocab(word_counts(docs, text_col), vocab_size, min_freq)


def rank_vocab(counts: DataFrame, vocab_size: int = VOCAB_SIZE, min_freq: int = MIN_FREQ) -> DataFrame:
    """G2 from ``token, freq`` counts."""
    from textmill.session import checkpoint_dir

    spark = counts.sparkSession
    checkpoint_dir(spark)
    # The counts (one row per distinct frequent token) are materialised in the shared
    # checkpoint folder for the histogram and the ranking below.
    counts = counts.where(F.col("freq") >= min_freq).checkpoint()
    k = vocab_size - 2
    # Prune with the count histogram first: only tokens whose count reaches
    # the k-th largest count can enter the vocabulary.
    hist = counts.groupBy("freq").agg(F.count(F.lit(1)).alias("n"))
    cum = hist.select("freq", F.sum("n").over(Window.orderBy(F.desc("freq"))).alias("cum"))
    cut = cum.agg(F.max(F.when(F.col("cum") >= k, F.col("freq")))).first()[0]
    cand = counts if cut is None else counts.where(F.col("freq") >= cut)
    ranked = global_rank(cand, F.desc("freq"), F.asc("token"))
    words = ranked.where(F.col("rank") <= k).select("token", (F.col("rank") + 1).cast("int").alias("id"), "freq")
    specials = spark.createDataFrame([(PAD, PAD_ID, 0), (UNK, UNK_ID, 0)], "token string, id int, freq long")
    # At most vocab_size rows: materialised once, so that its size check and
    # every join that uses it read the result instead of re-ranking.
    return specials.unionByName(words).checkpoint()


def load_or_build_vocab(docs: DataFrame, path: str, **kw) -> DataFrame:
    """The vocabulary artefact at ``path`` (parquet); built from ``docs``
    and saved there first if it does not exist yet."""
    from textmill.operators.dedup import _exists

    spark = docs.sparkSession
    if not _exists(spark, path):
        build_vocab(docs, **kw).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_shard_counts(docs: DataFrame, path: str, shard: str, text_col: str = "text") -> None:
    """B5, mergeable: the token counts of one shard, all of them, saved under its name.  A shard that
    is saved again replaces its own counts only."""
    (word_counts(docs, text_col).withColumn("shard", F.lit(shard)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path))


def vocab_from_shards(spark, path: str, vocab_size: int = VOCAB_SIZE, min_freq: int = MIN_FREQ) -> DataFrame:
    """G2 from the saved counts of all shards: the vocabulary of their texts together, without reading a
    text again.  A new shard costs its own counts and the sums."""
    summed = spark.read.parquet(path).groupBy("token").agg(F.sum("freq").alias("freq"))
    return rank_vocab(summed, vocab_size, min_freq)


def in_slices(fn, lists: pa.ListArray, *more: pa.Array) -> pa.Array:
    """``fn`` of the rows of an Arrow batch, SLICE_TOKENS list items at a time, so that what it makes on the way
    stays small however long the lists are."""
    offs = lists.offsets.to_numpy() if len(lists) else np.zeros(1, int)
    parts, at = [], 0
    while at < len(lists) or not parts:
        to = min(len(lists), max(at + 1, int(np.searchsorted(offs, offs[at] + SLICE_TOKENS, "right")) - 1))
        parts.append(fn(*(a.slice(at, to - at) for a in (lists, *more))))
        at = to
    return pa.concat_arrays(parts)


class Lookup:
    """A token table small enough to be sent to every task: sorted tokens and a number for each."""

    def __init__(self, rows: DataFrame, value: str, limit: int = VOCAB_SIZE):
        found = rows.select("token", F.col(value).cast("int").alias("v")).limit(limit + 1).toArrow()
        if found.num_rows > limit:
            raise ValueError(f"a lookup table may have at most {limit} rows")
        self.shipped = rows.sparkSession.sparkContext.broadcast(
            (found["token"].combine_chunks(), found["v"].to_numpy().astype("int32")))

    def column(self, tokens: Column, returns: str, fn) -> Column:
        """Apply ``fn(token lists, values or -1, token array)`` to Arrow batches of token lists."""
        shipped = self.shipped

        def own(lists: pa.ListArray) -> pa.Array:
            names, values = shipped.value
            flat = lists.flatten()
            at = pc.index_in(flat, value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
            found = np.where(at >= 0, values[at], -1) if len(values) else np.full(len(flat), -1, "int32")
            return fn(lists, found.astype("int32"), flat)

        @F.arrow_udf(returns)
        def run(lists: pa.Array) -> pa.Array:
            return in_slices(own, pa.concat_arrays([lists]))

        return run(tokens)


def _sums(lists: pa.ListArray, values: np.ndarray) -> np.ndarray:
    """The sum of each list's values."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    offs = lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else np.zeros(1, int)
    return total[offs[1:]] - total[offs[:-1]]


def _ids(lists, found, _):
    offs = pa.array(lists.offsets.to_numpy() - lists.offsets[0].as_py(), pa.int32()) if len(lists) else pa.array([0], pa.int32())
    return pa.ListArray.from_arrays(offs, pa.array(np.where(found < 0, UNK_ID, found), pa.int32()))


def _unknown(lists, found, _):
    n = pc.list_value_length(lists).cast(pa.int64())
    return pa.StructArray.from_arrays([n, pa.array(_sums(lists, (found <= UNK_ID).astype(np.int64)))], names=["n_tokens", "n_unk"])


def _pieces(lists, found, flat):
    own = np.where(found < 0, pc.utf8_length(flat).to_numpy(zero_copy_only=False), found)
    return pa.array(_sums(lists, own))


def encode(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text_col: str = "text",
           max_len: int | None = None, pad_to: int = VOCAB_SIZE) -> DataFrame:
    """G3 + F7: ``key, ids, n_pad``: ids in text order (``<unk>`` as default); the
    left padding to ``pad_to`` stays virtual (``n_pad`` pad ids).  A text without
    tokens has no ids, only padding.  ``max_len`` truncates (off)."""
    toks = word_tokens(F.coalesce(F.col(text_col), F.lit("")))
    toks = toks if max_len is None else F.slice(toks, 1, max_len)
    ids = Lookup(vocab, "id").column(toks, "array<int>", _ids)
    return docs.select(key, ids.alias("ids")).withColumn("n_pad", F.greatest(F.lit(0), F.lit(pad_to) - F.size("ids")))


def with_unk_ratio(docs: DataFrame, vocab: DataFrame, text_col: str = "text", pad_to: int | None = None,
                   head_chars: int | None = None) -> DataFrame:
    """Adds ``n_tokens, n_unk, unk_ratio`` to every row, in place (no shuffle).

    Rows without tokens get a NULL ratio (the reference divides by zero).
    ``pad_to`` reproduces a tokenizer saved with padding: the denominator is
    then ``max(pad_to, n_tokens)`` and only the first ``pad_to`` tokens count.
    ``head_chars`` scores only the first so many characters.  Both are off.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    toks = word_tokens(text if head_chars is None else F.substring(text, 1, head_chars))
    toks = toks if pad_to is None else F.slice(toks, 1, pad_to)
    counted = docs.withColumn("_u", Lookup(vocab, "id").column(toks, "struct<n_tokens:bigint,n_unk:bigint>", _unknown))
    n = F.col("_u.n_tokens")
    denom = n if pad_to is None else F.greatest(n, F.lit(pad_to))
    return counted.select(*docs.columns, n.alias("n_tokens"), F.col("_u.n_unk").alias("n_unk"),
                          F.when(n > 0, F.col("_u.n_unk") / denom).alias("unk_ratio"))


def unk_ratios(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``key, n_tokens, n_unk, unk_ratio`` per document."""
    return with_unk_ratio(docs.select(key, text_col), vocab, text_col, **kw).drop(text_col)


_RATIO = ("n_tokens", "n_unk", "unk_ratio")


def unk_cut(docs: DataFrame, vocab: DataFrame, max_unk_ratio: float = 0.1, **kw) -> DataFrame:
    """Keep documents with ``unk_ratio <= max_unk_ratio`` (NULL dropped)."""
    return with_unk_ratio(docs, vocab, **kw).where(F.col("unk_ratio") <= max_unk_ratio).drop(*_RATIO)


def language_filter(docs: DataFrame, vocab: DataFrame, unk_threshold: float = 0.05, **kw) -> DataFrame:
    """Keep documents with ``unk_ratio < unk_threshold`` (the passing ones)."""
    return with_unk_ratio(docs, vocab, **kw).where(F.col("unk_ratio") < unk_threshold).drop(*_RATIO)


# ---------------------------------------------------------------------------
# Token / character ratio
# ---------------------------------------------------------------------------

def piece_table(vocab: DataFrame) -> DataFrame:
    """G5 piece model: a vocabulary word is one piece; any other token falls
    back to one piece per character.  ``token, pieces`` for the known words."""
    return vocab.where(F.col("id") > UNK_ID).select("token", F.lit(1).alias("pieces"))


def _piece_source(pieces):
    """Where the gates look up the pieces of a token: a piece table of at most VOCAB_SIZE rows, or a model that
    makes the pieces of any token (``subword.BpeModel``)."""
    return Lookup(pieces, "pieces") if isinstance(pieces, DataFrame) else pieces


def token_char_ratios(rows: DataFrame, keys: list[str], pieces: DataFrame, text_col: str = "text") -> DataFrame:
    """``keys, n_chars, n_pieces, ratio`` (pieces per character), for piece
    tables of any size; an empty text has no ratio.  Tokens are counted per row before the join, so a
    token is one row per text, however often the text has it."""
    counts = token_rows(rows, keys, text_col).groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("n"))
    summed = (counts.join(pieces, "token", "left")
              .groupBy(*keys).agg(F.sum(F.col("n") * F.coalesce(F.col("pieces"), F.length("token"))).cast("long").alias("n_pieces")))
    base = rows.select(*keys, F.length(text_col).alias("n_chars"))
    return (base.join(summed, keys, "left")
            .withColumn("n_pieces", F.coalesce(F.col("n_pieces"), F.lit(0)))
            .withColumn("ratio", F.try_divide("n_pieces", "n_chars")))


def redundancy_filter(rows: DataFrame, pieces, text_col: str = "text", threshold: float = 0.25) -> DataFrame:
    """Keep rows whose token/char ratio is below ``threshold``.  Narrow: ``pieces`` is a piece table
    of at most VOCAB_SIZE rows or a BPE model for texts of any vocabulary.  Empty texts have no ratio and go."""
    n = _piece_source(pieces).column(word_tokens(F.coalesce(F.col(text_col), F.lit(""))), "bigint", _pieces)
    return (rows.withColumn("_n", n).where(F.try_divide("_n", F.length(text_col)) < threshold).drop("_n"))


def window_bad_share(docs: DataFrame, pieces, width: int, sp_filter_ratio: float,
                     text_col: str = "text") -> DataFrame:
    """G8 over E10 windows: adds ``n_windows, bad_share`` to every row, where a
    window of ``width`` chars is bad if its token/char ratio exceeds
    ``sp_filter_ratio``.  Narrow (``pieces`` as in :func:`redundancy_filter`); an empty text
    has no windows and a NULL share."""
    from textmill.functions.segment import char_windows

    lookup = _piece_source(pieces)
    # One list holds the tokens of all windows; the windows' token counts cut it up again.
    wins = docs.withColumn("_w", char_windows(F.coalesce(F.col(text_col), F.lit("")), width))
    toks = wins.withColumn("_t", F.transform("_w", word_tokens))

    def by_window(lists, found, flat):
        own = np.where(found < 0, pc.utf8_length(flat).to_numpy(zero_copy_only=False), found)
        offs = lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else np.zeros(1, int)
        return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(own, pa.int32()))

    each = lookup.column(F.flatten("_t"), "array<int>", by_window)
    scored = toks.select(*docs.columns, F.transform("_w", F.length).alias("_l"), F.transform("_t", F.size).alias("_k"), each.alias("_p"))
    ends = prefix_sums("_k")
    sums = F.transform(F.arrays_zip(ends.alias("e"), F.col("_k").alias("k")), lambda x: F.aggregate(
        F.slice(F.col("_p"), x["e"] - x["k"] + 1, x["k"]), F.lit(0), lambda a, b: a + b))
    bad = F.filter(F.zip_with(sums, "_l", lambda p, n: p / n > sp_filter_ratio), lambda x: x)
    n = F.size("_l").cast("long")
    return scored.select(*docs.columns, n.alias("n_windows"), F.when(n > 0, F.size(bad) / n).alias("bad_share"))


def redundancy_gate(docs: DataFrame, pieces, width: int, sp_filter_ratio: float = 0.3,
                    max_bad_share: float = 0.10, text_col: str = "text") -> DataFrame:
    """Drop documents whose share of bad windows is greater than 0.10."""
    return (window_bad_share(docs, pieces, width, sp_filter_ratio, text_col)
            .where(~(F.coalesce(F.col("bad_share"), F.lit(0.0)) > max_bad_share)).drop("n_windows", "bad_share"))
