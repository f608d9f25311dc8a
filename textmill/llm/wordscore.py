"""Cross-entropy difference scores from matched word n-gram models that grow with the corpus.

Words are the white-space separated parts of a text, as they stand.  The target model is counted over
the target documents, the background model over all documents; both are bigram models of the same form
over one vocabulary, all words of all documents and one unknown word:

    p(w) = (c(w) + UNSEEN) / (N + UNSEEN * V),    p(w | v) = (c(v w) + PRIOR * p(w)) / (c(v .) + PRIOR)

where v is the word before w (or the edge of the text).  A word's loss is -log2 of its probability, a
document's score the mean over its words of background loss minus target loss (Moore and Lewis 2010).

Every word, context and bigram of every document is counted, none is dropped.  Documents are dealt into
chunks of about CHUNK_BYTES of text, in which a task takes SLICE_BYTES at a time.  A chunk sends its
distinct n-grams (62-bit hashes) with their counts to buckets of hashes, packed by (chunk, bucket): so an
n-gram, however common, is one entry of a chunk.  Buckets add up and answer each chunk with the counts of
its n-grams and their share of three sums (words, words of target documents, vocabulary); the chunk scores
its documents with them.  All this is one plan: texts are shuffled once, and what is counted and what is
scored reads the same exchange; only the size of the texts reaches the driver.  Chunks and buckets are
bounded, their number grows with the input.

Defined results: a null or empty text has no words, losses 0 and score 0; without target documents the
target model is uniform; rows are independent in scoring, repeated rows count repeatedly; a null id is
never a target; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.arrow import SLICE_BYTES, fresh, slices, strings, words
from textmill.llm.minhash import mix

#: The fewer chunks, the fewer entries: a larger chunk holds more of the places of an n-gram.
CHUNK_BYTES = 24 << 20
#: Small inputs are dealt into a chunk by shuffle partition, but none of less text.
LEAST_BYTES = 1 << 20
UNSEEN = 0.5
PRIOR = 16.0

#: The last two bits of an n-gram's hash.
WORD, CONTEXT, BIGRAM = 0, 1, 2
EDGE = 0x5BD1E9955BD1E995

FIELDS = [T.StructField("n_tokens", T.LongType(), False), T.StructField("loss_target", T.DoubleType(), False),
          T.StructField("loss_background", T.DoubleType(), False), T.StructField("score", T.DoubleType(), False)]

CODEC = pa.Codec("zstd", 1)


def _packed(x: np.ndarray) -> bytes:
    """64-bit numbers as planes of bytes (only those in use), compressed."""
    planes = max(1, (int(x.max()).bit_length() + 7) // 8)
    data = np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T[:planes]).tobytes()
    return len(x).to_bytes(8, "little") + bytes([planes]) + CODEC.compress(data, asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n, planes = int.from_bytes(data[:8], "little"), data[8]
    out = np.zeros((n, 8), np.uint8)
    out[:, :planes] = np.frombuffer(CODEC.decompress(data[9:], n * planes, asbytes=True), np.uint8).reshape(planes, n).T
    return out.view(np.uint64).ravel()


class Grams:
    """The distinct n-grams of some texts in the order of their hashes, and each word's place among them."""

    def __init__(self, texts: pa.Array):
        rows, flat, _, _ = words(texts)
        self.sizes = np.diff(rows)
        coded = flat.dictionary_encode()
        del flat
        distinct = np.array([*coded.dictionary.to_pylist(), b""], dtype=object)[:-1]
        d = len(distinct)
        own = pd.util.hash_array(distinct, categorize=False).astype(np.uint64) if d else np.zeros(0, np.uint64)
        own = np.append(own, np.uint64(EDGE))
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.append(d, word)[: len(word)]
        before[rows[:-1][self.sizes > 0]] = d
        pairs, pair = np.unique(before * d + word, return_inverse=True)
        first, second = np.divmod(pairs, d) if d else (pairs, pairs)
        hashes = np.concatenate([self._tagged(own[:d], WORD), self._tagged(own, CONTEXT), self._tagged(mix(own[first]) + own[second], BIGRAM)])
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.hashes = hashes[order]
        self.word, self.context, self.bigram = rank[word], rank[d + before], rank[2 * d + 1 + pair]

    @staticmethod
    def _tagged(h: np.ndarray, kind: int) -> np.ndarray:
        return (mix(h) & ~np.uint64(3)) | np.uint64(kind)

    def counts(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """Occurrences of each n-gram in the texts that are chosen (default: in all)."""
        on = slice(None) if chosen is None else np.repeat(chosen, self.sizes)
        return sum(np.bincount(at[on], minlength=len(self.hashes)) for at in (self.word, self.context, self.bigram))


class Chunk:
    """The distinct n-grams of a chunk's texts, which are taken some ``limit`` bytes at a time."""

    def __init__(self, docs: pa.Table, text_col: str, limit: int = SLICE_BYTES):
        self.parts = [Grams(strings(part[text_col])) for batch in docs.select([text_col]).to_batches() for part in slices(batch, text_col, limit)]
        hashes = np.sort(np.concatenate([np.zeros(0, np.uint64), *(p.hashes for p in self.parts)]))  # np.unique would hash them
        self.hashes = hashes[np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]]
        #: Where the n-grams of each part are among those of the chunk.
        self.places = [np.searchsorted(self.hashes, p.hashes).astype(np.int32) for p in self.parts]

    def counts(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """Occurrences of each n-gram in the texts that are chosen (default: in all)."""
        out, at = np.zeros(len(self.hashes), np.int64), 0
        for p, place in zip(self.parts, self.places):
            own = None if chosen is None else chosen[at : at + len(p.sizes)]
            np.add.at(out, place, p.counts(own))
            at += len(p.sizes)
        return out


def _gather(bits: int, id_col: str, text_col: str, chunk: str):
    def run(docs: pa.Table, targets: pa.Table) -> pa.Table:
        out = {"bucket": [], "chunk": [], "hashes": [], "n": [], "target": []}
        if docs.num_rows:
            grams = Chunk(docs, text_col)
            good = set(targets["id"].to_pylist())
            everywhere, wanted = grams.counts(), grams.counts(np.array([k in good for k in docs[id_col].to_pylist()], bool))
            bucket = (grams.hashes >> np.uint64(64 - bits)).astype(np.int64)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, b in zip(starts, np.append(starts[1:], len(bucket))):
                out["bucket"].append(int(bucket[a]))
                out["chunk"].append(docs[chunk][0].as_py())
                out["hashes"].append(_packed(np.diff(grams.hashes[a:b], prepend=np.uint64(0))))
                out["n"].append(_packed(everywhere[a:b]))
                out["target"].append(_packed(wanted[a:b]))
        return pa.table(out, pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("n", pa.binary()), ("target", pa.binary())]))

    return run


def _add_up(chunks: int):
    """The blocks of a bucket with the sums of all of them; every chunk, also one without a block, gets
    the bucket's share of the vocabulary and of the words."""
    def run(blocks: pa.Table) -> pa.Table:
        hashes = [np.cumsum(_unpacked(b.as_py()), dtype=np.uint64) for b in blocks["hashes"]]
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        distinct, of = np.unique(np.concatenate(hashes), return_inverse=True)
        del hashes
        single = (distinct & np.uint64(3)) == WORD
        others = np.setdiff1d(np.arange(chunks), blocks["chunk"].to_numpy())
        rows = blocks.num_rows + len(others)
        out = {"bucket": pa.array(np.repeat(blocks["bucket"][0].as_py(), rows)), "chunk": pa.array(np.append(blocks["chunk"].to_numpy(), others))}
        sums = {"kinds": int(single.sum())}
        for name in ("n", "target"):
            own = np.concatenate([_unpacked(b.as_py()) for b in blocks[name]])
            total = np.bincount(of, weights=own, minlength=len(distinct))
            out[name] = pa.array([*(_packed(x) for x in np.split(total[of], ends)), *[None] * len(others)], pa.binary())
            sums[f"all_{name}"] = int(total[single].sum())
        return pa.table(out | {name: pa.array(np.full(rows, value, np.int64)) for name, value in sums.items()})

    return run


def _score(kept: list[str], text_col: str):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Chunk(docs, text_col)
        vocabulary = sum(answers["kinds"].to_pylist()) + 1
        total = {name: sum(answers[f"all_{name}"].to_pylist()) for name in ("target", "n")}
        answers = answers.filter(pc.is_valid(answers["n"])).sort_by("bucket")
        counts = {name: np.concatenate([np.zeros(0, np.uint64), *(_unpacked(b.as_py()) for b in answers[name])]).astype(np.float64) for name in total}
        made = [[np.zeros(0, np.int64)], *([np.zeros(0)] for _ in range(3))]
        for part, at in zip(grams.parts, grams.places):
            row = np.repeat(np.arange(len(part.sizes)), part.sizes)
            losses = []
            for name in total:
                c = counts[name][at]
                p = (c[part.word] + UNSEEN) / (total[name] + UNSEEN * vocabulary)
                p = (c[part.bigram] + PRIOR * p) / (c[part.context] + PRIOR)
                losses.append(np.bincount(row, weights=-np.log2(p), minlength=len(part.sizes)) / np.maximum(part.sizes, 1))
            for column, x in zip(made, (part.sizes.astype(np.int64), *losses, losses[1] - losses[0])):
                column.append(x)
        own = {c: docs[c] for c in kept}
        return pa.table(own | {f.name: pa.array(np.concatenate(m)) for f, m in zip(FIELDS, made)})

    return run


def scores(df: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without its text, with ``n_tokens``, ``loss_target`` and ``loss_background`` (mean bits by
    word) and ``score``; target documents are those whose id is one of ``targets``' only column."""
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    chunks = max(-(-size // CHUNK_BYTES), min(-(-size // LEAST_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions"))), 1)
    bits = (chunks - 1).bit_length() + 1
    new = {f.name for f in FIELDS}
    kept = [c for c in df.columns if c != text_col and c.lower() not in new]
    chunk = fresh(df, "chunk")

    def place(key):
        return F.pmod(F.xxhash64(key), F.lit(chunks)).cast("long").alias(chunk)

    # Rows without an id are dealt by their text.
    docs = df.select(*kept, text_col, F.when(F.col(id_col).isNull(), place(F.col(text_col))).otherwise(
        place(F.col(id_col).cast("string"))).alias(chunk))
    wanted = targets.select(F.col(targets.columns[0]).cast(df.schema[id_col].dataType).alias("id")).where("id IS NOT NULL").distinct()
    wanted = wanted.select("id", place(F.col("id").cast("string")))
    # Both groupings of the documents are the same exchange, with all columns: Spark runs it once.
    dealt = docs.groupBy(chunk)
    blocks = dealt.cogroup(wanted.groupBy(chunk)).applyInArrow(
        _gather(bits, id_col, text_col, chunk), "bucket long, chunk long, hashes binary, n binary, target binary")
    answers = blocks.groupBy("bucket").applyInArrow(
        _add_up(chunks), "bucket long, chunk long, n binary, target binary, kinds long, all_n long, all_target long")
    schema = T.StructType([df.schema[c] for c in kept] + FIELDS)
    return dealt.cogroup(answers.groupBy("chunk")).applyInArrow(_score(kept, text_col), schema)
