"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters.  An item's
windows are all its ``window`` consecutive words, or all its words if it has fewer.  Tasks scan
the word windows of each document against the hash set and verify each hit word by word.  A
document word inside any occurrence of a window is hit.

The benchmark is read by the driver in blocks of at most BLOCK_BYTES of text (a longer single item
forms its own block); a larger benchmark is scanned block by block and no item is left out.  The rows
are saved after each block but the last, and its broadcast is destroyed, so a worker holds one block at a time.

Defined results: a null, blank or wordless text has no words and no hits; wordless and null items
have no windows; equal items are all reported; the benchmark may be empty; input columns named as
the outputs (``n_words``, ``n_hit``, ``item_ids``, ``spans``) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.arrow import lists, map_text, ragged, raw, strings, words
from textmill.llm.store import saved

WINDOW = 10
BLOCK_BYTES = 16 << 20

#: A-Z to a-z; every ASCII byte that is no letter or digit to a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_hit", T.LongType(), False),
    T.StructField("item_ids", T.ArrayType(T.LongType(), False), False),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType(), False),
                                                     T.StructField("end", T.IntegerType(), False)]), False), False),
]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _hashed(columns: Iterable[np.ndarray], n: int) -> np.ndarray:
    """A hash of the ``n`` ids of each window, given by position."""
    h = np.uint64(n)
    for ids in columns:
        h = _mix(h + ids.astype(np.uint64) + np.uint64(1))
    return h


class WindowSet:
    """The windows of one block of items: vocabulary, hash set and exact contents."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        rows, flat, _, _ = words(strings(pa.array([t for _, t in items], pa.string())), WORD_BYTES)
        coded = flat.dictionary_encode()
        self.vocabulary = coded.dictionary
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.diff(rows)
        names = np.array([i for i, _ in items], np.int64)
        self.items = np.unique(names[counts > 0])
        self.by_length = {}
        lengths = np.minimum(counts, window)
        for n in np.unique(lengths[lengths > 0]).tolist():
            own = np.flatnonzero(lengths == n)
            many = counts[own] - n + 1
            content, inverse = np.unique(ids[ragged(rows[own], many)[:, None] + np.arange(n)], axis=0, return_inverse=True)
            hashes = _hashed(content.T, n)
            order = np.argsort(hashes, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            pairs = np.unique(np.stack([place[inverse.ravel()], np.searchsorted(self.items, np.repeat(names[own], many))], axis=1), axis=0)
            first = np.searchsorted(pairs[:, 0], np.arange(len(order) + 1))
            # Windows of equal hash (if any) follow one another; all of them are compared.
            self.by_length[n] = (hashes[order], content[order], first[:-1], np.diff(first), pairs[:, 1].copy())

    def hits(self, flat: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hit flag by word, document and item number of each distinct occurrence pair)."""
        hit = np.zeros(len(flat) + 1, np.int64)
        docs, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(flat) and len(self.vocabulary):
            code = pc.fill_null(pc.index_in(flat, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            missing = np.append(0, np.cumsum(code < 0))
            row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            for n, (hashes, content, first, counts, who) in self.by_length.items():
                if len(code) < n:
                    continue
                at = np.flatnonzero((missing[n:] == missing[:-n]) & (row[n - 1 :] == row[: len(row) - n + 1]))
                if not len(at):
                    continue
                h = _hashed((code[at + k] for k in range(n)), n)
                slot = np.searchsorted(hashes, h)
                while True:
                    ok = slot < len(hashes)
                    ok[ok] = hashes[slot[ok]] == h[ok]
                    at, h, slot = at[ok], h[ok], slot[ok]
                    if not len(at):
                        break
                    same = (code[at[:, None] + np.arange(n)] == content[slot]).all(axis=1)
                    good, where = at[same], slot[same]
                    np.add.at(hit, good, 1)
                    np.add.at(hit, good + n, -1)
                    docs.append(np.repeat(row[good], counts[where]))
                    found.append(who[np.repeat(first[where] - np.append(0, np.cumsum(counts[where]))[:-1], counts[where]) + np.arange(counts[where].sum())])
                    slot = slot + 1
        pairs = np.unique(np.stack([np.concatenate(docs), np.concatenate(found)], axis=1), axis=0)
        return np.cumsum(hit)[:-1] > 0, pairs[:, 0], pairs[:, 1]


def _scan(found: WindowSet, texts: pa.Array, *prior: pa.Array) -> list[pa.Array]:
    """The output columns; ``prior`` are the item ids and spans of the blocks before, to be united."""
    rows, flat, starts, ends = words(texts, WORD_BYTES)
    offs, data = raw(texts)
    hit, docs, items = found.hits(flat, rows)
    items = found.items[items]
    n = len(rows) - 1
    row = np.repeat(np.arange(n), np.diff(rows))
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80)) if len(prior) or hit.any() else np.zeros(len(data) + 1, np.int64)
    base = points[offs[:-1]]
    if prior:
        before, runs = (pa.concat_arrays([p]) for p in prior)
        docs = np.concatenate([docs, np.repeat(np.arange(n), pc.list_value_length(before).to_numpy())])
        items = np.concatenate([items, before.flatten().to_numpy()])
        own = np.repeat(base, pc.list_value_length(runs).to_numpy())
        at = runs.flatten()
        mark = np.zeros(len(row) + 1, np.int64)
        np.add.at(mark, np.searchsorted(points[starts], own + at.field("start").to_numpy()), 1)
        np.add.at(mark, np.searchsorted(points[starts], own + at.field("end").to_numpy()), -1)
        hit = hit | (np.cumsum(mark)[:-1] > 0)
    pairs = np.unique(np.stack([docs, items], axis=1), axis=0)
    item_list = lists(np.searchsorted(pairs[:, 0], np.arange(n + 1)), pa.array(np.ascontiguousarray(pairs[:, 1]), pa.int64()))
    # Spans run from the first to the last of adjacent hit words, in code points of the text.
    edge = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    begin = np.flatnonzero(hit & ~(np.append(False, hit)[:-1] & ~np.append(True, edge)[:-1]))
    end = np.flatnonzero(hit & (edge | ~np.append(hit, False)[1:]))
    spans = pa.StructArray.from_arrays(
        [pa.array((points[starts[begin]] - base[row[begin]]).astype(np.int32)),
         pa.array((points[ends[end]] - base[row[begin]]).astype(np.int32))],
        fields=[pa.field("start", pa.int32(), False), pa.field("end", pa.int32(), False)])
    return [pa.array(np.diff(rows)), pa.array(np.bincount(row[hit], minlength=n).astype(np.int64)), item_list,
            lists(np.searchsorted(row[begin], np.arange(n + 1)), spans)]


def scan(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Append ``n_words``, ``n_hit`` (hit words), ``item_ids`` (sorted, distinct) and ``spans``
    (maximal runs of hit words, code points, end exclusive) to each row."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    spread = F.pmod(F.xxhash64("i", "t"), F.lit(blocks))
    for k in range(blocks):
        block = [(r.i, r.t) for r in items.where(spread == k).collect()]
        shipped = df.sparkSession.sparkContext.broadcast(WindowSet(block, window))
        df = map_text(df, text_col, lambda *columns, s=shipped: _scan(s.value, *columns), FIELDS, also=("item_ids", "spans") if k else (), limit=1 << 20)
        if k + 1 < blocks:
            df = saved(df, "scanned")
            shipped.destroy()
    return df


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without its ``spans``: the pieces between them, joined."""
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.array_join(F.zip_with(starts, ends, lambda s, e: F.substring(text, e + 1, s - e)), ""))


def remove_spans(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of :func:`scan` with the contaminated spans cut out of their texts."""
    return scanned.withColumn(text_col, without_spans(F.col(text_col), F.col("spans")))


def remove_documents(scanned: DataFrame) -> DataFrame:
    """Rows of :func:`scan` without a hit word."""
    return scanned.where(F.col("n_hit") == 0)
