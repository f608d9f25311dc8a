"""Language ID by prediction by partial matching (PPM).

Per language a variable-order byte context tree (contexts of up to ``order`` bytes) with method C
escape probabilities and exclusions gives each next byte a probability; a document's score under a
language is its exact code length, the sum of -log2 of these, with the statistics frozen after
training.  The language with the shortest code wins.

Training counts come from a bounded sample of labelled rows: of each language, the rows whose id
hash lies below ``sample_docs`` / rows, so about ``sample_docs`` whole texts (all, if fewer).  The
trees of all languages share one set of contexts, at most MAX_CELLS / (bytes x languages) of them,
the most frequent ones; rarer contexts use their longest kept suffix.  So the model that is sent to
the tasks is bounded whatever the corpus.

Defined results: a null text or one without a letter is ``und`` with score 0; equal code lengths go
to the language that sorts first; without labelled rows every text is ``und``; rows are independent;
an empty table gives an empty table; input columns named as the outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.arrow import fresh, map_text, raw, slices, strings

ORDER = 3
SAMPLE_DOCS = 1000
MAX_CELLS = 1 << 24
UNDETERMINED = "und"

FIELDS = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False),
          T.StructField("bits_per_byte", T.DoubleType(), False)]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Counts:
    """Frozen statistics: (language, context length, context and byte as one code, count)."""

    languages: list[str]
    order: int
    lang: np.ndarray
    length: np.ndarray
    code: np.ndarray
    n: np.ndarray

    @cached_property
    def model(self) -> Model:
        """The scoring tables, built once in each Python worker."""
        return Model(self)


def train(df: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", order: int = ORDER,
          sample_docs: int = SAMPLE_DOCS) -> Counts:
    """Count the byte contexts of each language over the training sample.

    Rows with a null language or text teach nothing.  One row per distinct context and byte of the
    bounded sample reaches the driver.
    """
    if not 1 <= order <= 6:
        raise ValueError("order must be 1 to 6")
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("l"), F.col(text_col).alias("t"), F.col(id_col).alias("i"))
    sizes = {r.l: r["count"] for r in rows.groupBy("l").count().collect()}
    languages = sorted(sizes)
    if not languages:
        none = np.zeros(0, np.int64)
        return Counts([], order, none, none, none, none)
    share = F.create_map(*(x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, sample_docs / sizes[lang])))))
    sample = rows.where(F.pmod(F.xxhash64("i"), F.lit(1 << 24)) < F.element_at(share, F.col("l")) * (1 << 24))

    def count(batches):
        for batch in (part for whole in batches for part in slices(whole, "t", 1 << 19)):
            texts, langs = strings(batch.column(1)), batch.column(0).dictionary_encode()
            offs, data = raw(texts)
            lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.uint64), np.diff(offs))
            place = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))
            for k in range(order + 1):
                code = np.zeros(max(len(data) - k, 0), np.uint64)
                for j in range(k + 1):
                    code = (code << np.uint64(8)) | data[j : len(data) - k + j].astype(np.uint64)
                whole = place[k:] >= k
                # Codes take 56 bits, so languages are counted 256 at a time.
                for first in range(0, len(langs.dictionary), 256):
                    mine = lang[k:] - np.uint64(first)
                    on = whole & (mine < 256)
                    key, n = np.unique(code[on] | (mine[on] << np.uint64(56)), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [langs.dictionary.take(pa.array((key >> np.uint64(56)).astype(np.int64) + first)), pa.array(np.full(len(key), k, np.int32)),
                         pa.array((key & np.uint64((1 << 56) - 1)).astype(np.int64)), pa.array(n.astype(np.int64))], names=["l", "k", "c", "n"])

    found = sample.select("l", "t").mapInArrow(count, "l string, k int, c bigint, n bigint").groupBy("l", "k", "c").agg(F.sum("n").alias("n")).toArrow()
    number = pc.index_in(found["l"], value_set=pa.array(languages)).to_numpy().astype(np.int64)
    return Counts(languages, order, number, *(found[c].to_numpy().astype(np.int64) for c in ("k", "c", "n")))


class Model:
    """The trees as tables: ``move`` (context, byte class) -> context, ``cost`` (context, byte class) -> bits by language."""

    def __init__(self, counts: Counts, max_cells: int = MAX_CELLS):
        self.languages, self.order = counts.languages, counts.order
        n_lang = len(self.languages)
        if not n_lang:
            return
        seen = np.unique(counts.code[counts.length == 0])
        self.classes = len(seen) + 2  # those bytes, any other byte, and the text edge
        other, edge = len(seen), len(seen) + 1
        self.of_byte = np.full(256, other, np.int64)
        self.of_byte[seen] = np.arange(len(seen))
        self.of_byte[0xFF] = edge  # never part of UTF-8: stands between texts
        # Contexts: those of some length k are the prefixes of the codes of that length.
        most = max(1, max_cells // (self.classes * n_lang))
        total: dict[tuple[int, int], int] = {(0, 0): int(counts.n.sum())}
        for k in range(1, self.order + 1):
            at = counts.length == k
            ctx, inverse = np.unique(counts.code[at] >> 8, return_inverse=True)
            sums = np.zeros(len(ctx), np.int64)
            np.add.at(sums, inverse, counts.n[at])
            total.update(zip(((k, c) for c in ctx.tolist()), sums.tolist()))
        ranked = sorted(total, key=lambda x: (-total[x], x))[:most]
        kept: dict[tuple[int, int], int] = {}
        for k, c in sorted(ranked):  # closed under leaving out the first or the last byte
            if k == 0 or (k - 1, c >> 8) in kept and (k - 1, c & ((1 << 8 * (k - 1)) - 1)) in kept:
                kept[k, c] = len(kept)
        states = len(kept)
        self.shorter = np.zeros(states, np.int64)
        for (k, c), s in kept.items():
            if k:
                self.shorter[s] = kept[k - 1, c & ((1 << 8 * (k - 1)) - 1)]
        self.move = np.zeros((states, self.classes), np.int64)
        for (k, c), s in kept.items():  # by length: the shorter context's row is complete
            if k:
                self.move[s] = self.move[self.shorter[s]]
            if k < self.order:
                for b, cls in zip(seen.tolist(), range(len(seen))):
                    to = kept.get((k + 1, c << 8 | b))
                    if to is not None:
                        self.move[s, cls] = to
        self.move[:, edge] = 0
        where = np.array([kept.get((k, c), -1) for k, c in zip(counts.length.tolist(), (counts.code >> 8).tolist())], np.int64)
        self.cost = np.zeros((states, self.classes, n_lang), np.float32)
        for lang in range(n_lang):
            own = (counts.lang == lang) & (where >= 0)
            n = np.zeros((states, self.classes), np.float64)
            np.add.at(n, (where[own], self.of_byte[counts.code[own] & 0xFF]), counts.n[own])
            self.cost[:, :, lang] = self._code_lengths(n, edge)
        self.cost = self.cost.reshape(states * self.classes, n_lang)

    def _code_lengths(self, n: np.ndarray, edge: int) -> np.ndarray:
        """-log2 of each byte's probability in each context, by method C with exclusions.

        All contexts escape to their next shorter one in step, until the root has been used.
        """
        out = np.zeros(n.shape)
        uncoded = np.ones(n.shape, bool)  # bytes coded in a longer context are excluded from shorter ones
        spent = np.zeros(len(n))  # bits of the escapes so far
        rows, at = np.arange(len(n)), np.arange(len(n))
        while len(rows):
            live = np.where(uncoded[rows], n[at], 0)
            total, distinct = live.sum(axis=1), (live > 0).sum(axis=1)
            whole = np.maximum(total + distinct, 1)
            hit = live > 0
            bits = spent[rows, None] - np.log2(np.where(hit, live, 1) / whole[:, None])
            out[rows] = np.where(hit, bits, out[rows])
            uncoded[rows] &= ~hit
            spent[rows] -= np.log2(np.where(distinct > 0, distinct / whole, 1))
            on = at != 0
            rows, at = rows[on], self.shorter[at[on]]
        # The last escape: all bytes that this language's tree lacks are equally likely.
        known = self.classes - 2
        left = np.maximum(256 - known + uncoded[:, :known].sum(axis=1), 1)
        out = np.where(uncoded, (spent + np.log2(left))[:, None], out)
        out[:, edge] = 0
        return out

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Code length in bits of each text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        if not len(texts):
            return out
        gap = self.order + 1
        _, data = raw(strings(texts))
        offs, _ = raw(strings(texts))
        sizes = np.diff(offs)
        starts = offs[:-1] + gap * np.arange(1, len(sizes) + 1)
        cls = np.full(len(data) + gap * (len(sizes) + 1), self.classes - 1, np.int64)
        # Text k begins after k + 1 edges, so no context reaches into its neighbour.
        shift = np.repeat(gap * np.arange(1, len(sizes) + 1), sizes)
        cls[np.arange(len(data)) + shift] = self.of_byte[data]
        state = np.zeros(len(cls), np.int64)
        flat = self.move.ravel()
        for _ in range(self.order):
            nxt = np.zeros(len(cls), np.int64)
            nxt[1:] = flat[state[:-1] * self.classes + cls[:-1]]
            state = nxt
        bits = self.cost[state * self.classes + cls]
        some = sizes > 0
        edges = np.stack([starts[some], starts[some] + sizes[some]], axis=1).ravel()
        if len(edges):
            out[some] = np.add.reduceat(bits, edges, axis=0, dtype=np.float64)[::2]
        return out


def _predict(model: Model, texts: pa.Array, letters: pa.Array) -> list[pa.Array]:
    sizes = np.maximum(np.diff(raw(texts)[0]), 1)
    some = letters.to_numpy(zero_copy_only=False).astype(bool)
    if not model.languages:
        n = len(texts)
        return [pa.array([UNDETERMINED] * n), pa.array(np.zeros(n)), pa.array(np.full(n, 8.0))]
    bits = model.lengths(texts)
    best = bits.argmin(axis=1)
    shortest = bits.min(axis=1)
    score = 1 / np.exp2(np.clip(shortest[:, None] - bits, -1000, 0)).sum(axis=1)
    names = pa.array([*model.languages, UNDETERMINED]).take(pa.array(np.where(some, best, len(model.languages))))
    return [names, pa.array(np.where(some, score, 0.0)), pa.array(shortest / sizes)]


def predict(df: DataFrame, counts: Counts, text_col: str = "text") -> DataFrame:
    """Append ``lang_pred``, ``score`` (the share of the winner in 2 ** -code length over the
    languages, 0 to 1) and ``bits_per_byte`` (the winner's code length by byte)."""
    shipped = df.sparkSession.sparkContext.broadcast(counts)
    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    mark = fresh(df, "letter")
    marked = df.withColumn(mark, letter)
    return map_text(marked, text_col, lambda t, has: _predict(shipped.value.model, t, has), FIELDS, also=(mark,), limit=1 << 18).drop(mark)
