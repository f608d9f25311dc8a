"""Phrase collocations by best-first branch and bound over n-gram counts.

Lower-cased texts are cut into pieces at punctuation and line ends, pieces into words.  A candidate is a
phrase of 2 to ``max_words`` words that occurs ``min_count`` times or more in its language.  Cut after its
first k words, with counts l of the first part and r of the rest, it scores floor(SCALE * a / (l + r));
its lowest-scoring cut counts.  A candidate inside a longer one that has at least ``cover`` percent of its
count is dropped.  The ``top`` best of each language are returned.

Growing a phrase on the right keeps its first word and cannot raise its count, so with f(w) the count of
that word no phrase that begins with p scores more than SCALE * f(p) / (f(w) + f(p)); the same holds from the
last word to the left.  A round takes a cut score for each language (best first: the score of its
FIRST * top-th best pair, then of four times as many), expands every phrase with a bound of at least the
cut by the words beside it, and so knows all candidates at or above the cut, their parts and all that
could cover them.  A language is settled when ``top`` phrases at or above the cut survive (all ties
are among them) or the cut is 0; the others go on with a lower cut.

An expansion is one pass over the texts of the unsettled languages: each task counts the n-grams of
a slice of text, so a common n-gram is one row of a slice, and keeps those of which both parts are
frequent and one is to be expanded.  Both sets reach the tasks as Bloom filters of FILTER_BITS bits,
whatever the size of the corpus; a false hit costs a row and changes no result.  Counts are exact.

Defined results: a null or empty text has no words; a null language is ``und``; repeated rows count
repeatedly; ties are broken by count, then by the phrase's bytes; other columns are ignored; an empty
table gives an empty table.  Texts are counted whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.arrow import raw, slices, strings
from textmill.llm.minhash import mix
from textmill.llm.store import saved

#: Bytes of text whose n-grams a task counts together.
SLICE = 4 << 20
SCALE = 2_000_000
UNDETERMINED = "und"
#: Bits of a filter sent to the tasks, probes of an entry, and bits of a part of it.
FILTER_BITS, PROBES, PART_BITS = 1 << 26, 3, 1 << 16
#: The first cut is the score of the FIRST * top-th best pair; each further one takes four times as many.
FIRST = 4

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
INSIDE, BLANK, BREAK = 0, 1, 2
#: A phrase without its last and without its first word.
HEAD, TAIL = "substring_index(gram, ' ', size(split(gram, ' ')) - 1)", "substring(gram, instr(gram, ' ') + 1)"
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words (binary or string): the sum of a mixed number for each (place, byte)."""
    words = pa.concat_arrays([words.cast(pa.large_binary()), pa.array([], pa.large_binary())])
    if not len(words):
        return np.zeros(0, np.uint64)
    _, offs, data = words.buffers()
    offs = np.frombuffer(offs, np.int64)[: len(words) + 1]
    if offs[-1] == offs[0]:
        return np.zeros(len(words), np.uint64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]]
    offs = offs - offs[0]
    place = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))
    total = np.append(np.uint64(0), np.cumsum(mix(((place << 8) | data).astype(np.uint64))))
    return mix(total[offs[1:]] - total[offs[:-1]])


def chained(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word; a language's hash begins the chain."""
    return mix(h * np.uint64(0x9E3779B97F4A7C15) + word)


def probes(h: np.ndarray, size: int) -> np.ndarray:
    """The places of each hash in a filter of ``size`` bits (a power of two), one row for each probe."""
    return np.stack([(mix(h + np.uint64(k)) & np.uint64(size - 1)).astype(np.int64) for k in range(PROBES)])


def held(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = probes(h, 8 * len(bits))
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def phrase_filter(phrases: DataFrame):
    """A broadcast Bloom filter of (lang, gram): its parts are made by Spark, at most FILTER_BITS reach the driver."""
    size = FILTER_BITS

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pc.split_pattern(batch.column("gram"), " ")
            h = hashed(batch.column("lang"))
            offs, words = lists.offsets.to_numpy().astype(np.int64), hashed(lists.flatten())
            offs = offs - offs[0]
            sizes = np.diff(offs)
            for k in range(int(sizes.max(initial=0))):
                on = sizes > k
                h[on] = chained(h[on], words[offs[:-1][on] + k])
            at = np.unique(probes(h, size))
            yield pa.RecordBatch.from_arrays([pa.array((at // PART_BITS).astype(np.int32)), pa.array((at % PART_BITS).astype(np.int32))], names=["part", "bit"])

    def pack(rows: pa.Table) -> pa.Table:
        own = np.zeros(PART_BITS, np.uint8)
        own[rows["bit"].to_numpy()] = 1
        return pa.table({"part": rows["part"].slice(0, 1), "bits": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    parts = (phrases.select("lang", "gram").mapInArrow(bits, "part int, bit int").distinct()
             .groupBy("part").applyInArrow(pack, "part int, bits binary").toArrow())
    out = np.zeros((size // PART_BITS, PART_BITS // 8), np.uint8)
    for part, data in zip(parts["part"].to_pylist(), parts["bits"].to_pylist()):
        out[part] = np.frombuffer(data, np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(out.ravel())


class Slice:
    """The words of some texts as numbers, and which of them stand in one piece with the next."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        offs, data = raw(texts)
        data = np.frombuffer(data.tobytes().translate(LOWER), np.uint8)
        kind = KIND[data]
        inside = np.append(kind == INSIDE, False)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edge = offs[:-1][offs[:-1] < len(data)]
        begins[edge] = inside[edge]
        starts = np.flatnonzero(begins)
        last = inside[:-1] & (~inside[1:] | begins[1:])
        ends = np.flatnonzero(last) + 1
        out = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=out[1:])
        flat = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(out), pa.py_buffer(np.ascontiguousarray(data[inside[:-1]]))])
        coded = flat.dictionary_encode()
        self.words, self.word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.searchsorted(offs, starts, "right") - 1
        self.linked = np.zeros(len(starts), bool)  # with the next word
        self.linked[:-1] = (row[1:] == row[:-1]) & (kind[ends[:-1]] != BREAK) & (kind[starts[1:] - 1] != BREAK)
        wide = np.flatnonzero(self.linked[:-1] & (starts[1:] - ends[:-1] > 2))
        if len(wide):
            stops = np.flatnonzero(kind == BREAK)
            self.linked[wide] = np.searchsorted(stops, ends[wide]) == np.searchsorted(stops, starts[wide + 1])
        langs = pc.fill_null(langs.cast(pa.string()), UNDETERMINED).dictionary_encode()
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]

    def grams(self, size: int, frequent: dict[int, np.ndarray], open_: np.ndarray | None):
        """(lang, phrase, count) of the n-grams of ``size`` words of which all parts of k words are in
        ``frequent[k]``, and one of the two parts of one word less in ``open_``."""
        d = max(len(self.words), 1)
        hashes = hashed(self.words) if size > 1 else np.zeros(len(self.words), np.uint64)
        # ``at``: where the n-grams begin; ``of``: the number of each among the distinct ones, ``first`` where each is found.
        at = np.arange(len(self.word))
        of, first, h = self._distinct(self.lang * d + self.word, at)
        h = chained(hashed(self.langs)[self.lang[first]], hashes[self.word[first]])
        for n in range(2, size + 1):
            number = np.full(len(self.word) + 1, -1, np.int64)
            number[at] = of
            both = self.linked[at] & (number[at + 1] >= 0)
            if n - 1 in frequent:
                ok = held(frequent[n - 1], h)
                both &= ok[of] & ok[number[at + 1]]
            if n == size and open_ is not None:
                ok = held(open_, h)
                both &= ok[of] | ok[number[at + 1]]
            at, of = at[both], of[both]
            tail = self.word[at + n - 1]
            before = h
            prefix = of
            of, first, where = self._distinct(of * d + tail, at)
            h = chained(before[prefix[where]], hashes[tail[where]])
        count = np.bincount(of, minlength=len(first))
        parts = [self.words.take(pa.array(self.word[first + k])) for k in range(size)]
        text = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        return self.langs.take(pa.array(self.lang[first])), text.cast(pa.large_string()).cast(pa.string()), count

    @staticmethod
    def _distinct(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of each key, where each distinct one is first found, its index)."""
        of, distinct = pd.factorize(keys)
        where = np.zeros(len(distinct), np.int64)
        where[of[::-1]] = np.arange(len(of))[::-1]
        return of, at[where], where


def count_grams(docs: DataFrame, size: int, frequent: dict | None = None, open_=None) -> DataFrame:
    """(lang, gram, n) of the n-grams of ``size`` words of (text, lang), restricted by filters as
    :meth:`Slice.grams` says; for single words the row with a null gram holds the language's number of words."""
    frequent = frequent or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                own = Slice(strings(part.column(0)), part.column(1))
                lang, gram, n = own.grams(size, {k: f.value for k, f in frequent.items()}, open_ and open_.value)
                yield pa.RecordBatch.from_arrays([lang, gram, pa.array(n, pa.int64())], names=["lang", "gram", "n"])
                if size == 1:
                    total = np.bincount(own.lang, minlength=len(own.langs))
                    yield pa.RecordBatch.from_arrays([own.langs, pa.nulls(len(total), pa.string()), pa.array(total, pa.int64())], names=["lang", "gram", "n"])

    rows = docs.select("text", "lang").mapInArrow(run, "lang string, gram string, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _wide(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def _ratio(whole: Column) -> Column:
    """floor(SCALE * n / whole), exact beyond 64 bits."""
    return F.call_function("div", _wide("n") * F.lit(SCALE).cast("decimal(7,0)"), whole)


def _measured(grams: DataFrame, parts: DataFrame) -> DataFrame:
    """(lang, gram, n, heads, tails, best) of n-grams: the counts of the first and of the last 1, 2, ... words,
    and the lowest-scoring cut (score, k, l, r), null where a part was not counted."""
    head = parts.select("lang", F.col("gram").alias("_p"), F.concat("heads", F.array("n")).alias("heads"))
    tail = parts.select("lang", F.col("gram").alias("_s"), F.concat("tails", F.array("n")).alias("tails"))
    own = grams.withColumn("_p", F.expr(HEAD)).withColumn("_s", F.expr(TAIL))
    own = own.join(head, ["lang", "_p"], "left").join(tail, ["lang", "_s"], "left").drop("_p", "_s")
    cuts = F.transform(F.sequence(F.lit(1), F.size("heads")), lambda k: F.struct(
        _ratio(_wide(F.get("heads", k - 1)) + _wide(F.get("tails", F.size("heads") - k))).alias("score"),
        k.alias("k"), F.get("heads", k - 1).alias("l"), F.get("tails", F.size("heads") - k).alias("r")))
    return own.withColumn("best", F.when(F.col("heads").isNotNull() & F.col("tails").isNotNull(), F.array_min(cuts)))


def _bounded(grams: DataFrame, cuts: DataFrame) -> DataFrame:
    """The phrases that may begin or end one that scores at least their language's cut."""
    bounds = [F.when(F.col(c).isNotNull(), _ratio(_wide(F.get(c, F.lit(0))) + _wide("n"))) for c in ("heads", "tails")]
    return grams.join(F.broadcast(cuts), "lang").where((bounds[0] >= F.col("cut")) | (bounds[1] >= F.col("cut")))


def _uncovered(grams: DataFrame, longer: DataFrame | None, cover: int) -> DataFrame:
    """The phrases that no phrase of one word more holds with ``cover`` percent of their count (if a still
    longer one does, so does one of one word more)."""
    if longer is None:
        return grams
    most = (longer.select("lang", "n", F.explode(F.array(F.expr(HEAD), F.expr(TAIL))).alias("gram")).groupBy("lang", "gram").agg(F.max("n").alias("_most")))
    return grams.join(most, ["lang", "gram"], "left").where(
        F.col("_most").isNull() | (_wide("_most") * F.lit(100).cast("decimal(3,0)") < _wide("n") * F.lit(cover).cast("decimal(3,0)"))).drop("_most")


def _cuts(pairs: DataFrame, langs: DataFrame, want: int) -> DataFrame:
    """(lang, cut): the score of the ``want``-th best pair of each language, 0 if it has fewer."""
    by_score = pairs.groupBy("lang", F.col("best.score").alias("score")).agg(F.count("*").alias("m"))
    upto = by_score.select("lang", "score", F.sum("m").over(Window.partitionBy("lang").orderBy(F.desc("score"))).alias("upto"))
    found = upto.where(F.col("upto") >= want).groupBy("lang").agg(F.max("score").alias("cut"))
    return langs.join(found, "lang", "left").select("lang", F.coalesce("cut", F.lit(0)).alias("cut"))


def phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = 2000, min_count: int = 30,
            max_words: int = 4, cover: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` best surviving phrases of each language, and
    ``n``, the words of the language."""
    docs = df.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"))
    often = F.col("n") >= min_count
    words = saved(count_grams(docs, 1).where(often | F.col("gram").isNull()), "words")
    totals = words.where("gram IS NULL").select("lang", F.col("n").alias("total"))
    none = F.array().cast("array<bigint>")
    singles = words.where(F.col("gram").isNotNull() & often).select("lang", "gram", "n", none.alias("heads"), none.alias("tails"))
    frequent = {1: phrase_filter(singles)}
    pairs = saved(_measured(count_grams(docs, 2, frequent).where(often), singles), "pairs")
    frequent[2] = phrase_filter(pairs)
    unsettled = saved(pairs.select("lang").distinct(), "langs")
    done, want = [], FIRST * top
    while True:
        cuts = saved(_cuts(pairs.join(F.broadcast(unsettled), "lang"), unsettled, want), "cuts")
        own = docs.join(F.broadcast(cuts.select("lang")), "lang", "left_semi")
        levels = [pairs.join(F.broadcast(cuts.select("lang")), "lang", "left_semi")]
        for size in range(3, max_words + 1):
            frontier = phrase_filter(_bounded(levels[-1], cuts))
            grams = count_grams(own, size, frequent, frontier).where(often)
            levels.append(saved(_measured(grams, levels[-1]), f"grams-{size}"))
        settled = []
        for grams, longer in zip(levels, [*levels[1:], None]):
            reached = grams.join(F.broadcast(cuts), "lang").where(F.col("best.score") >= F.col("cut")).select("lang", "cut", "gram", "n", "best")
            settled.append(_uncovered(reached, longer, cover))
        found = settled[0]
        for more in settled[1:]:
            found = found.unionByName(more)
        found = saved(found, "found")
        kept = found.groupBy("lang").agg(F.count("*").alias("m"))
        state = saved(cuts.join(kept, "lang", "left").select("lang", ((F.col("cut") == 0) | (F.coalesce("m", F.lit(0)) >= top)).alias("settled")), "state")
        done.append(found.join(F.broadcast(state.where("settled").select("lang")), "lang", "left_semi"))
        unsettled = state.where("NOT settled").select("lang")
        if unsettled.isEmpty():
            break
        want *= 4
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    best_first = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("n"), "gram")
    ranked = result.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("gram").alias("phrase"), F.col("n").alias("a"),
        F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("total").alias("n"), F.col("best.score").alias("score"))
