"""Byte-pair-encoding subword model trained as Spark jobs and applied where the text is (G5, Sennrich et al. 2016).

The reference's subword model file is missing; this trains one from the corpus.  The training data is the
word-count table (one row per distinct word, with its frequency), never the raw text again.  The result is
that of plain BPE: the most frequent pair of neighbouring symbols is merged, ties by the pair, over and over.

One Spark job per merge would be slow, so merges are guessed and proved in rounds:

* the driver guesses the next merges by plain BPE over the HINT_WORDS most frequent words (a hint of
  bounded size that cannot change the result);
* tasks apply the guessed merges to the words that hold one of their pairs, and send what each step adds
  to and takes from the count of every pair beside a merge (added up map-side).  Nothing else is counted
  again, and no word is rewritten: a word's symbols follow from the merges so far;
* the counts of all pairs are kept as a table; with the steps' changes they show how far the guess was
  right.  That far it is taken, and the table is brought up to date.  The first guess is the table's
  best pair, so every round proves at least one merge.

A model is its list of merges (at most MAX_MERGES), so it is sent to every task whatever the number of
words, and scores token lists without a shuffle (:class:`BpeModel`).
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.vocab import in_slices, word_counts

WORD_START = "▁"
#: A model's merges are sent to every task.
MAX_MERGES = 2**16
#: Words that the driver guesses from, and merges guessed in a round.
HINT_WORDS, AHEAD = 100_000, 128
#: Tokens of at most so many characters whose pieces a task remembers, and how many of them.
CACHE_CHARS, CACHE_TOKENS = 64, 2**18
#: Characters of words that a task merges at a time (a longer word is taken alone), and the number of Unicode code points.
CHARS_AT_ONCE, CODE_POINTS = 2**20, 0x110000

Pair = tuple[str, str]


def _portions(tokens: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of neighbouring tokens with about CHARS_AT_ONCE characters together."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHARS_AT_ONCE, "right")))
        yield at, to - at
        at = to


class Merges:
    """A ranked list of merges.  A pair that a list holds twice applies at either rank."""

    def __init__(self, merges: list[Pair]):
        if len(merges) > MAX_MERGES:
            raise ValueError(f"a model may have at most {MAX_MERGES} merges")
        self.merges = [tuple(m) for m in merges]
        self.ranks: dict[Pair, list[int]] = defaultdict(list)
        for rank, pair in enumerate(self.merges):
            self.ranks[pair].append(rank)
        self.known: dict[str, int] = {}
        # For arrays of symbols: a character is its code point, other symbols are numbered behind.
        self.names: list[str] = sorted({s for a, b in self.merges for s in (a, b, a + b) if len(s) > 1})
        number = {s: CODE_POINTS + k for k, s in enumerate(self.names)}
        self.steps = [tuple(number[s] if len(s) > 1 else ord(s) for s in (a, b, a + b)) for a, b in self.merges]
        keys = np.array([a << 32 | b for a, b, _ in self.steps], np.int64)
        self.keys, at = np.unique(keys, return_inverse=True)
        self.places = np.sort(at * (len(keys) + 1) + np.arange(len(keys)))

    def name(self, symbol: int) -> str:
        return chr(symbol) if symbol < CODE_POINTS else self.names[symbol - CODE_POINTS]

    def _next(self, left: np.ndarray, right: np.ndarray, above: int) -> np.ndarray:
        """The lowest rank above ``above`` of each pair, or -1."""
        n = len(self.merges) + 1
        key = left << 32 | right
        pair = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        at = np.minimum(np.searchsorted(self.places, pair * n + above + 1), n - 2)
        found = self.places[at]
        return np.where((self.keys[pair] == key) & (found // n == pair) & (found % n > above), found % n, -1)

    def apply(self, tokens: pa.Array, since: int | None = None, weights: np.ndarray | None = None):
        """``symbols`` of many tokens at once: the symbols left, the number of them by token, and with ``since`` and
        ``weights`` the changes as ``(key, count)`` arrays, a key being ``step << 42 | left << 21 | right``."""
        sizes = pc.utf8_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        text = "".join(WORD_START + t for t in tokens.to_pylist())
        sym = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        n, ends = len(sym), np.cumsum(sizes)
        word = np.repeat(np.arange(len(sizes)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        if n:
            after[ends - 1] = -1
            before[ends - sizes] = -1
        alive = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = defaultdict(list)
        heap: list[int] = []

        def enter(at: np.ndarray, above: int) -> None:
            at = at[(at >= 0) & (after[at] >= 0)]
            rank = self._next(sym[at], sym[after[at]], above)
            at, rank = at[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for part, r in zip(np.split(at, cuts), rank[np.append(0, cuts)].tolist() if len(rank) else ()):
                if r not in waiting:
                    heapq.heappush(heap, r)
                waiting[r].append(part)

        keys, counts = [], []
        if self.merges:
            enter(np.arange(n), -1)
        while heap:
            rank = heapq.heappop(heap)
            a, b, made = self.steps[rank]
            i = np.unique(np.concatenate(waiting.pop(rank)))
            i = i[alive[i] & (sym[i] == a) & (after[i] >= 0)]
            i = i[sym[after[i]] == b]
            if a == b and len(i):  # of pairs that overlap, each second one from the left
                first = np.append(True, after[i[:-1]] != i[1:])
                place = np.arange(len(i))
                i = i[(place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0]
            if not len(i):
                continue
            j = after[i]
            p, q = before[i], after[j]
            has_p, has_q = p >= 0, q >= 0
            if since is not None and rank >= since:
                w = weights[word[i]]
                left = sym[p]
                left[1:][p[1:] == j[:-1]] = made  # the pair before has just been merged
                right = sym[q]
                step = rank - since << 42
                same = np.full(len(i), step | a << 21 | b)
                keys += [same, step | left[has_p] << 21 | a, step | left[has_p] << 21 | made,
                         step | b << 21 | right[has_q], step | made << 21 | right[has_q]]
                counts += [-w, -w[has_p], w[has_p], -w[has_q], w[has_q]]
            sym[i] = made
            alive[j] = False
            after[i] = q
            before[q[has_q]] = i[has_q]
            enter(np.unique(np.concatenate([before[i], i])), rank)
        left_of = np.bincount(word[alive], minlength=len(sizes))
        if since is None:
            return sym[alive], left_of
        if not keys:
            return sym[alive], left_of, np.zeros(0, np.int64), np.zeros(0, np.int64)
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, at, np.concatenate(counts))
        return sym[alive], left_of, key[total != 0], total[total != 0]

    def lists(self, tokens: pa.Array) -> pa.Array:
        """``symbols`` of each token; null for null."""
        parts = [pa.array([], pa.list_(pa.string()))]
        for at, size in _portions(tokens):
            own = tokens.slice(at, size)
            left, n = self.apply(own.drop_null())
            kinds, code = np.unique(left, return_inverse=True)
            flat = pa.array([self.name(k) for k in kinds.tolist()], pa.string()).take(pa.array(code))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), flat)
            there = own.is_valid().to_numpy(zero_copy_only=False)
            parts.append(lists.take(pa.array(np.cumsum(there) - 1, pa.int64(), mask=~there)))
        return pa.concat_arrays(parts)

    def symbols(self, token: str, since: int = 0, changes: dict | None = None, weight: int = 1) -> list[str]:
        """The pieces of a token: merges in the order of their ranks, each from the left.

        ``changes`` receives ``{(step, left, right): count}``, what each merge of rank ``since + step``
        adds to and takes from the pairs of the word.
        """
        sym = [WORD_START, *token]
        n = len(sym)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap: list[tuple[int, int, Pair]] = []

        def enter(i: int, above: int) -> None:
            if i >= 0 and after[i] >= 0:
                pair = sym[i], sym[after[i]]
                for rank in self.ranks.get(pair, ()):
                    if rank > above:
                        heapq.heappush(heap, (rank, i, pair))
                        break

        for i in range(n - 1):
            enter(i, -1)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or sym[i] != pair[0] or sym[j] != pair[1]:  # a symbol that was merged away is empty
                continue
            p, q, made = before[i], after[j], pair[0] + pair[1]
            if changes is not None and rank >= since:
                step = rank - since
                changes[step, *pair] -= weight
                if p >= 0:
                    changes[step, sym[p], pair[0]] -= weight
                    changes[step, sym[p], made] += weight
                if q >= 0:
                    changes[step, pair[1], sym[q]] -= weight
                    changes[step, made, sym[q]] += weight
            sym[i], sym[j], after[i], after[j] = made, "", q, -1
            if q >= 0:
                before[q] = i
            enter(p, rank)
            enter(i, rank)
        return [s for s in sym if s]

    def count(self, token: str) -> int:
        """The number of pieces, remembered for short tokens."""
        n = self.known.get(token)
        if n is None:
            n = len(self.symbols(token))
            if len(token) <= CACHE_CHARS:
                if len(self.known) >= CACHE_TOKENS:
                    self.known.clear()
                self.known[token] = n
        return n


class BpeModel:
    """A trained model, sent to every task once: a piece source for the token/character gates
    and ratios (G5) of texts with any number of different words."""

    def __init__(self, spark: SparkSession, merges: list[Pair]):
        self.spark, self.merges = spark, [tuple(m) for m in merges]
        self.shipped = spark.sparkContext.broadcast(Merges(self.merges))

    def column(self, tokens: Column, returns: str, fn) -> Column:
        """Apply ``fn(token lists, pieces of each token, token array)`` to Arrow batches of token lists."""
        shipped = self.shipped

        def counted(lists: pa.ListArray) -> pa.Array:
            flat = lists.flatten()
            coded = flat.dictionary_encode()
            own = np.array([*map(shipped.value.count, coded.dictionary.to_pylist())], np.int32)
            return fn(lists, own[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else own, flat)

        @F.arrow_udf(returns)
        def run(lists: pa.Array) -> pa.Array:
            return in_slices(counted, pa.concat_arrays([lists]))

        return run(tokens)

    def pieces(self, tokens: DataFrame) -> DataFrame:
        """``token, sym, pieces`` of the ``token`` column, row by row."""
        shipped = self.shipped

        @F.arrow_udf("array<string>")
        def run(names: pa.Array) -> pa.Array:
            return shipped.value.lists(names)

        return tokens.select("token", run("token").alias("sym")).withColumn("pieces", F.size("sym"))

    def save(self, path: str) -> None:
        """The merges as a table (``rank, left, right``)."""
        merge_table(self.spark, self.merges).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BpeModel:
        rows = spark.read.parquet(path).orderBy("rank").limit(MAX_MERGES + 1).collect()
        return cls(spark, [(r["left"], r["right"]) for r in rows])


def merge_table(spark: SparkSession, merges: list[Pair]) -> DataFrame:
    return spark.createDataFrame([(i + 1, a, b) for i, (a, b) in enumerate(merges)], "rank int, left string, right string")


class Guess:
    """Plain BPE over a few words on the driver, to say which merges may come next."""

    def __init__(self, words: list[tuple[str, int]]):
        self.words = [([WORD_START, *token], freq) for token, freq in words]
        self.counts: dict[Pair, int] = defaultdict(int)
        self.holders: dict[Pair, set[int]] = defaultdict(set)
        for k in range(len(self.words)):
            self._count(k, 1)

    def _count(self, k: int, sign: int) -> None:
        sym, freq = self.words[k]
        for pair in zip(sym, sym[1:]):
            self.counts[pair] += sign * freq
            self.holders[pair].add(k)

    def merge(self, pair: Pair) -> set[Pair]:
        """Take a merge; the pairs whose counts have changed."""
        changed = set()
        for k in self.holders.pop(pair, ()):
            sym, freq = self.words[k]
            self._count(k, -1)
            changed.update(zip(sym, sym[1:]))
            out: list[str] = []
            for s in sym:
                if out and (out[-1], s) == pair:
                    out[-1] += s
                else:
                    out.append(s)
            self.words[k] = out, freq
            self._count(k, 1)
            changed.update(zip(out, out[1:]))
        return changed

    def ahead(self, top: list[tuple[Pair, int]], n: int) -> list[Pair]:
        """The best pair and the merges that may follow it, without taking them.  The pairs of ``top`` begin with
        their true counts; what merges change is scaled up from the words at hand."""
        own = Guess.__new__(Guess)
        own.words = list(self.words)
        own.counts = defaultdict(int, self.counts)
        own.holders = defaultdict(set, {p: set(h) for p, h in self.holders.items()})
        seen = sum(own.counts.get(p, 0) for p, _ in top)
        scale = sum(c for _, c in top) / seen if seen else 1
        # A pair that is not among the best is at most as frequent as the last of them.
        extra = {p: top[-1][1] - scale * c for p, c in own.counts.items() if scale * c > top[-1][1]}
        extra |= {p: c - scale * own.counts.get(p, 0) for p, c in top}

        def likely(p: Pair) -> int:  # whole, so that equal counts stay equal
            return round(scale * own.counts[p] + extra.get(p, 0))

        heap = [(-likely(p), p) for p in own.counts.keys() | extra.keys()]
        heapq.heapify(heap)
        out, pair = [], top[0][0]
        while True:
            out.append(pair)
            extra.pop(pair, None)
            if len(out) == n:
                return out
            for p in own.merge(pair):
                heapq.heappush(heap, (-likely(p), p))
            while heap and (likely(heap[0][1]) != -heap[0][0] or heap[0][0] >= 0):  # outdated, or gone
                heapq.heappop(heap)
            if not heap:
                return out
            pair = heap[0][1]


def _steps(words: DataFrame, merges: list[Pair], guessed: list[Pair]) -> DataFrame:
    """(a, b, steps): by pair, what each guessed merge changes in its count, from the words that hold one of
    the guessed pairs."""
    shipped = words.sparkSession.sparkContext.broadcast(Merges([*merges, *guessed]))
    since = len(merges)
    wanted = sorted({a + b for a, b in guessed})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        pattern = "|".join(map(re.escape, wanted))
        held, n = [], 0
        for batch in batches:
            marked = pc.binary_join_element_wise(WORD_START, batch.column("token"), "")
            held.append(batch.filter(pc.match_substring_regex(marked, pattern)))
            n += held[-1].num_rows + pc.sum(pc.utf8_length(held[-1]["token"])).as_py() if held[-1].num_rows else 0
            if n >= CHARS_AT_ONCE:
                yield from _rows(held)
                held, n = [], 0
        if n:
            yield from _rows(held)

    def _rows(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.Table.from_batches(held).combine_chunks()
        tokens, freq, model = pa.concat_arrays(own["token"].chunks), own["freq"].to_numpy(), shipped.value
        for at, size in _portions(tokens):
            *_, key, n = model.apply(tokens.slice(at, size), since, freq[at:at + size])
            kinds, code = np.unique(np.append(key >> 21 & (1 << 21) - 1, key & (1 << 21) - 1), return_inverse=True)
            names = pa.array([model.name(k) for k in kinds.tolist()], pa.string()).take(pa.array(code))
            yield pa.RecordBatch.from_arrays([pa.array((key >> 42).astype(np.int32)), names.slice(0, len(key)), names.slice(len(key)), pa.array(n)],
                                             names=["step", "a", "b", "n"])

    rows = words.mapInArrow(run, "step int, a string, b string, n long").groupBy("a", "b", "step").agg(F.sum("n").alias("n"))
    return rows.groupBy("a", "b").agg(F.collect_list(F.struct("step", "n")).alias("steps"))


def _proved(rows: list, counts: dict[Pair, int], guessed: list[Pair], last: tuple[int, Pair] | None, min_count: int) -> int:
    """How many of the guessed merges are those of plain BPE, as far as the pairs at hand show.

    ``counts`` has the best pairs before the round, ``rows`` those that steps change (with their count
    before).  With ``last`` = (-count, pair) all other pairs come after it, whatever the steps do.
    """
    own = dict(counts)
    by_step = defaultdict(list)
    for r in rows:
        own[r.a, r.b] = r.c or 0
        for s in r.steps:
            by_step[s.step].append(((r.a, r.b), s.n))
    heap = [(-c, p) for p, c in own.items()]
    heapq.heapify(heap)
    for step, pair in enumerate(guessed):
        while heap and own[heap[0][1]] != -heap[0][0]:  # outdated
            heapq.heappop(heap)
        if not heap or heap[0][1] != pair or -heap[0][0] < min_count or last and heap[0] > last:
            return step
        for p, n in by_step[step]:
            own[p] += n
            heapq.heappush(heap, (-own[p], p))
    return len(guessed)


def train_bpe(words: DataFrame, n_merges: int = 1000, min_count: int = 2, hint_words: int = HINT_WORDS, ahead: int = AHEAD):
    """Train on ``words`` (``token, freq``).  Returns ``(merges, pieces, model)``: ``merges(rank, left, right)``
    in the order learnt, ``pieces(token, sym, pieces)`` of the training words, and the merges as a list
    (at most ``n_merges`` pairs)."""
    from textmill.session import checkpoint_dir

    if n_merges > MAX_MERGES:
        raise ValueError(f"at most {MAX_MERGES} merges")
    spark = words.sparkSession
    checkpoint_dir(spark)
    w = words.select("token", F.col("freq").cast("long").alias("freq")).where("token IS NOT NULL").checkpoint()
    sym = F.concat(F.array(F.lit(WORD_START)), F.filter(F.split("token", ""), lambda c: c != ""))
    pairs = (w.select("freq", sym.alias("s")).select("freq", F.explode(F.arrays_zip(F.slice("s", 1, F.size("s") - 1).alias("a"), F.slice("s", 2, F.size("s")).alias("b"))).alias("p"))
             .groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("freq").alias("c")).checkpoint())
    hint = w.orderBy(F.desc("freq"), "token").limit(hint_words).collect()
    guess = Guess([(r.token, r.freq) for r in hint])
    model: list[Pair] = []
    while len(model) < n_merges:
        top = pairs.where(F.col("c") >= min_count).orderBy(F.desc("c"), "a", "b").limit(2 * ahead + 1).collect()
        if not top:
            break
        last = (-top[-1].c, (top[-1].a, top[-1].b)) if len(top) > 2 * ahead else None
        least = -last[0] if last else min_count
        guessed = guess.ahead([((r.a, r.b), r.c) for r in top], min(ahead, n_merges - len(model)))
        steps = _steps(w, model, guessed).checkpoint()
        # The pairs whose count ever reaches ``least``; all others stay behind ``last``.
        reach = F.array_max(F.transform(F.array_sort("steps"), lambda s: F.coalesce("c", F.lit(0)) + F.aggregate(
            F.filter("steps", lambda x: x["step"] <= s["step"]), F.lit(0).cast("long"), lambda n, x: n + x["n"])))
        touched = steps.join(pairs, ["a", "b"], "left").where((F.coalesce("c", F.lit(0)) >= least) | (reach >= least)).collect()
        m = max(1, _proved(touched, {(r.a, r.b): r.c for r in top}, guessed, last, min_count))
        taken = guessed[:m]
        for pair in taken:
            guess.merge(pair)
        model += taken
        change = F.aggregate(F.filter("steps", lambda x: x["step"] < m), F.lit(0).cast("long"), lambda n, x: n + x["n"])
        pairs = (pairs.unionByName(steps.select("a", "b", change.alias("c"))).groupBy("a", "b").agg(F.sum("c").alias("c"))
                 .where("c > 0").checkpoint())
    return merge_table(spark, model), BpeModel(spark, model).pieces(w), model


def bpe_pieces(tokens: DataFrame, model: list[Pair]) -> DataFrame:
    """Apply a trained model to the distinct ``token`` values of ``tokens``: ``token, sym, pieces``."""
    return BpeModel(tokens.sparkSession, model).pieces(tokens.select("token").distinct())


def bpe_model(docs: DataFrame, text_col: str = "text", n_merges: int = 1000, min_word_freq: int = 1, **kw) -> BpeModel:
    """A model trained on all words of ``docs`` that occur at least ``min_word_freq`` times."""
    words = word_counts(docs, text_col).where(F.col("freq") >= min_word_freq)
    return BpeModel(docs.sparkSession, train_bpe(words, n_merges=n_merges, **kw)[2])


def bpe_piece_table(docs: DataFrame, text_col: str = "text", n_merges: int = 1000, min_word_freq: int = 1,
                    train_docs: DataFrame | None = None, keep_pieces: bool = False, **kw) -> DataFrame:
    """G5 piece table ``token, pieces`` (and ``sym``, the pieces, if asked) for every
    word of ``docs``, from a BPE model trained on the words of ``train_docs``
    (default ``docs``) that occur at least ``min_word_freq`` times.  It is
    written to the checkpoint folder once: a later join reads it as it is."""
    from textmill.operators.vocab import token_rows

    words = word_counts(train_docs if train_docs is not None else docs, text_col).where(F.col("freq") >= min_word_freq)
    _, pieces, model = train_bpe(words, n_merges=n_merges, **kw)
    if train_docs is not None or min_word_freq > 1:
        pieces = bpe_pieces(token_rows(docs, [], text_col), model)
    return (pieces if keep_pieces else pieces.select("token", "pieces")).checkpoint()
