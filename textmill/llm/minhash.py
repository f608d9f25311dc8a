"""MinHash near-duplicates with circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct shingles of ``width`` words (A-Z lower-cased; with fewer words,
all of them as one shingle).  One permutation (a mixed hash, modulo SLOTS) places the shingles on a
ring, the second one, shifted circularly by k places, gives signature coordinate k: so all
coordinates of a shingle are one contiguous run of the second permutation.  Bands of ROWS
coordinates make candidate buckets; there are as many bands as bring the chance to miss a pair at
the threshold below MISS.

1. Documents with equal sets become one class (its smallest id); only classes are compared.
2. In each bucket every class is compared with the bucket's smallest (a star), on full sets.
3. Buckets whose members are still in several components are dealt out as pairs of blocks of at
   most BLOCK members; pairs from different components whose longer sketches don't rule them out
   (five standard deviations below the threshold) are compared on full sets, too.

So links inside one component aren't multiplied out, hot buckets are split, and no link between
components is lost beyond the stated chance.

Defined results: a null, empty or blank text has an empty set and links with nothing; rows with a
null id link with nothing; rows that repeat an id share
its links (:func:`drop_near_duplicates` judges each by its own text); ties go to the smallest id; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import fresh, lists, ragged, raw, slices, strings, whole_groups, words
from textmill.llm.graph import components
from textmill.llm.store import saved

WIDTH = 5
THRESHOLD = 0.85
ROWS = 5
MISS = 1e-6
SKETCH = 1024
BLOCK = 128
SLOTS = 1 << 20
SEED = 20_240_607

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def n_bands(threshold: float) -> int:
    """Bands needed so that a pair at ``threshold`` shares none with a chance of at most MISS."""
    return math.ceil(math.log(MISS) / math.log1p(-(threshold ** ROWS)))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(offsets by text, sorted distinct 64-bit shingle hashes)."""
    rows, flat, _, _ = words(texts, LOWER)
    coded = flat.dictionary_encode()
    distinct = np.array(coded.dictionary.to_pylist(), dtype=object)
    of_word = pd.util.hash_array(distinct, categorize=False).astype(np.uint64) if len(distinct) else np.zeros(0, np.uint64)
    w = of_word[coded.indices.to_numpy(zero_copy_only=False)] if len(distinct) else of_word
    sizes = np.diff(rows)
    count = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    at = ragged(rows[:-1], count)
    span = np.repeat(np.minimum(sizes, width), count)
    row = np.repeat(np.arange(len(sizes)), count)
    h = span.astype(np.uint64)
    for k in range(width):
        on = span > k
        h[on] = mix(h[on] + w[at[on] + k])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return np.searchsorted(row, np.arange(len(sizes) + 1)), h


_ring: dict[int, np.ndarray] = {}


def ring(size: int) -> np.ndarray:
    """Row p: the values of the second permutation at p, p - 1, ..., p - size + 1 (circular)."""
    if size not in _ring:
        second = np.random.default_rng(SEED).permutation(SLOTS).astype(np.uint32)
        back = second[::-1]
        _ring[size] = np.lib.stride_tricks.sliding_window_view(np.concatenate([back, back[: size - 1]]), size)
    return _ring[size]


def signatures(offsets: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash signatures (uint32) of the sets; those of empty sets are all ones."""
    out = np.full((len(offsets) - 1, size), np.uint32(0xFFFFFFFF))
    runs = ring(size)
    place = SLOTS - 1 - (mix(hashes ^ np.uint64(SEED)) % np.uint64(SLOTS)).astype(np.int64)
    step = max(1, (4 << 20) // (4 * size))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for a in range(0, len(place), step):
        own = row[a : a + step]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        low = np.minimum.reduceat(runs[place[a : a + step]], first, axis=0)
        out[own[first]] = np.minimum(out[own[first]], low)
    return out


def _bands(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key by band; the band's number is part of it."""
    key = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(signature), axis=0)
    for k in range(ROWS):
        key = mix(key + signature[:, k : bands * ROWS : ROWS].astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def profiles(df: DataFrame, id_col: str, text_col: str, width: int, bands: int) -> DataFrame:
    """(id, n, h1, h2, bands): set size, 128-bit digest of the set, and band keys by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                offs, h = shingles(strings(part.column(1)), width)
                n = np.diff(offs)
                sums = [np.append(np.uint64(0), np.cumsum(mix(h ^ np.uint64(salt)))) for salt in (1, 2)]
                digests = [(s[offs[1:]] - s[offs[:-1]]).view(np.int64) for s in sums]
                keys = _bands(signatures(offs, h, bands * ROWS), bands)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), *map(pa.array, digests),
                     lists(np.arange(len(n) + 1) * bands, pa.array(keys.ravel()))], names=["id", "n", "h1", "h2", "bands"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(
        run, "id bigint, n bigint, h1 bigint, h2 bigint, bands array<bigint>")


def _sets(df: DataFrame, width: int) -> DataFrame:
    """(id, set, sketch) of (id, t) rows: full sets, and the low bytes of SKETCH coordinates."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "t"):
                offs, h = shingles(strings(part.column(1)), width)
                low = np.ascontiguousarray((signatures(offs, h, SKETCH) & np.uint32(0xFF)).astype(np.uint8))
                sketch = pa.Array.from_buffers(pa.binary(), len(offs) - 1, [
                    None, pa.py_buffer((np.arange(len(offs)) * SKETCH).astype(np.int32)), pa.py_buffer(low)])
                yield pa.RecordBatch.from_arrays([part.column(0), lists(offs, pa.array(h.view(np.int64))), sketch], names=["id", "set", "sketch"])

    return df.mapInArrow(run, "id bigint, set array<bigint>, sketch binary")


def linked(common: Column, a: Column, b: Column, threshold: float) -> Column:
    """Whether sets of sizes ``a`` and ``b`` with ``common`` shared members reach the threshold (whole percent)."""
    return 100 * common >= round(100 * threshold) * (a + b - common)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) pairs whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("sb"))
    return pairs.join(left, "a").join(right, "b").where(linked(
        F.size(F.array_intersect("sa", "sb")), F.size("sa"), F.size("sb"), threshold)).select("a", "b")


def _cross_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components within block pairs (rows sorted by ``g``), by sketch."""
    least = threshold - 5 * math.sqrt(threshold * (1 - threshold) / SKETCH)
    need = SKETCH * (least + (1 - least) / 256)
    percent = round(100 * threshold)

    def pairs_of(batch: pa.RecordBatch, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        col = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
        size = np.diff(np.append(start, batch.num_rows))
        last = np.repeat(start + size, size)
        ids, n, comp, side, band = (col[c].to_numpy() for c in ("id", "n", "root", "side", "band"))
        bands = col["bands"].flatten().to_numpy().reshape(batch.num_rows, -1)
        _, data = raw(col["sketch"])
        sketch = data.reshape(batch.num_rows, SKETCH)
        same_block = col["i"].to_numpy() == col["j"].to_numpy()
        # Row x meets the later rows of its group; enough rows at a time for about 100 000 pairs.
        meets = last - np.arange(batch.num_rows) - 1
        upto = np.cumsum(meets)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + 100_000, "right")))
            x = np.repeat(np.arange(at, to), meets[at:to])
            y = ragged(np.arange(at, to) + 1, meets[at:to])
            small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
            ok = (comp[x] != comp[y]) & (100 * small >= percent * large) & (same_block[x] | (side[x] != side[y]))
            x, y = x[ok], y[ok]
            for a in range(0, len(x), 8192):
                p, q = x[a : a + 8192], y[a : a + 8192]
                first = (bands[p] == bands[q]).argmax(axis=1) == band[p]  # once, in their first common band
                p, q = p[first], q[first]
                close = (sketch[p] == sketch[q]).sum(axis=1) >= need
                p, q = p[close], q[close]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[p], ids[q])), pa.array(np.maximum(ids[p], ids[q]))], names=["a", "b"])
            at = to

    def run(batches):
        for batch, start in whole_groups(batches, 3):
            yield from pairs_of(batch, start)

    return rows.select("key", "i", "j", "side", "band", "id", "n", "root", "bands", "sketch").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    width: int = WIDTH) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) by row of ``df``.

    ``component_id`` is the smallest id that links lead to, ``kept`` whether that is the row's own.
    """
    bands = n_bands(threshold)
    found = saved(profiles(df, id_col, text_col, width, bands), "profiles")
    usable = found.where("n > 0 AND id IS NOT NULL")
    classes = saved(usable.groupBy("n", "h1", "h2").agg(F.min("id").alias("rep")), "classes")
    members = usable.join(classes.select(F.col("rep").alias("id"), "n", "h1", "h2"), ["id", "n", "h1", "h2"], "left_semi").dropDuplicates(["id", "n", "h1", "h2"])
    placed = members.select("id", "n", F.posexplode("bands").alias("band", "key"))
    full = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("centre")).where("size > 1")
    placed = saved(placed.join(full, "key"), "buckets")

    star = placed.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    wanted = placed.select("id").distinct()
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    sets = saved(_sets(texts.join(wanted.hint("shuffle_hash"), "id", "left_semi"), width), "sets")
    links = saved(_verified(star, sets, threshold), "star")
    roots = components(links)

    placed = placed.join(roots, "id", "left").select(
        "key", "band", "id", "n", "size", F.coalesce("root", "id").alias("root"))
    open_ = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    mine = F.pmod(F.xxhash64("id"), blocks).cast("int")
    rest = placed.join(open_, "key", "left_semi").withColumn("mine", mine).select(
        "key", "band", "id", "n", "root", "mine", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
        "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "band", "id", "n", "root")
    payload = members.select("id", "bands").join(sets.select("id", "sketch"), "id")
    rest = rest.join(payload, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = _verified(_cross_pairs(rest, threshold).distinct(), sets, threshold)
    roots = components(links.unionByName(more))

    by_class = classes.join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left").select(
        "n", "h1", "h2", F.coalesce("root", "rep").alias("root"))
    out = found.join(by_class, ["n", "h1", "h2"], "left").withColumn(
        "component_id", F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("root", "id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                         width: int = WIDTH) -> DataFrame:
    """The rows of ``df`` without those that have a near duplicate of smaller id; of rows that repeat
    id and text one stays, and rows with a null id all stay."""
    ids = df.where(F.col(id_col).isNotNull())
    if ids.groupBy(id_col).count().where("count > 1").isEmpty():
        gone = near_duplicates(df, id_col, text_col, threshold, width).where(~F.col("kept")).select(id_col).distinct()
        return df.join(gone.hint("shuffle_hash"), id_col, "left_anti").select(*df.columns)
    # Each (id, text) becomes a node of its own, numbered in the order of the ids.
    node, key = fresh(df, "node"), fresh(df, "text_key")
    once = ids.dropDuplicates([id_col, text_col]).withColumn(key, F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0)))
    numbered = saved(once.join(_numbered(once.select(id_col, key).distinct(), [id_col, key], node), [id_col, key]), "nodes")
    gone = near_duplicates(numbered, node, text_col, threshold, width).where(~F.col("kept")).select(node).distinct()
    left = numbered.join(gone.hint("shuffle_hash"), node, "left_anti")
    return left.select(*df.columns).unionByName(df.where(F.col(id_col).isNull()))


def _numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with distinct numbers that rise in the given order (range partitions, then the place in each)."""
    return saved(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()), "numbers")
