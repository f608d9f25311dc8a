"""Suffix-array dedup by bucket-pointer refinement over sampled suffixes.

Every byte covered by a string of ``length`` bytes that also starts anywhere else (in any document,
also the same one) is removed.

1. *Initial buckets.*  Each window of ``length`` bytes is led by its smallest q-gram, the anchor, so
   equal windows have equal anchors at equal offsets, and only anchor suffixes need to be bucketed,
   by the identifier of their q-gram.  A window whose anchor's bucket has one member is unique.
2. *Equal contexts.*  The members of a bucket are split by the identifier of the whole context that
   their windows span: a part of two or more members repeats in every window; buckets of a single
   part are done.  Of each part of a bucket that is still mixed, one member's context goes on.
3. *Refinement.*  All suffixes of a bucket's contexts are sorted by their first GRAM0 bytes into
   sub-buckets, which are refined by sorting on (own bucket pointer, bucket pointer at a later offset):
   pointers of width w, taken at offset w, give those of width 2 w, and each round uses the pointers
   that the round before has updated.  A suffix alone in its bucket is settled and takes part no more.
   Windows that share a bucket at width ``length`` repeat; no hash is involved.  This is done in one
   task for some whole buckets of up to GROUP parts.  Larger buckets are spread by the identifiers of
   their windows, whatever their size: there a pointer would have to be fetched by a join.

Identifiers (steps 1 and 2, large buckets) are 64-bit hashes, made from those of shorter strings; in a
large bucket two windows are equal if anchor, offset and window agree (128 bits).

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; rows that repeat
count as other documents, so whole copies of at least ``length`` bytes vanish entirely, all of them;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.arrow import lists, ragged, raw, slices, strings, whole_groups
from textmill.llm.store import saved

LENGTH = 400
GRAM = 32
#: Bytes that the first sort of the refinement looks at: as many as a machine word holds.
GRAM0 = 8
GROUP = 4096
#: Texts are worked on in pieces that fit the processor's cache.
PIECE = 1 << 19

_U = np.uint64
_A, _B, _C = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93), 0xA0761D6478BD642F
_PLACE = 36  # bits of a position; the rest of a sort key is the anchor's hash


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The identifier of two strings one after the other."""
    h = a * _A
    h ^= b * _B
    h ^= h >> _U(32)
    h *= _A
    return h ^ (h >> _U(29))


_powers: list[np.ndarray] = []


def _scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 1024)
        _powers[:] = [np.append(_U(1), np.cumprod(np.full(size - 1, x, _U))) for x in (_U(_C), _U(pow(_C, -1, 1 << 64)))]
    return _powers[0][:n], _powers[1][:n]


class Identifiers:
    """Identifiers of q-grams and of longer strings of ``data``."""

    def __init__(self, data: np.ndarray):
        letters = np.arange(1, 257, dtype=_U)
        h = _pair(letters, letters + _U(1))[data]
        k = 1
        while k < GRAM:
            h = _pair(h[:-k], h[k:]) if len(h) > k else h[:0]
            k *= 2
        self.grams = h
        up, self.down = _scales(len(h) + 1)
        self.sums = np.zeros(len(h) + 1, _U)
        np.cumsum(h * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The identifiers of the strings [start, end) of at least GRAM bytes."""
        return _pair((self.sums[end - GRAM + 1] - self.sums[start]) * self.down[start], (end - start).astype(_U))


def anchors(offs: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first window, last window, anchor, q-gram identifier, context identifier) of each anchor."""
    sizes = np.diff(offs)
    count = np.maximum(sizes - length + 1, 0)
    if not count.any():
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, _U),) * 2
    ids = Identifiers(data)
    low = (ids.grams >> _U(_PLACE) << _U(_PLACE)) | np.arange(len(ids.grams), dtype=_U)
    width, span = length - GRAM + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    at = ragged(offs[:-1], count)
    row = np.repeat(np.arange(len(sizes)), count)
    lead = (low[at] & _U((1 << _PLACE) - 1)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (lead[1:] != lead[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    lo, hi, p = at[first], at[last], lead[first]
    shape = ((p - lo) << 20 | (hi - lo)).astype(_U)
    return row[first], lo, hi, p, ids.grams[p], _pair(ids.of(lo, hi + length), shape)


#: An anchor's first window, the number of windows behind it and its offset in the first one, in one number.
def _packed(lo: np.ndarray, windows: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return (lo << 24) | (windows << 12) | offset


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 24, (place >> 12) & 0xFFF, place & 0xFFF


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, "t", PIECE):
                offs, data = raw(strings(part.column(1)))
                row, lo, hi, p, gram, context = anchors(offs, data, length)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)),
                     pa.array(_packed(lo - offs[row], hi - lo, p - lo))], names=["row", "g", "u", "place"])

    return docs.mapInArrow(run, "row bigint, g bigint, u bigint, place bigint")


def _compressed(docs: DataFrame) -> DataFrame:
    """``t`` of (row, t, ...) as ``z``: texts travel compressed to where their anchors or cuts are."""
    others = [f for f in docs.schema if f.name not in ("row", "t")]
    schema = T.StructType([docs.schema["row"], T.StructField("z", T.BinaryType()), *others])

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for batch in batches:
            for part in slices(batch, "t"):
                offs, data = raw(strings(part.column(1)))
                data = data.tobytes()
                z = [pack(data[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(z, pa.binary()), *part.columns[2:]], names=schema.names)

    return docs.mapInArrow(run, schema)


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """(g, kinds, row, place, context) of the members of mixed buckets; rows that repeat, in a task, count once."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        seen = set()
        for batch in batches:
            col = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            for k, row in enumerate(col["row"].to_pylist()):
                if row in seen:
                    continue
                seen.add(row)
                data = unpack(col["z"][k].as_py())
                own = col["held"].slice(k, 1).flatten()
                place = own.field("place").to_numpy(zero_copy_only=False)
                lo, windows, _ = _unpacked(place)
                context = [data[a:b] for a, b in zip(lo.tolist(), (lo + windows + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [own.field("g"), own.field("kinds"), col["row"].slice(k, 1).take(pa.array(np.zeros(len(place), np.int64))),
                     own.field("place"), pa.array(context, pa.binary())], names=["g", "kinds", "row", "place", "context"])

    return texts.mapInArrow(run, "g bigint, kinds bigint, row bigint, place bigint, context binary")


def _pointers(keys: np.ndarray) -> np.ndarray:
    """The bucket, from 1, of each key that others equal; 0 for a key of its own."""
    order = np.argsort(keys)
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])) if len(keys) else np.zeros(1, np.int64)
    size = np.diff(first)
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(np.where(size > 1, np.cumsum(size > 1), 0), size)
    return out


def refined(offs: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """The bucket pointer of each suffix of some texts at width ``length`` (0: no other suffix begins alike, or too short)."""
    grams, k = data.astype(_U), 1
    while k < GRAM0:
        grams = (grams[:-k] << _U(8 * k)) | grams[k:] if len(grams) > k else grams[:0]
        k *= 2
    room = np.repeat(offs[1:], np.diff(offs)) - np.arange(len(data))
    live = np.flatnonzero(room >= GRAM0)
    found, width = _pointers(grams[live]), GRAM0
    while True:
        pointer = np.zeros(len(data), np.int64)
        pointer[live] = found
        if width == length:
            return pointer
        step = min(width, length - width)
        live = live[(found > 0) & (room[live] >= width + step)]
        ahead = pointer[live + step]
        live, ahead = live[ahead > 0], ahead[ahead > 0]
        found, width = _pointers(pointer[live] << 32 | ahead), width + step


def _places(batch: pa.RecordBatch, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, window number, byte) of all windows of some contexts."""
    _, windows, _ = _unpacked(batch.column(3).to_numpy())
    member = np.repeat(np.arange(batch.num_rows), windows + 1)
    number = ragged(np.zeros(batch.num_rows, np.int64), windows + 1)
    return member, number, offs[:-1][member] + number


def _windows(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(identifier with anchor and offset, member, window number) of all windows of some contexts."""
    offs, data = raw(batch.column(4))
    member, number, at = _places(batch, offs)
    _, _, offset = _unpacked(batch.column(3).to_numpy())
    gram = batch.column(0).to_numpy().view(_U)[member]
    same = _pair(gram, (offset[member] - number).astype(_U))
    return _pair(Identifiers(data).of(at, at + length), same), member, number


def _runs(batch: pa.RecordBatch, member: np.ndarray, number: np.ndarray, length: int) -> pa.RecordBatch:
    """(row, start, end) of runs of windows (sorted by member, then number)."""
    new = np.ones(len(member), bool)
    new[1:] = (member[1:] != member[:-1]) | (number[1:] != number[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(member)) - 1
    who = member[first] if len(first) else first
    lo, _, _ = _unpacked(batch.column(3).to_numpy())
    return pa.RecordBatch.from_arrays(
        [pa.array(batch.column(2).to_numpy()[who]), pa.array(lo[who] + number[first] if len(first) else who),
         pa.array(lo[who] + number[last] + length if len(first) else who)], names=["row", "start", "end"])


RUNS = "row bigint, start bigint, end bigint"


def _sorted_repeats(contexts: DataFrame, length: int) -> DataFrame:
    """Repeating runs in buckets of bounded size: they are refined in one task."""

    def run(batches):
        for batch, starts in whole_groups(batches, 1):
            ends = np.append(starts[1:], batch.num_rows)
            offs, _ = raw(batch.column(4))
            at = 0
            while at < len(starts):  # some whole buckets at a time
                to = max(at + 1, int(np.searchsorted(offs[ends], offs[starts[at]] + 2 * PIECE, "right")))
                part = batch.slice(int(starts[at]), int(ends[to - 1] - starts[at]))
                part = pa.RecordBatch.from_arrays([pa.concat_arrays([c, c.slice(0, 0)]) for c in part.columns], names=part.schema.names)
                own, data = raw(part.column(4))
                member, number, place = _places(part, own)
                again = refined(own, data, length)[place] > 0
                yield _runs(part, member[again], number[again], length)
                at = to

    return contexts.repartition("g").sortWithinPartitions("g").mapInArrow(run, RUNS)


def _spread_repeats(contexts: DataFrame, length: int) -> DataFrame:
    """Repeating windows in buckets of any size: counted by window identifier."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                part = pa.RecordBatch.from_arrays([pa.concat_arrays([c, c.slice(0, 0)]) for c in part.columns], names=part.schema.names)
                h, member, number = _windows(part, length)
                lo, _, _ = _unpacked(part.column(3).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(part.column(2).to_numpy()[member]),
                                                  pa.array(lo[member] + number)], names=["h", "row", "start"])

    windows = saved(contexts.mapInArrow(run, "h bigint, row bigint, start bigint"), "windows")
    again = windows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    return windows.join(again, "h", "left_semi").select("row", "start", (F.col("start") + length).alias("end"))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, start, end): byte ranges, perhaps overlapping, that cover what repeats in (row, t) texts."""
    found = saved(_anchor_rows(docs, length), "anchors")
    parts = found.groupBy("g", "u").agg(F.count("*").alias("members"), F.min("row").alias("chosen"))
    mixed = parts.groupBy("g").agg(F.count("*").alias("kinds")).where("kinds > 1")
    parts = parts.join(mixed, "g", "left").where("members > 1 OR kinds > 1")
    known = saved(found.join(parts, ["g", "u"]), "members")
    windows = F.shiftright("place", 12).bitwiseAND(0xFFF)
    lo = F.shiftright("place", 24)
    whole = known.where("members > 1").select("row", lo.alias("start"), (lo + windows + length).alias("end"))
    held = known.where("kinds > 1 AND row = chosen").groupBy("g", "u").agg(
        F.min("row").alias("row"), F.min("place").alias("place"), F.min("kinds").alias("kinds"))
    held = held.groupBy("row").agg(F.collect_list(F.struct("g", "kinds", "place")).alias("held"))
    contexts = saved(_contexts(_compressed(docs).join(held.hint("shuffle_hash"), "row"), length), "contexts")
    small = _sorted_repeats(contexts.where(F.col("kinds") <= GROUP), length)
    large = _spread_repeats(contexts.where(F.col("kinds") > GROUP), length)
    return whole.unionByName(small).unionByName(large)


def _cut(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """(id, n_bytes, spans, kept) of (row, t, id) texts."""
    span = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)])
    schema = T.StructType([docs.schema["id"], T.StructField("n_bytes", T.LongType(), False),
                           T.StructField("spans", T.ArrayType(span, False), False), T.StructField("kept", T.BinaryType(), False)])

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            col = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            for at in range(0, batch.num_rows, 256):
                n, kept, counts, starts, ends = [], [], [0], [], []
                for k in range(at, min(at + 256, batch.num_rows)):
                    data = unpack(col["z"][k].as_py())
                    own = col["ranges"].slice(k, 1).flatten() if col["ranges"][k].is_valid else None
                    merged: list[list[int]] = []
                    if own is not None and len(own):
                        a, b = (own.field(f).to_numpy(zero_copy_only=False) for f in ("start", "end"))
                        order = np.argsort(a, kind="stable")
                        a, reach = a[order], np.maximum.accumulate(b[order])
                        cut = np.append(0, np.flatnonzero(a[1:] > reach[:-1]) + 1)
                        merged = [[int(a[x]), int(reach[y])] for x, y in zip(cut, np.append(cut[1:], len(a)) - 1)]
                    edges = [0, *(x for r in merged for x in r), len(data)]
                    kept.append(b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2])))
                    n.append(len(data))
                    starts += [r[0] for r in merged]
                    ends += [r[1] for r in merged]
                    counts.append(len(starts))
                spans = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                                                   fields=[pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)])
                yield pa.RecordBatch.from_arrays(
                    [col["id"].slice(at, len(n)), pa.array(n, pa.int64()), lists(np.array(counts), spans), pa.array(kept, pa.binary())],
                    names=schema.names)

    ranges = ranges.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    return _compressed(docs).join(ranges.hint("shuffle_hash"), "row", "left").select("id", "z", "ranges").mapInArrow(run, schema)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id_col, n_bytes, spans, kept) by row: removed byte ranges, and the bytes that are left (these
    need not be whole characters, so ``kept`` is binary)."""
    if not 2 * GRAM <= length < 4096:
        raise ValueError("length must be 64 to 4095")
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    docs = df.select(row.alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.col(id_col).alias("id"))
    return _cut(docs, repeats(docs.select("row", "t"), length)).withColumnRenamed("id", id_col)
