"""Arrow helpers shared by the operators that run numpy inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that a task works on at a time; longer single texts are taken alone.
SLICE_BYTES = 4 << 20


def strings(column: pa.Array) -> pa.Array:
    """``column`` as non-null 32-bit strings (null: empty), starting at offset 0."""
    if pa.types.is_null(column.type):
        return pa.array([""] * len(column), pa.string())
    column = pc.fill_null(column, "")
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pa.concat_arrays([column, pa.array([], pa.string())])


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array made by :func:`strings`."""
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data else np.zeros(0, np.uint8)
    return offs - offs[0], data


def slices(batch: pa.RecordBatch, text_col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of ``batch`` with at most ``limit`` bytes of text each (at least one row)."""
    column = batch.column(batch.schema.get_field_index(text_col))
    sizes = pc.fill_null(pc.binary_length(column if not pa.types.is_null(column.type) else column.cast(pa.string())), 0)
    offs = np.append(0, np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def words(column: pa.Array, table: bytes | None = None) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """ASCII-white-space separated words: (word offsets by row, words, starts, ends).

    ``table`` maps the bytes first (bytes above 0x7F must map to themselves); starts and
    ends are byte positions in the concatenated texts.
    """
    offs, data = raw(column)
    if table is not None:
        data = np.frombuffer(data.tobytes().translate(table), np.uint8)
    inside = np.ones(len(data) + 1, bool)
    inside[:-1] = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    inside[-1] = False
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = offs[:-1][offs[:-1] < len(data)]
    begins[edge] = inside[edge]  # a word never runs over the end of its text
    starts = np.flatnonzero(begins)
    ends_at = np.zeros(len(data) + 1, bool)
    ends_at[1:] = inside[:-1] & (~inside[1:] | begins[1:])
    ends = np.flatnonzero(ends_at)
    rows = np.searchsorted(starts, offs)
    # The words as one string array, without copying byte by byte: the gaps are sliced off.
    lengths = ends - starts
    out = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    keep = inside[:-1]
    flat = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(out), pa.py_buffer(np.ascontiguousarray(data[keep]))])
    return rows, flat, starts, ends


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ranges ``starts[k] .. starts[k] + lengths[k]``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lengths)


def lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), pa.int32()), values)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_text(df: DataFrame, text_col: str, fn: Callable[..., list[pa.Array]], fields: list[T.StructField],
             also: tuple[str, ...] = (), limit: int = SLICE_BYTES) -> DataFrame:
    """Append the columns ``fields``, which ``fn`` makes from the text column (and ``also``), to each row.

    Input columns that bear the name of one of ``fields`` are replaced; all others pass through.
    Rows never leave their task (no shuffle), where about ``limit`` bytes of text are taken at a time.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    hidden = [c for c in dict.fromkeys([text_col, *also]) if c not in kept]
    source = df.select(*kept, *hidden) if hidden else df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, limit):
                made = fn(strings(part.column(part.schema.get_field_index(text_col))), *(part.column(part.schema.get_field_index(c)) for c in also))
                own = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays(own + made, names=[*kept, *(f.name for f in fields)])

    return source.mapInArrow(run, schema)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, group starts) of a stream sorted by its first ``keys`` columns, never cutting a group.

    A group that the end of a batch cuts is held until the next one, so groups must be bounded.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()[0]
        starts = _starts(rows, keys)
        cut = int(starts[-1])
        held = rows.slice(cut)
        if cut:
            yield _own(rows.slice(0, cut)), starts[:-1]
    if held is not None:
        yield _own(held), np.zeros(1, np.int64)


def _own(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of a slice with buffers that begin at them."""
    return pa.RecordBatch.from_arrays([pa.concat_arrays([c, c.slice(0, 0)]) for c in rows.columns], names=rows.schema.names)


def _starts(rows: pa.RecordBatch, keys: int) -> np.ndarray:
    new = np.ones(rows.num_rows, bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in (rows.column(k).to_numpy() for k in range(keys))], axis=0)
    return np.flatnonzero(new)
