"""SentencePiece encoding and decoding that keeps the place of every piece in the source.

The model (a BPE model file with byte fallback, a parameter; never trained here) names a compiled
character map: a double-array trie of byte strings with their replacements.  A task walks the trie from
every character of a slice of its texts at once, takes the longest match from left to right and records
for each normalised byte the source byte that it came from.  The normalised texts are cut where a space
mark follows another character (no piece of the model may span such a place), distinct words are merged
best score first, and every piece is projected through the alignment to its source bytes.

Defined results: a null or empty text has no pieces and decodes to the empty string; texts of white space
only are encoded as the model says; rows are independent, so ties, repeats and other columns play no part;
an empty table gives an empty table; input columns named like an output column are replaced.  A very long
word without spaces costs n log n.
"""

from __future__ import annotations

import heapq
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textmill.llm.arrow import lists, map_text, ragged, raw

#: The model file is shipped to the tasks; larger files are refused.
MAX_FILE_BYTES = 64 << 20
#: Bytes of text whose distinct words are merged together.
PIECE = 2 << 20
#: Words of more symbols are merged one by one, with a heap.
LONG_WORD = 1000
#: Words whose pieces a task remembers, and the longest of them in bytes.
SEEN, SEEN_BYTES = 300_000, 64

MARK = "▁".encode()
# Piece types of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message: ints, 4- or 8-byte strings, or byte strings."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class CharacterMap:
    """The compiled map: a double-array trie over bytes and the zero-ended replacements it points to."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4) if blob else np.zeros(0, "<u4")
        self.ends = blob[4 + size :]
        # A unit holds a label (low byte and top bit), a leaf flag (bit 8) and an offset (the rest, widened by bit 9).
        u = self.units.astype(np.int64)
        self.label = u & 0x800000FF
        self.leaf = (u >> 8) & 1 == 1
        self.jump = (u >> 10) << ((u & 0x200) >> 6)
        self.value = u & 0x7FFFFFFF

    def replacement(self, at: int) -> bytes:
        return self.ends[at : self.ends.index(0, at)]

    def longest(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every start the length of the longest key there (0: none) and its value, all starts in step."""
        length, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        if not len(self.units):
            return length, value
        lane, node, depth = np.arange(len(starts)), np.full(len(starts), self.jump[0]), 0
        while len(lane):
            on = starts[lane] + depth < stops[lane]
            lane, node = lane[on], node[on]
            byte = data[starts[lane] + depth].astype(np.int64)
            node = node ^ byte
            on = (node < len(self.units)) & (byte > 0)
            on[on] = self.label[node[on]] == byte[on]
            lane, node = lane[on], node[on]
            ended = self.leaf[node]
            node = node ^ self.jump[node]
            depth += 1
            length[lane[ended]] = depth
            value[lane[ended]] = self.value[node[ended]]
        return length, value


class Seen:
    """The pieces of words that a task has met, to be taken again; begun anew when SEEN words are held."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.joined: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self.ends = [0]

    def get(self, words: list[bytes]) -> np.ndarray:
        place = self.place
        return np.array([place.get(w, -1) for w in words], np.int64)

    def add(self, words: list[bytes], ids: np.ndarray, length: np.ndarray, ends: np.ndarray) -> None:
        if len(self.place) + len(words) > SEEN or self.ends[-1] + len(ids) > 8 * SEEN:
            self.__init__()
        base = len(self.place)
        self.place.update(zip(words, range(base, base + len(words))))
        self.parts.append((ids.astype(np.int32), length.astype(np.int32)))
        last = self.ends[-1]
        self.ends.extend((ends[1:] + last).tolist())
        self.joined = None

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, lengths, offsets by word)."""
        if self.joined is None:
            ids, length = (np.concatenate(x) for x in zip(*self.parts)) if self.parts else (np.zeros(0, np.int32),) * 2
            self.parts = [(ids, length)]
            self.joined = ids, length, np.array(self.ends)
        return self.joined


class Model:
    """Pieces, scores, merges and the normaliser of one model file."""

    def __init__(self, data: bytes):
        entries, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                entries.append(dict(_fields(value)))
            elif number in (2, 3):
                (trainer if number == 2 else normalizer).update(_fields(value))
        self.pieces = [e[1] for e in entries]
        kinds = np.array([e.get(3, NORMAL) for e in entries])
        if trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24) or np.isin(kinds, [USER_DEFINED, UNUSED]).any():
            raise ValueError("only BPE models with byte fallback, without user-defined or unused pieces, are read")
        self.map = CharacterMap(normalizer.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(normalizer.get(k, 1)) for k in (3, 4, 5))
        if not self.escape:
            raise ValueError("only models that escape white space are read")
        own = [k for k in range(len(entries)) if kinds[k] == NORMAL]
        scores = {k: struct.unpack("<f", entries[k].get(2, b"\0\0\0\0"))[0] for k in own}
        text = {k: self.pieces[k].decode() for k in own}
        ids = {t: k for k, t in text.items()}
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes = np.full(len(entries), -1, np.int64)
        for k in np.flatnonzero(kinds == BYTE).tolist():
            value = int(self.pieces[k][3:5], 16)
            self.byte_ids[value], self.bytes[k] = k, value
        # Characters that pieces hold but that are no pieces get symbols beyond the pieces.
        self.n = len(entries)
        symbols = dict(ids)
        for c in sorted({c for t in text.values() for c in t}):
            symbols.setdefault(c, len(symbols) + self.n)
        self.char = np.full(0x110000, -1, np.int32)
        for c, k in symbols.items():
            if len(c) == 1:
                self.char[ord(c)] = k
        self.size = max(symbols.values(), default=0) + 1
        pairs = [(symbols[t[:i]], symbols[t[i:]], k) for k, t in text.items() for i in range(1, len(t)) if t[:i] in symbols and t[i:] in symbols]
        left, right, made = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 3
        # The class of a piece: its place among the distinct scores, best first.
        distinct = sorted(set(scores.values()), reverse=True)
        place = {s: r for r, s in enumerate(distinct)}
        rank_of = np.full(self.size, len(distinct), np.int64)
        for k, s in scores.items():
            rank_of[k] = place[s]
        order = np.argsort(left * self.size + right, kind="stable")
        self.keys, self.made = (left * self.size + right)[order], made[order]
        self.rank = rank_of[self.made]
        # Classes to be applied one position of a word at a time: several pieces, or a piece that takes
        # part in a pair of a class that is as good or better.
        best = np.full(self.size, len(distinct), np.int64)
        for side in (left, right):
            np.minimum.at(best, side, rank_of[made])
        members = np.bincount(rank_of[own], minlength=len(distinct) + 1)
        self.stepwise = members > 1
        np.logical_or.at(self.stepwise, rank_of[own], best[own] <= rank_of[own])
        self.by_pair = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.made.tolist())))
        marked = ["▁" in t.lstrip("▁") for t in text.values()]
        self.splits = not any(marked)
        self.seen = Seen()
        # What each piece decodes to; byte pieces are one byte.
        surface = [b"" if kinds[k] == CONTROL else trainer.get(44, " ⁇ ".encode()) if kinds[k] == UNKNOWN
                   else bytes([self.bytes[k]]) if kinds[k] == BYTE else p.replace(MARK, b" ") for k, p in enumerate(self.pieces)]
        self.surface = pa.array(surface, pa.binary())
        self.marked = np.array([kinds[k] == NORMAL and p.startswith(MARK) for k, p in enumerate(self.pieces)])

    # -- normalisation ----------------------------------------------------------------------------

    def normalise(self, offs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, bytes, source byte of each byte) of the normalised texts; one more source byte ends each text.

        Source bytes are counted from the start of the text; a text's ending entry stands at
        ``offset of the next text + number of the text``.
        """
        if not len(self.map.units) and not self.squeeze:
            return self._unchanged(offs, data)
        n = len(offs) - 1
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        row = np.searchsorted(offs, starts, "right") - 1
        sizes = np.diff(np.append(starts, len(data)))
        length, value = self.map.longest(data, starts, offs[row + 1])
        # The longest match from the left: a match over several characters swallows those that begin in it.
        alive = np.ones(len(starts), bool)
        at = 0
        for k in np.flatnonzero(length > sizes).tolist():
            if k >= at:
                at = int(np.searchsorted(starts, starts[k] + length[k]))
                alive[k + 1 : at] = False
        starts, row, sizes, length, value = (x[alive] for x in (starts, row, sizes, length, value))
        hit = length > 0
        # The replacements in use, behind the source bytes; a space is always the mark.
        kinds, kind = np.unique(value[hit], return_inverse=True)
        texts = [self.map.replacement(int(v)) for v in kinds]
        pool = np.frombuffer(data.tobytes() + b" " + b"".join(texts), np.uint8)
        ends = len(data) + 1 + np.cumsum([0, *map(len, texts)])
        begin, taken = starts.copy(), sizes.copy()
        begin[hit], taken[hit] = ends[:-1][kind], np.diff(ends)[kind]
        source = starts - offs[row]
        whole = np.diff(offs)
        out = pool[ragged(begin, taken)]
        of_row = np.repeat(row, taken)
        src = np.repeat(source, taken)
        end, head = whole.copy(), np.zeros(n, np.int64)
        if self.squeeze:  # runs of spaces become one, those at the ends vanish, and so do space marks at the end
            space = out == 0x20
            first = np.append(True, of_row[1:] != of_row[:-1])[: len(out)]
            keep = ~(space & (np.append(True, space[:-1])[: len(out)] | first))
            out, of_row, src, space = out[keep], of_row[keep], src[keep], space[keep]
            blank = space.copy()
            mark = np.flatnonzero((out[:-2] == MARK[0]) & (out[1:-1] == MARK[1]) & (out[2:] == MARK[2])) if len(out) > 2 else np.zeros(0, np.int64)
            for k in range(3):
                blank[mark + k] = True
            last = np.full(n, -1, np.int64)
            last[of_row[~blank]] = np.flatnonzero(~blank)
            keep = np.arange(len(out)) <= last[of_row]
            dropped = np.flatnonzero(~keep)[::-1]
            end[of_row[dropped]] = src[dropped]  # the first byte that goes ends the text
            out, of_row, src = out[keep], of_row[keep], src[keep]
            other = np.flatnonzero((taken != 1) | (pool[begin] != 0x20))[::-1]
            head[row[other]] = source[other]  # the mark before the text stands behind leading spaces
        filled = np.bincount(of_row, minlength=n) > 0 if self.squeeze else whole > 0
        # Space marks of three bytes, and one before each text.
        width = np.where(out == 0x20, 3, 1)
        count = np.bincount(of_row, weights=width, minlength=n).astype(np.int64)
        front = np.where(filled & self.prefix, 3, 0)
        new = np.append(0, np.cumsum(count + front))
        place = np.cumsum(width) - width + np.cumsum(front)[of_row]
        made = np.zeros(int(new[-1]), np.uint8)
        origin = np.zeros(int(new[-1]) + n, np.int64)
        mark = np.frombuffer(MARK, np.uint8)
        plain = width == 1
        made[place[plain]] = out[plain]
        for k in range(3):
            made[place[~plain] + k] = mark[k]
            made[new[:-1][front > 0] + k] = mark[k]
            origin[place[~plain] + k + of_row[~plain]] = src[~plain]
        origin[place[plain] + of_row[plain]] = src[plain]
        if self.prefix:
            for k in range(3):
                origin[(new[:-1] + np.arange(n))[front > 0] + k] = head[front > 0]
        origin[new[1:] + np.arange(n)] = end
        return new, made, origin

    def _unchanged(self, offs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """:meth:`normalise` without a map: only spaces become marks."""
        size = np.diff(offs)
        front = ((size > 0) & self.prefix).astype(np.int64)
        # A space goes before each text, an end behind it; then spaces are spelled out.
        at = np.repeat(np.cumsum(front + 1) - 1, size) + np.arange(len(data))
        full = np.full(len(data) + int(front.sum()) + len(size), 0x20, np.uint8)
        full[at] = data
        ends = np.cumsum(size + front + 1) - 1
        place = np.zeros(len(full), np.int32)
        place[at] = np.arange(len(data)) - np.repeat(offs[:-1], size)
        place[ends] = size
        width = np.where(full == 0x20, 3, 1).astype(np.int8)
        width[ends] = 1
        origin = np.repeat(place, width)
        made = np.repeat(full, width)
        stop = np.cumsum(width, dtype=np.int64)
        spaces = stop[width == 3] - 3
        for k in range(3):
            made[spaces + k] = MARK[k]
        keep = np.ones(len(made), bool)
        keep[stop[ends] - 1] = False
        return np.append(0, stop[ends] - np.arange(1, len(size) + 1)), made[keep], origin

    # -- merging ----------------------------------------------------------------------------------

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, class, product) of each pair of symbols, class -1 if it never merges."""
        keys = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        if not len(self.keys):
            return keys, np.full(len(keys), -1), keys
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return keys, np.where(self.keys[at] == keys, self.rank[at], -1), self.made[at]

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Merge all words in place, best class first and from the left; False where a symbol was merged away."""
        n = len(symbols)
        alive = np.ones(n, bool)
        edge = word[1:] != word[:-1]
        after = np.arange(1, n + 1)
        after[np.append(edge, True)] = -1
        before = np.arange(-1, n - 1)
        before[np.append(True, edge)] = -1
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        classes: list[int] = []

        def enter(positions: np.ndarray) -> None:
            right = symbols[after[positions]]
            keys, rank, product = self.find(symbols[positions], right)
            on = np.flatnonzero(rank >= 0)
            if not len(on):
                return
            on = on[np.argsort(rank[on], kind="stable")]
            rank, entries = rank[on], (positions[on], keys[on], product[on])
            cuts = np.append(0, np.flatnonzero(np.diff(rank)) + 1)
            for r, a, b in zip(rank[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(rank)]):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(classes, r)
                waiting[r].append(tuple(x[a:b] for x in entries))

        enter(np.flatnonzero(after >= 0))
        while classes:
            r = heapq.heappop(classes)
            held = waiting.pop(r)
            at, keys, product = held[0] if len(held) == 1 else (np.concatenate(x) for x in zip(*held))
            right = after[at]
            on = alive[at] & (right >= 0)
            on[on] = symbols[at[on]] * self.size + symbols[right[on]] == keys[on]
            on = np.flatnonzero(on)
            if not len(on):
                continue
            on = on[np.argsort(at[on], kind="stable")]
            at, keys, product = at[on], keys[on], product[on]
            if len(at) > 1 and not (new := np.append(True, at[1:] != at[:-1])).all():
                at, keys, product = at[new], keys[new], product[new]
            if self.stepwise[r]:
                first = np.append(True, word[at[1:]] != word[at[:-1]])
                if not first.all():
                    waiting[r] = [(at[~first], keys[~first], product[~first])]
                    heapq.heappush(classes, r)
                    at, product = at[first], product[first]
            elif len(at) > 1:  # pairs that overlap: every other one of a chain, from the left
                linked = np.append(False, after[at[:-1]] == at[1:])
                run = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
                on = (np.arange(len(at)) - run) % 2 == 0
                at, product = at[on], product[on]
            gone = after[at]
            follow = after[gone]
            symbols[at], alive[gone], after[at] = product, False, follow
            has = follow >= 0
            before[follow[has]] = at[has]
            prior = before[at]
            enter(np.concatenate([prior[prior >= 0], at[has]]))
        return alive

    def merge_one(self, symbols: list[int]) -> list[int]:
        """One word with a heap of (class, position, product); -1 marks symbols that were merged away."""
        n = len(symbols)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def enter(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and symbols[i] >= 0 and symbols[j] >= 0:
                found = self.by_pair.get(symbols[i] * self.size + symbols[j])
                if found:
                    heapq.heappush(heap, (found[0], i, symbols[i] * self.size + symbols[j], found[1]))

        gone = bytearray(n)
        for i in range(n):
            enter(i)
        while heap:
            _, i, key, product = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or symbols[j] < 0 or symbols[i] * self.size + symbols[j] != key:
                continue
            symbols[i], gone[j], after[i] = product, 1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            enter(before[i])
            enter(i)
        return [k for k in range(n) if not gone[k]]

    def segment(self, offs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, normalised bytes of each, piece offsets by word) of words.

        A character that is no piece is spelled in byte pieces: only the last covers its bytes.
        """
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        word = np.searchsorted(offs, starts, "right") - 1
        size = np.diff(np.append(starts, len(data)))
        lead = data[starts].astype(np.int64)
        code = np.where(size == 1, lead, lead & (0x7F >> size))
        for k in range(1, 4):
            on = size > k
            code[on] = (code[on] << 6) | (data[starts[on] + k] & 0x3F)
        symbols = self.char[code].astype(np.int64)
        n = len(offs) - 1
        count = np.bincount(word, minlength=n)
        long = count > LONG_WORD
        kept = np.ones(len(symbols), bool)
        short = ~long[word]
        if short.any():
            own = symbols[short]
            kept[short] = self.merge(own, word[short])
            symbols[short] = own
        for w in np.flatnonzero(long).tolist():
            a = int(np.searchsorted(word, w))
            own = symbols[a : a + count[w]].tolist()
            left = self.merge_one(own)
            symbols[a : a + count[w]] = own
            kept[a : a + count[w]] = False
            kept[a + np.array(left)] = True
        starts, word, symbols = starts[kept], word[kept], symbols[kept]
        span = np.diff(np.append(starts, len(data)))
        spelled = (symbols < 0) | (symbols >= self.n)
        n_ids = np.where(spelled, span, 1)
        ids = np.repeat(symbols, n_ids)
        length = np.repeat(span, n_ids)
        if spelled.any():
            where = np.repeat(spelled, n_ids)
            ids[where] = self.byte_ids[data[ragged(starts[spelled], span[spelled])]]
            where[np.cumsum(n_ids) - 1] = False
            length[where] = 0
        by_word = np.append(0, np.cumsum(np.bincount(word, weights=n_ids, minlength=n).astype(np.int64)))
        return ids, length, by_word

    def pieces_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, normalised bytes of each, piece offsets by word) of distinct words, most of them met before."""
        names = words.to_pylist()
        place = self.seen.get(names)
        new = np.flatnonzero(place < 0)
        old = np.flatnonzero(place >= 0)
        fresh = self.segment(*_binary(words.take(pa.array(new))))
        seen = self.seen.table()
        count = np.zeros(len(names), np.int64)
        count[new] = np.diff(fresh[2])
        count[old] = np.diff(seen[2])[place[old]]
        begin = np.zeros(len(names), np.int64)
        begin[new] = fresh[2][:-1] + len(seen[0])
        begin[old] = seen[2][:-1][place[old]]
        at = ragged(begin, count)
        ids, length = np.concatenate([seen[0], fresh[0]])[at], np.concatenate([seen[1], fresh[1]])[at]
        short = np.flatnonzero(pc.binary_length(words).to_numpy(zero_copy_only=False)[new] <= SEEN_BYTES)
        own = ragged(fresh[2][:-1][short], np.diff(fresh[2])[short])
        self.seen.add([names[k] for k in new[short].tolist()], fresh[0][own], fresh[1][own], np.append(0, np.cumsum(np.diff(fresh[2])[short])))
        return ids, length, np.append(0, np.cumsum(count))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row offsets, ids, first source bytes, ends of the source bytes) of the pieces."""
        offs, data = raw(texts)
        rows, norm, origin = self.normalise(offs, data)
        n = len(rows) - 1
        starts = np.zeros(len(norm) + 1, bool)
        if self.splits and len(norm):
            marks = np.zeros(len(norm) + 3, bool)
            marks[: len(norm) - 2] = (norm[:-2] == MARK[0]) & (norm[1:-1] == MARK[1]) & (norm[2:] == MARK[2])
            starts[3 : len(norm)] = marks[3 : len(norm)] & ~marks[: len(norm) - 3]
        starts[rows[:-1]] = True
        starts[len(norm)] = False
        cuts = np.flatnonzero(starts[: len(norm)])
        words = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(norm)).astype(np.int64)),
                                                                     pa.py_buffer(np.ascontiguousarray(norm))])
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ids, length, ends = self.pieces_of(coded.dictionary)
        count = np.diff(ends)[code]
        at = ragged(ends[:-1][code], count)
        ids, length = ids[at], length[at]
        stop = np.cumsum(length)
        begin = stop - length
        by_word = np.append(0, np.cumsum(count))
        offsets = by_word[np.searchsorted(cuts, rows)]
        row = np.repeat(np.arange(n), np.diff(offsets))
        first, last = origin[begin + row], origin[stop + row]
        # Only the last of the byte pieces of a character covers its source bytes.
        return offsets, ids, first, np.where(length > 0, last, first)

    # -- decoding ---------------------------------------------------------------------------------

    def decode(self, offs: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of lists of ids; ids that the model lacks are left out."""
        ok = (ids >= 0) & (ids < self.n)
        if not ok.all():
            offs, ids = np.append(0, np.cumsum(ok))[offs], ids[ok]
        surface = self.surface.take(pa.array(ids))
        at, data = _binary(surface.cast(pa.large_binary()))
        rows = at[offs]
        if self.prefix or self.squeeze:
            drop = self._leading(offs, ids)
            keep = np.ones(len(data), bool)
            keep[at[:-1][drop]] = False
            rows = np.append(0, np.cumsum(keep))[rows]
            data = data[keep]
        out = pa.Array.from_buffers(pa.large_string(), len(offs) - 1, [None, pa.py_buffer(rows.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        try:
            out.validate(full=True)
            return out.cast(pa.string())
        except pa.ArrowInvalid:
            blob = data.tobytes()
            return pa.array([_repaired(blob[a:b]) for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())], pa.string())

    def _leading(self, offs: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The pieces whose leading space goes: the first piece of a list that decodes to anything, if
        it begins with the mark, and with ``squeeze`` all marks before other text."""
        drop = []
        silent = np.array(pc.binary_length(self.surface).to_numpy(zero_copy_only=False) == 0)
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
            for k in range(a, b):
                p = int(ids[k])
                if self.marked[p]:
                    drop.append(k)
                    if self.squeeze and len(self.pieces[p]) == 3:
                        continue
                    break
                if not silent[p]:
                    break
        return np.array(drop, np.int64)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a large binary array, from 0."""
    column = pa.concat_arrays([column, column.slice(0, 0)])
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[: len(column) + 1]
    return offs - offs[0], np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data else np.zeros(0, np.uint8)


def _repaired(data: bytes) -> str:
    """UTF-8 text in which every byte that is part of no character becomes U+FFFD."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[: e.start].decode() + "�")
            data = data[e.start + 1 :]
    return "".join(out)


def read_model(path: str) -> bytes:
    """The model file, read on the driver (refused above MAX_FILE_BYTES)."""
    with open(path, "rb") as f:
        data = f.read(MAX_FILE_BYTES + 1)
    if len(data) > MAX_FILE_BYTES:
        raise ValueError(f"{path}: more than {MAX_FILE_BYTES} bytes")
    return data


@lru_cache(maxsize=2)
def model(data: bytes) -> Model:
    return Model(data)


IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)
STARTS = T.StructField("starts", T.ArrayType(T.IntegerType(), False), False)
ENDS = T.StructField("ends", T.ArrayType(T.IntegerType(), False), False)
DECODED = T.StructField("decoded", T.StringType(), False)


def _columns(m: Model, texts: pa.Array) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    offs, ids, first, last = m.encode(texts)
    return [lists(offs, pa.array(x.astype(np.int32), pa.int32())) for x in (ids, first, last)], offs, ids


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Append ``ids`` of the whole text (no begin or end ids) and the source bytes ``starts`` to ``ends`` of each
    piece.  Byte pieces that spell one character share its start; the last of them has its end."""
    data = df.sparkSession.sparkContext.broadcast(read_model(path))
    return map_text(df, text_col, lambda t: _columns(model(data.value), t)[0], [IDS, STARTS, ENDS], limit=PIECE)


def round_trip(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Append what :func:`encode` does and ``decoded``, the text that the ids decode to, in one pass."""
    data = df.sparkSession.sparkContext.broadcast(read_model(path))

    def both(texts: pa.Array) -> list[pa.Array]:
        m = model(data.value)
        made, offs, ids = _columns(m, texts)
        return [*made, m.decode(offs, ids)]

    return map_text(df, text_col, both, [IDS, STARTS, ENDS, DECODED], limit=PIECE)


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Append ``decoded`` to rows with ids (a null list decodes to the empty string; ids that the model
    lacks, and null ids, are left out)."""
    data = df.sparkSession.sparkContext.broadcast(read_model(path))
    kept = [c for c in df.columns if c.lower() != "decoded"]
    schema = T.StructType([df.schema[c] for c in kept] + [DECODED])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            column = pa.concat_arrays([pc.if_else(pc.is_null(column), pa.scalar([], column.type), column)])
            offs = column.offsets.to_numpy().astype(np.int64)
            flat = pc.fill_null(column.values, -1).to_numpy(zero_copy_only=False)[offs[0] : offs[-1]].astype(np.int64)
            text = model(data.value).decode(offs - offs[0], flat)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), text], names=[*kept, "decoded"])

    return df.mapInArrow(run, schema)
