"""BPE encoding and decoding over a pair occurrence index.

The vocabulary and ranked merges come from a public ``tokenizers`` JSON file (a parameter; never
trained here).  A task takes the distinct white-space separated chunks of a slice of its texts,
splits them into words as the file's normaliser and pre-tokeniser say, and lays all words out in
one symbol array.  A *pair occurrence index* maps each mergeable pair to all its positions in that
array.  Active ranks are applied in ascending order: every position of the pair is merged at once,
and the lists of the pairs to its left and right are updated.

Defined results: a null or blank text has no tokens and decodes to the empty string; rows are
independent, so ties, repeats and other columns play no part; an empty table gives an empty table;
input columns named ``ids``, ``n_tokens`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textmill.llm.arrow import lists, map_text, ragged

#: The tokenizer file is shipped to the tasks; larger files are refused.
MAX_FILE_BYTES = 64 << 20
#: Bytes of text whose distinct words share one pair index.
PIECE = 2 << 20

# Characters whose NFC form is themselves and on whose classes all Unicode versions agree.
# Chunks with any other character go through the tokenizers library's own normaliser and splitter.
_PLAIN = regex.compile(r"[\x21-\x7E¡-¬®-ſ]*+")


class Vocabulary:
    """Merge ranks, byte symbols and token strings of one tokenizer file."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        spec = json.loads(text)
        model = spec["model"]
        kinds = (model["type"], model.get("unk_token"), model.get("continuing_subword_prefix"), model.get("byte_fallback"), model.get("ignore_merges"))
        if kinds != ("BPE", None, None, False, False):
            raise ValueError(f"not a plain BPE tokenizer file: {kinds}")
        self.library = Tokenizer.from_str(text)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_ids = np.array(sorted(t["id"] for t in spec.get("added_tokens", []) if t["special"]), np.int64)
        self.added = np.array(sorted(self.special.values()), np.int64)
        by_id = {**{i: t for t, i in self.ids.items()}, **{i: t for t, i in self.special.items()}}
        size = max(by_id) + 1
        self.tokens = pa.array([by_id.get(i, "") for i in range(size)], pa.string())
        self.known = np.array([i in by_id for i in range(size)])
        # Byte-level alphabet: printable bytes stand for themselves, the rest for U+0100 onwards.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.char = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.byte = {c: b for b, c in self.char.items()}
        self.inner = np.array([self.ids.get(self.char[b], -1) for b in range(256)], np.int64)
        self.final = np.array([self.ids.get(self.char[b] + self.suffix, -1) for b in range(256)], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.left = np.array([self.ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([self.ids[b] for _, b in pairs], np.int64)
        self.made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        self.size = size
        keys = self.left * size + self.right
        order = np.argsort(keys, kind="stable")
        last = np.append(np.flatnonzero(np.diff(keys[order])), len(order) - 1) if len(order) else order
        self.keys, self.ranks = keys[order][last], order[last]  # a pair listed twice has its later rank
        # Merges whose product occurs in a pair of lower rank: applied one position of a word at a time.
        lowest = np.full(size, len(pairs), np.int64)
        for side in (self.left, self.right):
            np.minimum.at(lowest, side, np.arange(len(pairs)))
        self.stepwise = lowest[self.made] < np.arange(len(pairs)) if len(pairs) else np.zeros(0, bool)
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        chain = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.fast = regex.compile(r"\n|" + pattern) if split == pattern and chain == ["NFC", "Replace", "Lowercase"] else None
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def rank(self, keys: np.ndarray) -> np.ndarray:
        """The rank of each pair key, -1 if it never merges."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def pieces(self, chunks: list[str]) -> tuple[list[bytes], list[int], np.ndarray]:
        """Words (bytes), an added token's id or -1 by word, and word offsets by chunk."""
        full = _PLAIN.fullmatch
        quick = [bool(self.fast) and bool(full(c)) and "<|" not in c for c in chunks]
        found = self.fast.findall("\n".join(c for c, q in zip(chunks, quick) if q).lower()) if any(quick) else []
        out: list[bytes] = []
        special: list[int] = []
        ends = np.zeros(len(chunks) + 1, np.int64)
        at = 0
        for k, chunk in enumerate(chunks):
            if quick[k]:
                while at < len(found) and found[at] != "\n":
                    out.append(found[at].encode())
                    special.append(-1)
                    at += 1
                at += 1
            else:
                for part in self.cut.split(chunk) if self.cut else [chunk]:
                    if part in self.special:
                        out.append(b"")
                        special.append(self.special[part])
                    elif part:
                        norm = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                        for word, _ in self.library.pre_tokenizer.pre_tokenize_str(norm):
                            out.append(bytes(self.byte[c] for c in word))
                            special.append(-1)
            ends[k + 1] = len(out)
        return out, special, ends


@lru_cache(maxsize=2)
def vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


def merge(v: Vocabulary, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Merge all words in place; positions that were merged away hold -1.

    ``symbols`` are the byte symbols of all words one after another, ``word`` the word of each.
    """
    n = len(symbols)
    after = np.arange(1, n + 1)
    after[np.append(word[1:] != word[:-1], True)] = -1
    before = np.arange(-1, n - 1)
    before[np.append(True, word[1:] != word[:-1])] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(positions: np.ndarray) -> None:
        """Add the pairs that begin at ``positions`` to the index."""
        ranks = v.rank(symbols[positions] * v.size + symbols[after[positions]])
        ok = ranks >= 0
        ranks, positions = ranks[ok], positions[ok]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for r, part in zip(ranks[np.append(0, cuts)].tolist(), np.split(positions, cuts)):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(active, r)

    enter(np.flatnonzero(after >= 0))
    while active:
        r = heapq.heappop(active)
        held = index.pop(r)
        at = held[0] if len(held) == 1 else np.concatenate(held)
        at = np.unique(at)
        at = at[(symbols[at] == v.left[r]) & (after[at] >= 0)]
        at = at[symbols[after[at]] == v.right[r]]
        if not len(at):
            continue
        if v.left[r] == v.right[r] and len(at) > 1:  # runs like "aaaa": every other position, from the left
            linked = np.append(False, after[at[:-1]] == at[1:])
            run = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        if v.stepwise[r] and len(at) > 1:
            first = np.append(True, word[at[1:]] != word[at[:-1]])
            if not first.all():
                index[r] = [at[~first]]
                heapq.heappush(active, r)
                at = at[first]
        gone = after[at]
        follow = after[gone]
        symbols[at], symbols[gone] = v.made[r], -1
        after[at] = follow
        has = follow >= 0
        before[follow[has]] = at[has]
        prior = before[at]
        enter(np.concatenate([prior[prior >= 0], at[has]]))
    return symbols


def encode_chunks(v: Vocabulary, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(token ids, token offsets by chunk)."""
    pieces, special, by_chunk = v.pieces(chunks)
    seen: dict[bytes, int] = {}
    code = np.array([seen.setdefault(p, len(seen)) for p in pieces], np.int64)
    distinct = list(seen)
    lengths = np.array([len(p) for p in distinct], np.int64)
    data = np.frombuffer(b"".join(distinct), np.uint8)
    word = np.repeat(np.arange(len(distinct)), lengths)
    symbols = v.inner[data]
    ends = np.cumsum(lengths)[lengths > 0] - 1
    symbols[ends] = v.final[data[ends]]
    known = symbols >= 0  # bytes without a symbol vanish, as there is no unknown token
    symbols, word = symbols[known], word[known]
    if len(symbols):
        merge(v, symbols, word)
    alive = symbols >= 0
    symbols, word = symbols[alive], word[alive]
    count = np.bincount(word, minlength=len(distinct)) if len(word) else np.zeros(len(distinct), np.int64)
    first = np.cumsum(count) - count
    special = np.array(special, np.int64)
    is_special = special >= 0
    n = np.where(is_special, 1, count[code]) if len(code) else np.zeros(0, np.int64)
    pool = np.concatenate([symbols, v.added])
    begin = first[code] if len(code) else np.zeros(0, np.int64)
    if is_special.any():
        begin = np.where(is_special, len(symbols) + np.searchsorted(v.added, special), begin)
    ids = pool[ragged(begin, n)]
    total = np.append(0, np.cumsum(n))
    return ids, total[by_chunk]


def encode_batch(v: Vocabulary, texts: pa.Array) -> pa.Array:
    """``list<int32>`` of token ids by text."""
    # No word, contraction or added token holds ASCII white space, so chunks are independent.
    chunks = pc.ascii_split_whitespace(texts)
    rows = chunks.offsets.to_numpy().astype(np.int64)
    coded = chunks.flatten().dictionary_encode()
    ids, ends = encode_chunks(v, coded.dictionary.to_pylist())
    code = coded.indices.to_numpy(zero_copy_only=False)
    n = (ends[1:] - ends[:-1])[code] if len(code) else np.zeros(0, np.int64)
    total = np.append(0, np.cumsum(n))
    flat = ids.astype(np.int32)[ragged(ends[:-1][code], n)] if len(code) else np.zeros(0, np.int32)
    return lists(total[rows - rows[0]], pa.array(flat, pa.int32()))


def decode_batch(v: Vocabulary, ids: pa.Array, skip_special_tokens: bool = False) -> pa.Array:
    """The tokens of each list joined by a space (the file names no decoder)."""
    offs = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]].astype(np.int64)
    offs = offs - offs[0]
    keep = (flat >= 0) & (flat < v.size)
    keep[keep] = v.known[flat[keep]]
    if skip_special_tokens:
        keep &= ~np.isin(flat, v.special_ids)
    if not keep.all():
        offs = np.append(0, np.cumsum(keep))[offs]
        flat = flat[keep]
    return pc.binary_join(lists(offs, v.tokens.take(pa.array(flat))), " ")


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text, read on the driver (refused above MAX_FILE_BYTES)."""
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_FILE_BYTES + 1)
    if len(text) > MAX_FILE_BYTES:
        raise ValueError(f"{path}: more than {MAX_FILE_BYTES} bytes")
    return text


IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)
DECODED = T.StructField("decoded", T.StringType(), False)


def _shipped(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(read_tokenizer(path))


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Append ``ids``, the token ids of the whole text (no special tokens added)."""
    spec = _shipped(df, path)
    return map_text(df, text_col, lambda t: [encode_batch(vocabulary(spec.value), t)], [IDS], limit=PIECE)


def round_trip(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Append ``ids`` and ``decoded``, the text that the ids decode to, in one pass."""
    spec = _shipped(df, path)

    def both(texts: pa.Array) -> list[pa.Array]:
        v = vocabulary(spec.value)
        ids = encode_batch(v, texts)
        return [ids, decode_batch(v, ids)]

    return map_text(df, text_col, both, [IDS, DECODED], limit=PIECE)


def decode(df: DataFrame, path: str, ids_col: str = "ids", skip_special_tokens: bool = False) -> DataFrame:
    """Append ``decoded`` to rows with token ids (a null list decodes to the empty string; ids
    that the vocabulary lacks are left out)."""
    spec = _shipped(df, path)
    kept = [c for c in df.columns if c.lower() != "decoded"]
    schema = T.StructType([df.schema[c] for c in kept] + [DECODED])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            column = pc.if_else(pc.is_null(column), pa.scalar([], column.type), column) if column.null_count else column
            column = pa.concat_arrays([column])
            flat = pc.fill_null(column.values, -1)
            text = decode_batch(vocabulary(spec.value), pa.ListArray.from_arrays(column.offsets, flat), skip_special_tokens)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), text], names=[*kept, "decoded"])

    return df.mapInArrow(run, schema)
