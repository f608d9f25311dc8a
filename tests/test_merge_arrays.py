"""Merging arrays of words gives what merging word by word gives."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from textmill.operators.subword import Merges


def _merges(r):
    symbols = ["▁", *"aabé𐐀"]
    out = []
    for _ in range(r.choice([0, 1, 5, 25])):
        pair = r.choice(symbols), r.choice(symbols)
        out.append(pair)  # also pairs that stand twice, and one symbol made by several merges
        symbols.append("".join(pair))
    return out


def test_symbols_and_changes_of_many_words():
    r = random.Random(5)
    for _ in range(300):
        model = Merges(_merges(r))
        words = ["".join(r.choice("aabé𐐀▁") for _ in range(r.choice([0, 1, 2, 5, 12, 40]))) for _ in range(r.choice([0, 1, 6]))]
        weights = [r.randrange(1, 2**40) for _ in words]
        since = r.randrange(len(model.merges) + 1)
        changes = defaultdict(int)
        apart = [model.symbols(w, since, changes, n) for w, n in zip(words, weights)]
        left, sizes, keys, counts = model.apply(pa.array(words, pa.string()), since, np.array(weights, np.int64))
        assert [model.name(k) for k in left.tolist()] == [s for w in apart for s in w]
        assert sizes.tolist() == [len(w) for w in apart]
        got = {(k >> 42, model.name(k >> 21 & 0x1FFFFF), model.name(k & 0x1FFFFF)): n for k, n in zip(keys.tolist(), counts.tolist())}
        assert got == {k: v for k, v in changes.items() if v}
        mixed = pa.array([None, *words, None], pa.string())
        assert model.lists(mixed).to_pylist() == [None, *apart, None]
