"""Plain, slow versions of what the operators of textmill.llm must return."""

from __future__ import annotations

import collections
import hashlib
import math
import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


class Sets:
    """Smallest reachable id."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text: str | None) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def near_duplicates(docs: dict[int, str | None], percent: int = 85) -> dict[int, tuple[int, int]]:
    """{id: (set size, component)}"""
    sets, found = {k: shingles(t) for k, t in docs.items()}, Sets()
    holders = collections.defaultdict(list)
    for k, s in sets.items():
        for x in s:
            holders[x].append(k)
    common = collections.Counter((a, b) for own in holders.values() for a in own for b in own if a < b)
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            found.link(a, b)
    return {k: (len(s), found.find(k)) for k, s in sets.items()}


def removed(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """(bytes, removed, spans, digest of the rest)"""
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, sha(bytes(b for b, g in zip(d, gone) if not g))))
    return out


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(texts: list[str | None], items: list[tuple[int, str | None]], n: int = 10) -> list[tuple]:
    """(words, hit words, item ids, spans)"""
    windows = collections.defaultdict(set)
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        m = min(n, len(w))
        for a in range(len(w) - m + 1 if w else 0):
            windows[tuple(w[a : a + m])].add(item)
    lengths, out = {len(w) for w in windows}, []
    for text in texts:
        found = list(WORD.finditer((text or "").translate(LOWER)))
        w, hit, who = [m.group() for m in found], set(), set()
        for m in lengths:
            for a in range(len(w) - m + 1):
                if tuple(w[a : a + m]) in windows:
                    who |= windows[tuple(w[a : a + m])]
                    hit |= set(range(a, a + m))
        spans: list[list[int]] = []
        for k in sorted(hit):
            if k - 1 in hit:
                spans[-1][1] = found[k].end()
            else:
                spans.append([found[k].start(), found[k].end()])
        out.append((len(w), len(hit), sorted(who), [tuple(s) for s in spans]))
    return out


RULES = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
    ("pem", re.compile("-----BEGIN [A-Z ]*PRIVATE KEY(-+)")),
]


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for k, (kind, rule) in enumerate(RULES):
        for m in rule.finditer(text or ""):
            short = {"assign": lambda: len(m.group(2)) < 6, "access": lambda: len(m.group()) < 20,
                     "hex": lambda: len(m.group()) < 24, "pem": lambda: len(m.group(1)) < 5}[kind]()
            if not short:
                out.append((m.start(), k, m.end(), kind))
    return [(kind, a, e) for a, _, e, kind in sorted(out)]


def ppm_bits(corpus: list[str], text: str, order: int, alphabet: set[int] | None = None) -> float:
    """Code length of ``text`` under method C with exclusions, statistics frozen over ``corpus``."""
    tree = collections.defaultdict(collections.Counter)
    for t in corpus:
        b = t.encode()
        for i in range(len(b)):
            for k in range(min(order, i) + 1):
                tree[b[i - k : i]][b[i]] += 1
    bits, b = 0.0, text.encode()
    for i, c in enumerate(b):
        k = min(order, i)
        while k and b[i - k : i] not in tree:
            k -= 1
        left, done = set(range(256)), False
        while k >= 0:
            own = {s: n for s, n in tree[b[i - k : i] if k else b""].items() if s in left}
            whole = sum(own.values()) + len(own)
            if c in own:
                bits -= math.log2(own[c] / whole)
                done = True
                break
            if own:
                bits -= math.log2(len(own) / whole)
                left -= set(own)
            k -= 1
        if not done:
            bits += math.log2(len(left))
    return bits
