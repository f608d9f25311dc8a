"""Secret scans with one combined deterministic automaton.

Each rule is a small regular expression with a *head* and a *tail*: the tail is one byte class
repeated at least ``least`` times, and every match is the leftmost one that does not overlap an
earlier match of its rule, as long as possible.  The rules are compiled together: position sets by
subset construction (once a rule is inside its tail, starts later in the text are dropped, so the
automaton itself keeps matches leftmost), then merged by minimisation into transition arrays.  One
pass over a text's bytes scans for all rules; where a match ends, the same construction on the
reversed head, run backwards from the tail, finds its start.

Defined results: a null or empty text has no spans; rows are independent; an empty table gives an
empty table; an input column named ``secrets`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.arrow import lists, map_text, raw


@dataclass(frozen=True)
class Rule:
    """``head`` then ``tail`` (a byte class) ``least`` or more times; matches whose tail is shorter
    than ``keep`` bytes are consumed, but not reported.

    ``least`` makes the automaton count, which spares reports where the tail's bytes are common
    (hexadecimal letters in prose); it must not let a later match out of a match that is too short.
    """

    kind: str
    head: str
    tail: str
    least: int = 1
    keep: int = 1
    any_case: bool = False


#: The three base rules, in the order in which their kinds are listed, then one more.
RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?", "[A-Za-z0-9+/_.=-]", keep=6, any_case=True),
    Rule("access", "AKIA", "[A-Z0-9]", keep=16),
    Rule("hex", "", "[0-9a-f]", least=24),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY", "-", keep=5),
)


class _Head:
    """Positions of a head expression: byte classes, and which position may follow which.

    Syntax: literals, ``[...]`` classes, ``(a|b)`` groups and the suffixes ``?`` and ``*``.
    """

    def __init__(self, pattern: str, any_case: bool):
        self.text, self.at, self.any_case = pattern, 0, any_case
        self.classes: list[frozenset[int]] = []
        self.follow: list[set[int]] = []
        self.first, self.last, self.empty = self._choice()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} in {pattern!r}")

    def _choice(self):
        first, last, empty = self._sequence()
        while self.text[self.at : self.at + 1] == "|":
            self.at += 1
            f, e, n = self._sequence()
            first, last, empty = first | f, last | e, empty or n
        return first, last, empty

    def _sequence(self):
        first: set[int] = set()
        last: set[int] = set()
        empty = True
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            f, e, n = self._item()
            for p in last:
                self.follow[p] |= f
            first = first | f if empty else first
            last = last | e if n else e
            empty = empty and n
        return first, last, empty

    def _item(self):
        c = self.text[self.at]
        if c == "(":
            self.at += 1
            first, last, empty = self._choice()
            self.at += 1
        else:
            end = self.text.index("]", self.at) + 1 if c == "[" else self.at + 1
            members = byte_class(self.text[self.at : end], self.any_case)
            self.at = end
            self.classes.append(members)
            self.follow.append(set())
            first, last, empty = {len(self.classes) - 1}, {len(self.classes) - 1}, False
        mark = self.text[self.at : self.at + 1]
        if mark and mark in "?*":
            self.at += 1
            empty = True
            if mark == "*":
                for p in last:
                    self.follow[p] |= first
        return first, last, empty


def byte_class(text: str, any_case: bool = False) -> frozenset[int]:
    """The bytes of one literal character or of ``[...]`` (ranges and a backslash before a quote allowed)."""
    body = text[1:-1].replace("\\", "") if text.startswith("[") else text
    out, at = set(), 0
    while at < len(body):
        if body[at + 1 : at + 2] == "-" and at + 2 < len(body):
            out |= set(range(ord(body[at]), ord(body[at + 2]) + 1))
            at += 3
        else:
            out.add(ord(body[at]))
            at += 1
    if any_case:
        out |= {ord(chr(b).swapcase()) for b in out if chr(b).isalpha()}
    return frozenset(out)


class _Scanner:
    """One rule's subset automaton.  States: (head positions, tail bytes so far up to ``least``)."""

    def __init__(self, rule: Rule):
        self.rule, self.head = rule, _Head(rule.head, rule.any_case)
        self.tail = byte_class(rule.tail)
        self.start = (frozenset(), 0)

    def accepts(self, state) -> bool:
        return state[1] == self.rule.least

    def step(self, state, byte: int):
        held, run = state
        h = self.head
        if run == self.rule.least and byte in self.tail:
            return (frozenset(), run)  # leftmost match grows; later starts are dropped
        if run == self.rule.least:
            held = frozenset()  # the match has ended: begin anew with this byte
        moved = {q for p in held for q in h.follow[p] if byte in h.classes[q]} | {q for q in h.first if byte in h.classes[q]}
        grown = 0
        if byte in self.tail:
            if 0 < run < self.rule.least:
                grown = run + 1
            elif (h.empty and run in (0, self.rule.least)) or any(p in h.last for p in held):
                grown = 1
        if grown == self.rule.least:
            moved = set()
        return (frozenset(moved), grown)


class Automaton:
    """Minimal combined automaton: ``move[state * 256 + byte]`` is the next ``state * 256``;
    states from ``accepting`` on report, ``flags`` has the kinds (as bits) by state."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        scanners = [_Scanner(r) for r in rules]
        step_of = [{} for _ in scanners]
        # Bytes that no rule tells apart share one column.
        classes = [c for s in scanners for c in [*s.head.classes, s.tail]]
        sort: dict[tuple, list[int]] = {}
        for b in range(256):
            sort.setdefault(tuple(b in c for c in classes), []).append(b)
        columns = list(sort.values())
        start = tuple(s.start for s in scanners)
        number, todo, table = {start: 0}, [start], []
        while todo:
            state = todo.pop(0)
            row = []
            for column in columns:
                parts = []
                for s, own, memo in zip(scanners, state, step_of):
                    if (own, column[0]) not in memo:
                        memo[own, column[0]] = s.step(own, column[0])
                    parts.append(memo[own, column[0]])
                target = tuple(parts)
                if target not in number:
                    number[target] = len(number)
                    todo.append(target)
                row.append(number[target])
            table.append(row)
        table = np.array(table)
        flags = np.array([sum(1 << k for k, s in enumerate(scanners) if s.accepts(x[k])) for x in number])
        block = np.unique(flags, return_inverse=True)[1]
        while True:  # split blocks until all states of a block go to the same blocks
            _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
            if finer.max() == block.max():
                break
            block = finer
        n = int(block.max()) + 1
        sample = np.zeros(n, np.int64)
        sample[block] = np.arange(len(block))
        # Quiet states first, so that one comparison tells whether a state reports.
        order = np.argsort(flags[sample] > 0, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        small = place[block[table[sample[order]]]]
        wide = np.empty((n, 256), np.int64)
        for k, column in enumerate(columns):
            wide[:, column] = small[:, k : k + 1]
        self.states = n
        shared = list(range(0, n * 256, 256))  # one int object by state
        self.move = [shared[x] for x in wide.ravel().tolist()]
        self.flags: list[int] = flags[sample[order]].tolist()
        self.accepting = int((flags == 0)[sample[order]].sum()) * 256
        self.start = int(place[block[0]]) * 256
        self.back = [_Head(reverse(r.head), r.any_case) for r in rules]

    def runs(self, data: bytes) -> list[list[tuple[int, int]]]:
        """By rule: the byte ranges (first reporting byte, end) of one pass over ``data``."""
        move, state, accepting = self.move, self.start, self.accepting
        reported: list[tuple[int, int]] = []
        for at, byte in enumerate(data):
            state = move[state + byte]
            if state >= accepting:
                reported.append((at, state >> 8))
        out: list[list[tuple[int, int]]] = [[] for _ in self.rules]
        for at, s in reported:
            flags = self.flags[s]
            for k, own in enumerate(out):
                if flags >> k & 1:
                    if own and own[-1][1] == at:
                        own[-1] = (own[-1][0], at + 1)
                    else:
                        own.append((at, at + 1))
        return out

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule number, start, end) in bytes of all matches, ordered by start, then rule."""
        out = []
        for k, (rule, own) in enumerate(zip(self.rules, self.runs(data))):
            for first, end in own:
                tail = first + 1 - rule.least
                if end - tail >= rule.keep:
                    out.append((self._begin(k, data, tail), k, end))
        return [(k, a, e) for a, k, e in sorted(out)]

    def _begin(self, k: int, data: bytes, tail: int) -> int:
        """Run the reversed head backwards from the tail; its longest match is the start."""
        h = self.back[k]
        begin, at = tail, tail - 1
        held = {p for p in h.first if at >= 0 and data[at] in h.classes[p]}
        while held:
            if held & h.last:
                begin = at
            at -= 1
            held = {q for p in held for q in h.follow[p] if at >= 0 and data[at] in h.classes[q]}
        return begin


def reverse(pattern: str) -> str:
    """The expression of the reversed strings of a head expression."""
    def choice(at):
        options = [""]
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                options.append("")
                at += 1
                continue
            if pattern[at] == "(":
                inner, at = choice(at + 1)
                item = f"({inner})"
            else:
                end = pattern.index("]", at) + 1 if pattern[at] == "[" else at + 1
                item, at = pattern[at:end], end
            if pattern[at : at + 1] and pattern[at] in "?*":
                item += pattern[at]
                at += 1
            options[-1] = item + options[-1]
        return "|".join(options), at + 1

    return choice(0)[0]


@lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    return Automaton(rules)


SECRETS = T.StructField("secrets", T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType(), False), T.StructField("start", T.IntegerType(), False),
    T.StructField("end", T.IntegerType(), False)]), False), False)


def find_batch(rules: tuple[Rule, ...], texts: pa.Array) -> pa.Array:
    """The spans of each text as ``list<struct<kind, start, end>>``, in code points."""
    machine = automaton(rules)
    offs, data = raw(texts)
    data = data.tobytes()
    counts, kinds, starts, ends = np.zeros(len(texts) + 1, np.int64), [], [], []
    for row in range(len(texts)):
        own = data[offs[row] : offs[row + 1]]
        found = machine.spans(own)
        counts[row + 1] = len(found)
        if found:
            points = np.append(0, np.cumsum((np.frombuffer(own, np.uint8) & 0xC0) != 0x80))
            for k, a, e in found:
                kinds.append(machine.rules[k].kind)
                starts.append(int(points[a]))
                ends.append(int(points[e]))
    spans = pa.StructArray.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
        fields=[pa.field("kind", pa.string(), False), pa.field("start", pa.int32(), False), pa.field("end", pa.int32(), False)])
    return lists(np.cumsum(counts), spans)


def find_secrets(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Append ``secrets``: kind, start and end (code points, end exclusive) of all matches by
    start, then by the order of the rules."""
    return map_text(df, text_col, lambda t: [find_batch(rules, t)], [SECRETS])


def redact(text: Column, secrets: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each secret replaced by ``mark``; overlapping spans share one mark."""
    united = F.aggregate(
        secrets, F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] > s["start"]),
                              F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                                       F.array(F.struct(F.get(acc, F.size(acc) - 1)["start"].alias("start"),
                                                        F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    starts = F.concat(F.transform(united, lambda s: s["start"]), F.array(F.length(text)))
    ends = F.concat(F.array(F.lit(0)), F.transform(united, lambda s: s["end"]))
    return F.array_join(F.zip_with(starts, ends, lambda s, e: F.substring(text, e + 1, s - e)), mark)
