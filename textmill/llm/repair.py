"""Cheapest repair of conversations with Four-Russians block tables.

A repaired conversation is one system turn or none, then pairs of user and assistant turns, or nothing:
role initials ``(s?(ua)+)?``.  Turns are edited in order: Delete costs 3 and is required for blank turns
and for those whose role and text stood before; Keep costs 0, Rerole to user or assistant 2, either one
more for a truncated turn; Insert of an empty user or assistant turn costs 2.  Of the cheapest edits those
whose initials are least in ASCII are taken.

A turn counts only by its symbol (must go; or role initial and truncated or not).  The costs to go from
the four states of the pattern at a place of the conversation, less the least of them, form one of a few
vectors, as one state never costs over 5 more than another.  For every block of BLOCK symbols and every
vector behind it a table holds the vector before it, so a conversation is worked off from its end by one
lookup a block, and only the vector at each block's end is kept.  Tracing goes from the start: each block
is expanded backward from its end into the vectors between its symbols, and at each symbol the least edit
letter that lies on a cheapest path is taken, so ties fall right without looking further.

Rows are put in order once by a range sort of all rows, so a conversation of any length is spread over
tasks, and are worked off in chunks of CHUNK rows.  For the conversation that a chunk's edge may cut, the
chunk answers for every vector that could follow and every state that could enter; these answers, a few
hundred bytes a chunk, are chained from the right and then from the left.

Defined results: a null role or text is one space; turns are ordered by number (nulls first), role and
text, so ties and repeated rows have one result; rows without a conversation id form one conversation;
other columns are not read; an empty table gives empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.store import saved

#: Symbols of a block, rows of a chunk.
BLOCK, CHUNK = 4, 4096
DELETE, REROLE, INSERT = 3, 2, 2
# States: nothing yet, after a system, a user, an assistant turn; where Insert or Rerole leads from each.
START, SYSTEM, USER, ASSISTANT = range(4)
ONWARD = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Symbols: must go, then role initial (s, u, a, another) by truncated or not, then the filler of the last block.
MUST_GO, FILLER, SYMBOLS = 0, 9, 10
KEPT = {(1, START): SYSTEM, **{(2, q): USER for q in (START, SYSTEM, ASSISTANT)}, (3, USER): ASSISTANT}
#: White space of the blank test.
WHITE = " \t\n\x0b\f\r"


class Tables:
    """All vectors, the steps over one symbol, and the block table."""

    def __init__(self):
        self.vectors = [(0, 4, 2, 0)]  # at the end: an open system or user turn has to be completed
        back: list[list[int]] = []
        steps: list[list[list[tuple[int, int, int]]]] = []
        at = {self.vectors[0]: 0}
        for v in self.vectors:  # grows while it is read
            back.append([])
            steps.append([])
            for symbol in range(SYMBOLS):
                before, step = self._step(symbol, v)
                least = min(before)
                before = tuple(x - least for x in before)
                if before not in at:
                    at[before] = len(self.vectors)
                    self.vectors.append(before)
                back[-1].append(at[before])
                steps[-1].append(step)
        n = len(self.vectors)
        self.back = np.array(back, np.int16).T  # by symbol and the vector behind it
        step = np.array(steps, np.int8).transpose(1, 0, 2, 3)  # by symbol, vector, state: inserts, edit, next state
        self.inserts, self.edit, self.next = (np.ascontiguousarray(step[..., k]) for k in range(3))
        block = np.arange(n, dtype=np.int16)[None, :]
        for _ in range(BLOCK):
            block = self.back[:, block].reshape(-1, n)
        self.block = block
        # Inserts after the last row, by state.
        self.closing = np.array([0, 2, 1, 0], np.int8)

    @staticmethod
    def _step(symbol: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], list[tuple[int, int, int]]]:
        """Costs before a symbol, and by state: inserts, edit (0 none, 1 D, 2 K, 3 R), the state behind it."""
        if symbol == FILLER:
            return after, [(0, 0, q) for q in range(4)]
        kind, extra = (symbol + 1) // 2, (symbol + 1) % 2  # 1 s, 2 u, 3 a, 4 another; truncated
        ways: list[list[tuple[int, int, int]]] = []
        for q in range(4):
            own = [(DELETE + after[q], 1, q)]
            if symbol != MUST_GO:
                if (kind, q) in KEPT:
                    own.append((extra + after[KEPT[kind, q]], 2, KEPT[kind, q]))
                own.append((REROLE + extra + after[ONWARD[q]], 3, ONWARD[q]))
            ways.append(own)
        cost = [min(w)[0] for w in ways]
        for _ in range(3):
            cost = [min(c, INSERT + cost[ONWARD[q]]) for q, c in enumerate(cost)]
        out = []
        for q in range(4):
            inserts = 0
            while True:
                cheapest = {edit: to for c, edit, to in ways[q] if c == cost[q]}
                if 1 in cheapest or cost[q] != INSERT + cost[ONWARD[q]]:  # D before I before K and R
                    break
                q, inserts = ONWARD[q], inserts + 1
            edit = min(cheapest)
            out.append((inserts, edit, cheapest[edit]))
        return tuple(cost), out


TABLES = Tables()


class Runs:
    """Symbols of some conversations (or parts of them) in blocks, all worked off in step.

    ``starts`` and ``sizes`` say where each run stands in ``symbols``.
    """

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")  # longest first: those still running are a prefix
        self.sizes = sizes[self.order]
        self.blocks = -(-self.sizes // BLOCK)
        wide = BLOCK * np.append(0, np.cumsum(self.blocks))
        self.starts = wide[:-1] // BLOCK
        filled = np.full(int(wide[-1]), FILLER, np.int64)
        inside = np.arange(int(self.sizes.sum())) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.at = np.repeat(wide[:-1], self.sizes) + inside
        self.of = np.repeat(starts[self.order], self.sizes) + inside
        filled[self.at] = symbols[self.of]
        self.symbols = filled.reshape(-1, BLOCK)
        self.codes = self.symbols @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))

    def running(self, k: int) -> int:
        """How many runs have a block ``k``."""
        return int(np.searchsorted(-self.blocks, -k, "left"))

    def backward(self, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(vector before each run, vector behind each block) from the vectors behind the runs; any
        number of columns are worked off at once."""
        now = end[self.order].copy()
        behind = []
        for k in range(int(self.blocks.max(initial=0)) - 1, -1, -1):
            n = self.running(k)
            behind.append(now[:n].copy())
            code = self.codes[self.starts[:n] + k]
            now[:n] = TABLES.block[code.reshape(-1, *[1] * (now.ndim - 1)), now[:n]]
        out = np.empty_like(now)
        out[self.order] = now
        return out, behind[::-1]

    def forward(self, behind: list[np.ndarray], state: np.ndarray, found: dict | None = None) -> np.ndarray:
        """The state behind each run from the state before it; ``found`` receives (state before, inserts,
        edit) of every symbol."""
        now = state[self.order].copy()
        for k, ends in enumerate(behind):
            n = len(ends)
            symbols = self.symbols[self.starts[:n] + k]
            if now.ndim > 1:
                symbols = symbols.reshape(n, BLOCK, *[1] * (now.ndim - 1))
            vectors = [ends]  # expanded from the block's end
            for j in range(BLOCK - 1, 0, -1):
                vectors.append(TABLES.back[symbols[:, j], vectors[-1]])
            for j in range(BLOCK):
                key = symbols[:, j], vectors[BLOCK - 1 - j], now[:n]
                if found is not None:
                    place = (self.starts[:n] + k) * BLOCK + j
                    found["state"][place], found["inserts"][place], found["edit"][place] = now[:n], TABLES.inserts[key], TABLES.edit[key]
                now[:n] = TABLES.next[key]
        out = np.empty_like(now)
        out[self.order] = now
        return out


def _chunk(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table, np.ndarray]:
    """(symbols, run starts, rows in order, run sizes) of a chunk."""
    rows = rows.sort_by("pos").combine_chunks()
    conv = pc.dictionary_encode(rows["conv_id"], null_encoding="encode").combine_chunks()
    code = (conv.chunk(0) if isinstance(conv, pa.ChunkedArray) else conv).indices.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return rows["symbol"].to_numpy().astype(np.int64), starts, rows, np.diff(np.append(starts, len(code)))


def _edges(rows: pa.Table) -> pa.Table:
    """For a chunk's first and last run: what they do to any vector behind and any state before them."""
    symbols, starts, rows, sizes = _chunk(rows)
    which = sorted({0, len(starts) - 1})
    n = len(TABLES.vectors)
    runs = Runs(symbols, starts[which], sizes[which])
    before, behind = runs.backward(np.tile(np.arange(n, dtype=np.int16), (len(which), 1)))
    states = np.tile(np.arange(4, dtype=np.int8), (len(which), n, 1))
    left = runs.forward([np.repeat(b[:, :, None], 4, 2) for b in behind], states)
    return pa.table({"conv_id": rows["conv_id"].take(pa.array(starts[which])), "pid": rows["pid"].take(pa.array([0] * len(which))),
                     "chunk": rows["chunk"].take(pa.array([0] * len(which))), "run": pa.array(which, pa.int32()),
                     "before": pa.array([x.astype(np.int16).tobytes() for x in before], pa.binary()),
                     "left": pa.array([x.tobytes() for x in left], pa.binary())})


def _along(fields: list[str], begin: int, read: Callable[[dict, int], int], name: str):
    """Chain the edges of each conversation in the order that they come: each gets the value that the one
    before it left, the first ``begin``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, value, fresh = None, begin, True
        for batch in batches:
            out, first = [], []
            for row in batch.to_pylist():
                fresh = fresh or row["conv_id"] != conv
                conv, value = row["conv_id"], begin if fresh else value
                out.append(value)
                first.append(fresh)
                value, fresh = read(row, value), False
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in fields), pa.array(out, pa.int16()),
                                              pa.array(first, pa.bool_())], names=[*fields, name, f"{name}_first"])

    return run


def _trace(rows: pa.Table, edges: pa.Table) -> pa.Table:
    """The edits of a chunk's rows."""
    symbols, starts, rows, sizes = _chunk(rows)
    n = len(starts)
    end, state, last = np.zeros(n, np.int16), np.full(n, START, np.int8), np.ones(n, bool)
    at = edges["run"].to_numpy()
    end[at], state[at], last[at] = edges["end"].to_numpy(), edges["state"].to_numpy(), edges["end_first"].to_numpy(zero_copy_only=False)
    runs = Runs(symbols, starts, sizes)
    _, behind = runs.backward(end)
    found = {k: np.zeros(runs.symbols.size, np.int8) for k in ("state", "inserts", "edit")}
    left = runs.forward(behind, state, found)
    out = {}
    for k, v in found.items():
        out[k] = np.empty(len(symbols), np.int8)
        out[k][runs.of] = v[runs.at]
    closing = np.zeros(len(symbols), np.int8)
    closing[starts + sizes - 1] = np.where(last, TABLES.closing[left], 0)
    left_state = np.zeros(len(symbols), np.int8)
    left_state[starts + sizes - 1] = left
    return pa.table({"pid": rows["pid"], "pos": rows["pos"], "duplicate": rows["duplicate"],
                     **{k: pa.array(v.astype(np.int32)) for k, v in (*out.items(), ("closing", closing), ("left", left_state))}})


def _roles(state, count):
    """The roles of ``count`` inserts made from ``state`` on."""
    first = F.when(state == USER, F.lit(ROLES[ASSISTANT])).otherwise(F.lit(ROLES[USER]))
    second = F.when(state == USER, F.lit(ROLES[USER])).otherwise(F.lit(ROLES[ASSISTANT]))
    return F.transform(F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")),
                       lambda k: F.when(k % 2 == 1, first).otherwise(second))


def edits(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, role, text, pid and pos (its place in the order of all rows), fault
    (``blank``, ``duplicate``, ``truncated`` or null), ``before`` (roles of the turns inserted before it),
    edit (``D``, ``K`` or ``R``), new_role (null if it goes) and ``after`` (roles inserted at the end)."""
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    own = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    # The range bounds hold no long text; rows with the same beginning stay together.
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    placed = (own.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
              .withColumn("pid", F.spark_partition_id())
              .withColumn("pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    rows = saved(placed, "turns")
    tail = F.rtrim(F.col("text"), F.lit(WHITE))
    last = F.right(tail, F.lit(1))
    kind = F.instr(F.lit("sua"), F.substring("role", 1, 1))  # an empty role would be found, too
    kind = F.when((F.col("role") == "") | (kind == 0), 4).otherwise(kind)
    seen = rows.select("conv_id", "pid", "pos", (tail == "").alias("blank"), ((tail != "") & ~last.isin(".", "!", "?")).alias("cut"), kind.alias("kind"),
                       F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))).alias("h"))
    # The first of the rows that are alike; joined by place, so a text that stands everywhere is no hot key.
    firsts = (seen.where(~F.col("blank")).groupBy("conv_id", "h").agg(F.min(F.struct("pid", "pos")).alias("f"))
              .select("f.pid", "f.pos", F.lit(True).alias("first")))
    marked = seen.join(firsts, ["pid", "pos"], "left").withColumn("duplicate", ~F.col("blank") & F.col("first").isNull())
    symbol = F.when(F.col("blank") | F.col("duplicate"), MUST_GO).otherwise(2 * F.col("kind") - 1 + F.col("cut").cast("int"))
    marked = saved(marked.select("conv_id", "pid", "pos", "duplicate", symbol.cast("int").alias("symbol"),
                                 F.shiftright("pos", CHUNK.bit_length() - 1).alias("chunk")), "symbols")
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    edge = saved(marked.groupBy("pid", "chunk").applyInArrow(_edges, f"{conv}, pid int, chunk long, run int, before binary, left binary"), "edges")
    fields = ["conv_id", "pid", "chunk", "run", "left"]
    spread = edge.repartition("conv_id")
    width = len(TABLES.vectors)
    ends = spread.sortWithinPartitions(F.col("conv_id"), F.desc("pid"), F.desc("chunk"), F.desc("run")).mapInArrow(
        _along(fields, 0, lambda r, v: int(np.frombuffer(r["before"], np.int16)[v]), "end"),
        f"{conv}, pid int, chunk long, run int, left binary, end short, end_first boolean")
    fields = ["pid", "chunk", "run", "end", "end_first"]
    chained = ends.repartition("conv_id").sortWithinPartitions("conv_id", "pid", "chunk", "run").mapInArrow(
        _along(fields, START, lambda r, q: int(np.frombuffer(r["left"], np.int8).reshape(width, 4)[r["end"], q]), "state"),
        "pid int, chunk long, run int, end short, end_first boolean, state short, state_first boolean")
    made = marked.groupBy("pid", "chunk").cogroup(saved(chained, "chain").groupBy("pid", "chunk")).applyInArrow(
        _trace, "pid int, pos long, duplicate boolean, state int, inserts int, edit int, closing int, left int")
    # From the state before the inserts to the one before the edit.
    behind = F.when(F.col("inserts") == 0, F.col("state")).when((F.col("state") == USER) == (F.col("inserts") % 2 == 1), ASSISTANT).otherwise(USER)
    joined = rows.join(made, ["pid", "pos"])
    fault = (F.when(tail == "", "blank").when(F.col("duplicate"), "duplicate").when(~last.isin(".", "!", "?"), "truncated"))
    return joined.select(
        "conv_id", "turn", "role", "text", "pid", "pos", fault.alias("fault"), _roles(F.col("state"), F.col("inserts")).alias("before"),
        F.substring(F.lit("DKR"), F.col("edit"), F.lit(1)).alias("edit"),
        F.when(F.col("edit") == 2, F.col("role")).when(F.col("edit") == 3, F.when(behind == USER, ROLES[ASSISTANT]).otherwise(ROLES[USER])).alias("new_role"),
        _roles(F.col("left"), F.col("closing")).alias("after"))


def repaired(found: DataFrame) -> DataFrame:
    """The repaired turns of :func:`edits`: conv_id, pid, pos, k (their order), role, text."""
    def empty(roles):
        return F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    own = F.when(F.col("new_role").isNotNull(), F.array(F.struct(F.col("new_role").alias("role"), "text"))).otherwise(
        F.array().cast("array<struct<role:string,text:string>>"))
    return found.select("conv_id", "pid", "pos", F.posexplode(F.concat(empty(F.col("before")), own, empty(F.col("after")))).alias("k", "t")).select(
        "conv_id", "pid", "pos", "k", "t.role", "t.text")


REPORT = [T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
LEGAL = {"su", "ua", "au"}


class _Report:
    """What a conversation's rows add up to, read in order."""

    def __init__(self, conv):
        self.conv, self.turns, self.low, self.high = conv, 0, None, None
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.cost, self.audit, self.initial, self.lines, self.digest = 0, [], None, 0, hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.digest.update(("\n" * (self.lines > 0) + role + ":" + text).encode())
        self.lines += 1

    def add(self, r: dict) -> None:
        if r["turn"] is not None and r["turn"] != self.high:
            self.low = r["turn"] if self.low is None else self.low
            self.high, self.turns = r["turn"], self.turns + 1
        if r["fault"]:
            self.counts[r["fault"]] += 1
        initial = r["role"][:1]
        self.counts["illegal"] += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        for role in r["before"]:
            self._line(role, "")
        if r["new_role"] is not None:
            self._line(r["new_role"], r["text"])
        for role in r["after"]:
            self._line(role, "")
        self.audit.append("I" * len(r["before"]) + r["edit"] + "I" * len(r["after"]))
        self.cost += INSERT * (len(r["before"]) + len(r["after"])) + {"D": DELETE, "K": 0, "R": REROLE}[r["edit"]] + (
            r["edit"] != "D" and r["fault"] == "truncated")

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, gaps, *self.counts.values(), self.cost, "".join(self.audit), self.digest.hexdigest()


def report(found: DataFrame) -> DataFrame:
    """One row per conversation of :func:`edits`: missing turn numbers, faults, illegal neighbours, cost, audit
    (the letters of all edits) and the digest of the repaired turns.  A digest can only be made in
    order, so one task reads a conversation, as a stream; only its audit letters are held."""
    schema = T.StructType([found.schema["conv_id"], *REPORT])
    names = schema.names
    conv = pa.schema([pa.field("c", _arrow_type(found.schema["conv_id"].dataType))]).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if own is None or own.conv != r["conv_id"]:
                    if own:
                        done.append(own.row())
                    own = _Report(r["conv_id"])
                own.add(r)
            if done:
                yield _batch(done)
        if own:
            yield _batch([own.row()])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [conv, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return found.repartition("conv_id").sortWithinPartitions("conv_id", "pid", "pos").mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)
