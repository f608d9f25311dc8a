"""Conversation repair (op12) against a plain search for the cheapest, least edits."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from textmill.llm import queries, repair

PATTERN = re.compile(r"(s?(ua)+)?")
ROWS = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, audit, repaired turns) of (role, text, fault) rows: every edit tried at every place, least first."""
    onward = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    best = {q: (0, "", ()) if q in ("", "a") else None for q in onward}

    def inserts(best):
        for _ in range(4):
            for q, to in onward.items():
                if best[to] is not None:
                    way = (best[to][0] + 2, "I" + best[to][1], ((names[to], ""), *best[to][2]))
                    best[q] = way if best[q] is None else min(best[q], way, key=lambda x: x[:2])
        return best

    best = inserts(best)
    for role, text, fault in reversed(rows):
        new = {}
        for q, to in onward.items():
            c, audit, rest = best[q]
            ways = [(c + 3, "D" + audit, rest)]
            if fault not in ("blank", "duplicate"):
                t = fault == "truncated"
                c, audit, rest = best[to]
                ways.append((c + 2 + t, "R" + audit, ((names[to], text), *rest)))
                initial = role[:1]
                if initial and (initial in "ua" and initial == to or initial == "s" and q == ""):
                    c, audit, rest = best[initial]
                    ways.append((c + t, "K" + audit, ((role, text), *rest)))
            new[q] = min(ways, key=lambda x: x[:2])
        best = inserts(new)
    return best[""]


def plain(rows):
    """The query's rows for (conv_id, turn, role, text) rows before damage."""
    damaged = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        own = damaged[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own.extend([(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1))
    out = []
    for conv, own in damaged.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in own:
            kept = text.strip(" \t\n\x0b\f\r")
            faults.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [t for t, *_ in own if t is not None]
        cost, audit, fixed = cheapest([(r, t, f) for (_, r, t), f in zip(own, faults)])
        assert PATTERN.fullmatch("".join(r[0] for r, _ in fixed))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        role = ""
        for turn in range(rng.randint(0, longest)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None]) if rng.random() < 0.3 else "assistant" if role == "user" else "user"
            text = rng.choice(["Yes.", "No!", "what", "", " \t\x0b", None, "Ünï 中文?  ", "same text."])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, 2 * turn, None]), role, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk, seed", [(4096, 1), (4, 2), (1, 3)])
def test_equals_plain_search(spark, monkeypatch, tmp_path, chunk, seed):
    """Also with chunks so small that conversations are cut many times."""
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rows = conversations(seed, 120, 25)
    rows += rows[:10]
    spark.createDataFrame([(*r, 7, "x") for r in rows], f"{ROWS}, pos int, fault string").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_repair(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0] is not None, r[0] or 0)) == plain(rows)


def test_short_sequences_all(spark):
    """Every sequence of up to three symbols."""
    kinds = [("system", "a."), ("user", "b."), ("assistant", "c."), ("tool", "d."), ("system", "e"), ("user", "f"), ("assistant", "g"), ("x", "h"), ("user", " ")]
    rows, want = [], {}
    for conv, n in enumerate([9**k + x for k in range(1, 4) for x in range(9**k)]):
        k = 1 if n < 18 else 2 if n < 162 else 3
        digits = [(n - 9**k) // 9**j % 9 for j in range(k)]
        own = [(kinds[d][0], kinds[d][1].replace(".", f"{j}.") if kinds[d][1] != " " else " ") for j, d in enumerate(digits)]
        rows += [(conv, j, r, t) for j, (r, t) in enumerate(own)]
        seen, faults = set(), []
        for r, t in own:
            faults.append("blank" if t == " " else "duplicate" if (r, t) in seen else None if t.endswith(".") else "truncated")
            seen.add((r, t))
        cost, audit, fixed = cheapest([(*o, f) for o, f in zip(own, faults)])
        want[conv] = (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    found = repair.report(repair.edits(spark.createDataFrame(rows, ROWS)))
    assert {r.conv_id: (r.cost, r.audit, r.repaired_sha256) for r in found.collect()} == want


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    """A conversation with most of all rows is spread by the range sort and cut into chunks."""
    monkeypatch.setattr(repair, "CHUNK", 16)
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["ok.", f"text {t}.", f"cut {t}"])) for t in range(3000)]
    rows += [(k, 0, "user", "hello.") for k in range(2, 40)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repair.edits(spark.createDataFrame(rows, ROWS)).checkpoint()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.where("conv_id = 1").select("pid").distinct().count() > 3
    seen, faults = set(), []
    for _, _, role, text in rows[:3000]:
        faults.append("duplicate" if (role, text) in seen else None if text.endswith(".") else "truncated")
        seen.add((role, text))
    cost, audit, fixed = cheapest([(r[2], r[3], f) for r, f in zip(rows, faults)])
    got = repair.report(found).where("conv_id = 1").first()
    assert (got.cost, got.audit) == (cost, audit)
    turns = repair.repaired(found).where("conv_id = 1").orderBy("pid", "pos", "k").select("role", "text").collect()
    assert [tuple(t) for t in turns] == list(fixed)


def test_empty_and_long(spark):
    empty = repair.edits(spark.createDataFrame([], ROWS))
    assert empty.collect() == [] and repair.report(empty).collect() == []
    long = "word " * 200_000
    got = repair.report(repair.edits(spark.createDataFrame([(1, None, None, None), (2, 0, "user", long + "end.")], ROWS))).orderBy("conv_id").collect()
    assert [(r.blank, r.cost, r.audit) for r in got] == [(1, 3, "D"), (0, 2, "KI")]
    assert got[1].repaired_sha256 == hashlib.sha256(f"user:{long}end.\nassistant:".encode()).hexdigest()
