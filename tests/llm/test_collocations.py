"""Phrase collocations (op11) against a plain count of every phrase."""

import collections
import random
import re

import pytest

from textmill.llm import collocations

ODD = [(None, "en"), ("", "en"), (" \t ", None), ("...", "de"), ("a b", None), ("A\x0bB a\tb c.C d", "en"), ("Ünï çode Ünï 中文 😀 çode", "und")]


def brute(rows, top, min_count, max_words, cover):
    """Every phrase of every language, counted, scored, dropped and ranked one by one."""
    by_lang = collections.defaultdict(list)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\f\r]", low):
            by_lang[lang or "und"].append([w for w in re.split("[ \t]+", piece) if w])
    out = []
    for lang, pieces in by_lang.items():
        f = collections.Counter(tuple(p[i : i + k]) for p in pieces for k in range(1, max_words + 1) for i in range(len(p) - k + 1))
        cand = {q: a for q, a in f.items() if len(q) > 1 and a >= min_count}
        gone = {q[i : i + k] for q, a in cand.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * a >= cover * cand[q[i : i + k]]}
        best = []
        for q, a in cand.items():
            score, k = min((2_000_000 * a // (f[q[:k]] + f[q[k:]]), k) for k in range(1, len(q)))
            if q not in gone:
                best.append((-score, -a, " ".join(q).encode(), f[q[:k]], f[q[k:]]))
        for rank, (score, a, q, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, q.decode(), -a, left, right, sum(map(len, pieces)), -score))
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    fixed = ["north sea trade wind", "trade wind", "north sea", "one two three four", "x x x x x", "new york city hall"]
    words = [*"abcdefgh", "É", "中文", "wind", "sea", "New", "YORK"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) + rng.choice(["", "", "", ".", ", ", "\n"]) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice([" ", "\t", "  "]).join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    return rows + ODD + rows[:5]


@pytest.mark.parametrize("top", [5, 40, 2000])
def test_equals_plain_counts(spark, top):
    rows = corpus(top, 150)
    df = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n int, gram string").repartition(7)
    got = sorted(map(tuple, collocations.phrases(df, top=top, min_count=5).collect()))
    assert got == brute(rows, top, 5, 4, 80)
    assert len({r[0] for r in got}) >= 3


def test_phrases_that_are_covered_need_more_rounds(spark, monkeypatch):
    """The best pairs all stand inside longer phrases, so the first cuts settle nothing."""
    rounds = []
    own = collocations._cuts
    monkeypatch.setattr(collocations, "FIRST", 1)
    monkeypatch.setattr(collocations, "_cuts", lambda pairs, langs, want: rounds.append(want) or own(pairs, langs, want))
    rng = random.Random(3)
    chains = [f"p{k} q{k} r{k} s{k}" for k in range(60)]
    rows = [(". ".join(chains), "en") for _ in range(6)] + [(" ".join(rng.choice("abcdefgh") for _ in range(200)), "en") for _ in range(20)]
    got = sorted(map(tuple, collocations.phrases(spark.createDataFrame(rows, "text string, lang string"), top=70, min_count=5).collect()))
    assert got == brute(rows, 70, 5, 4, 80)
    assert len(rounds) > 1 and len(got) == 70


def test_filters_only_save_work(spark, monkeypatch):
    """A filter so small that it is full lets everything pass, with the same result."""
    rows = corpus(9, 60)
    df = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 16)
    assert sorted(map(tuple, collocations.phrases(df, top=30, min_count=3, max_words=3, cover=50).collect())) == brute(rows, 30, 3, 3, 50)


def test_exact_beyond_64_bits(spark):
    singles = spark.createDataFrame([("en", "a", 9 * 10**18, [], []), ("en", "b", 8 * 10**18 + 1, [], [])],
                                    "lang string, gram string, n long, heads array<bigint>, tails array<bigint>")
    pairs = spark.createDataFrame([("en", "a b", 8 * 10**18)], "lang string, gram string, n long")
    best = collocations._measured(pairs, singles).first().best
    assert (best.score, best.k, best.l, best.r) == (2_000_000 * 8 * 10**18 // (17 * 10**18 + 1), 1, 9 * 10**18, 8 * 10**18 + 1)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.phrases(empty).collect() == []
    assert collocations.phrases(spark.createDataFrame([(None, None)], "text string, lang string")).collect() == []
