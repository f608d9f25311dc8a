"""Segmentation (E1-E12) against fixtures and independent Python models."""

import random

from pyspark.sql import functions as F

from models import pack, short_line_runs, strip_headers
from textmill.functions import segment as sg
from textmill.functions import text as tx


def test_splits(one):
    assert one(sg.split_chapters_books, "a\n\nb\n\n\nc") == ["a\n\nb", "c"]
    assert one(sg.split_chapters_web, "a\n\nb\n\n\nc") == ["a", "b", "c"]
    assert one(sg.split_chapters_pg, "a * * * * * b") == ["a ", "b"]
    assert one(sg.split_lines, "\na\n") == ["", "a", ""]


def test_sentence_bounds(one):
    assert one(sg.sentence_boundaries, 'Hi "x." b. c) d?! e.) f') == [7, 10, 16, 17, 21]
    assert one(sg.sentence_boundaries, "") == []


def test_pack_fixtures(one):
    assert one(lambda c: sg.sentence_pack(c, 10), "Aaa. Bbb. Ccc.") == ["Aaa. Bbb.", "Ccc."]
    assert one(lambda c: sg.sentence_pack(c, 10), "aaaaa. bbbbb. ccccc. ddddd.") == \
        ["aaaaa.", "bbbbb. cc", "ccc. ddddd", "."]
    assert one(lambda c: sg.sentence_pack(c, 10, True), "aaaaa. bbbbb. ccccc. ddddd.") == \
        ["aaaaa.", "bbbbb.", "ccccc.", "ddddd."]
    assert one(lambda c: sg.sentence_pack(c, 10), "") == []


def _rand_text(rng, n):
    alphabet = "abcde  .?!)'\"\n"
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_pack_matches_model(many):
    rng = random.Random(7)
    texts = [_rand_text(rng, rng.randint(0, 400)) for _ in range(60)]
    for m in (5, 17, 64):
        got = many(lambda c: sg.sentence_pack(c, m), texts)
        assert got == [pack(t, m) for t in texts]
        got = many(lambda c: sg.sentence_pack(c, m, True), texts)
        assert got == [pack(t, m, carry=True) for t in texts]


def test_pack_invariants(many):
    rng = random.Random(3)
    texts = [_rand_text(rng, rng.randint(1, 300)) for _ in range(40)]
    got = many(lambda c: sg.sentence_pack(c, 20), texts)
    for segs in got:
        assert all(len(s) <= 20 for s in segs)


def test_windows(one, many):
    assert one(lambda c: sg.char_windows(c, 3), "abcdefg") == ["abc", "def", "g"]
    rng = random.Random(1)
    texts = [_rand_text(rng, rng.randint(0, 100)) for _ in range(20)]
    got = many(lambda c: F.array_join(sg.char_windows(c, 7), ""), texts)
    assert got == texts


def test_header_strip_matches_model(many):
    rng = random.Random(11)
    pieces = ["Produced by A", "Produced by B\nline", "", "Body text.", "*** START OF X ***", "x" * 30,
              "More body", "E-text prepared by Z"]
    texts = ["\n".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(60)]
    assert many(tx.strip_headers, texts) == [strip_headers(t) for t in texts]


def test_short_runs_match_model(many):
    rng = random.Random(5)
    pieces = ["x", "", "short line", "a line that is clearly longer than twenty"]
    texts = ["\n".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(80)]
    assert many(tx.drop_short_line_runs, texts) == [short_line_runs(t) for t in texts]


def test_idempotent(many):
    texts = ["  a  b \n  c", "x   y", " \n z \t"]
    for f in (tx.strip_indent, tx.collapse_spaces, tx.strip_ws):
        once = many(f, texts)
        assert many(f, once) == once


def test_pack_multibyte_matches_model(many):
    rng = random.Random(9)
    alphabet = "aé😀ß  .?!)'\"\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 500))) for _ in range(80)]
    for m in (3, 16, 50):
        assert many(lambda c: sg.sentence_pack(c, m), texts) == [pack(t, m) for t in texts]
        assert many(lambda c: sg.sentence_pack(c, m, True), texts) == [pack(t, m, carry=True) for t in texts]
    assert many(sg.sentence_boundaries, texts) == [__import__("models").boundaries(t) for t in texts]


def test_long_paragraph_matches_model(many):
    rng = random.Random(13)
    words = ["word", "ünï", "x" * 300, "end.", "why?", "😀", "(a.)", '"q."']
    text = " ".join(rng.choice(words) for _ in range(40000))
    assert many(lambda c: sg.sentence_pack(c, 1024), [text]) == [pack(text, 1024)]
    assert many(lambda c: sg.char_windows(c, 777), [text])[0] == [text[i:i + 777] for i in range(0, len(text), 777)]


def test_header_strip_has_no_round_cap(one):
    text = "Produced by someone\n\n" * 60 + "The book begins here.\n\nMore."
    # each match takes two stacked headers: 30 strips, all before offset 10 000
    assert one(tx.strip_headers, text) == strip_headers(text) == "The book begins here.\n\nMore."
