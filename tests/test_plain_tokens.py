"""Plain Latin-1 texts take a cheaper way to the same word tokens."""

import random
import unicodedata

from pyspark.sql import functions as F

from textmill.functions import tokens as tk


def _whole(c):
    t = F.regexp_replace(tk.word_normalize(c), "(" + tk.PUNCT + ")", " $1 ")
    return F.filter(F.split(t, " +", -1), lambda w: w != "")


def test_plain_texts_have_the_tokens_of_the_whole_normaliser(spark):
    rng = random.Random(3)
    singles = [chr(k) for k in range(0x180)] + list("̀́;` ​　一�\U0001f600ſİΣς")
    texts = [f"Ab{ch}Cd {ch}{ch} E" for ch in singles]
    texts += ["".join(rng.choice(singles) for _ in range(40)) for _ in range(300)]
    texts += ["".join(chr(rng.choice([*range(0x20, 0x7f), 9, 10, 13, *range(0xC0, 0x100)])) for _ in range(200)) for _ in range(300)]
    texts += ["", " ", "\n", "...", "  a  ", "\ta\r\nb\n\n", "Été – Straße: ÿ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", tk.word_tokens("t").alias("new"), _whole(F.col("t")).alias("old")).collect()
    assert len(got) == len(texts)
    assert [(r.t, r.new) for r in got if r.new != r.old] == []


def test_plain_texts_skip_the_whole_normaliser():
    import re

    rare = re.compile(tk._RARE)
    assert not rare.search("Hello, wörld!\n\tÉté «x» 100 % §5\r\n")
    assert all(rare.search(ch) for ch in "\x00\x0b\x1f\x7f\x85\xa0\xadſ́一")
    assert all(unicodedata.normalize("NFD", a)[0] == b for a, b in zip(tk._ACCENTED, tk._BARE))
