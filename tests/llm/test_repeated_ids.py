"""Repeated ids in the near-duplicate filter."""

import random

from textmill.llm import minhash


def made(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    rng = random.Random(4)
    copied, clean = made(rng, 50), made(rng, 50)
    df = spark.createDataFrame([(3, copied), (5, copied + " x"), (5, clean), (7, clean + " y"), (None, copied)], "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in minhash.drop_near_duplicates(df).collect()}
    assert got == {(3, copied), (5, clean), (None, copied)}
