"""Several templates in a leaf, long lines shared by few documents."""

import random

import corpus_pipeline
from textmill.llm import lines


def made(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))


def test_templates_of_equal_share_do_not_hide_each_other(spark):
    rng = random.Random(2)
    rows = []
    for k in range(50):
        shapes = ["posted in category {} by author of the day", "posted in category {} with many useful tags inside"]
        name = "".join(rng.choices("abcdefgh", k=6))
        rows.append((k, f"{made(rng, 8)}\n{shapes[k % 2].format(name)}\nposted in category {made(rng, 6)}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in lines.drop_recurring_lines(df, several=True).collect():
        own = dict(rows)[r.doc_id].split("\n")
        assert r.text.split("\n") == [own[0], own[2]]


def test_long_lines_of_few_documents_stay_once(spark):
    rng = random.Random(3)
    passage = {n: made(rng, 60) for n in range(2, 10)}
    rows = [(100 * n + k, "\n".join([made(rng, 80), passage[n], made(rng, 80)]), 0) for n in passage for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    out = corpus_pipeline.near_dedup(spark, df, "").collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    own = {k: t.split("\n") for k, t, _ in rows}
    for n, p in passage.items():
        assert sum(p in r.text for r in out) == 1
    assert all(r.text in ("\n".join(own[r.doc_id]), "\n".join(own[r.doc_id][::2])) for r in out)

def test_very_long_lines_are_linear(spark):
    """Near copies of one line of 20 000 tokens: each leaves out another token."""
    import time

    rng = random.Random(4)
    line = made(rng, 20_000).split(" ")
    rows = [(k, " ".join([*line[: 5000 + k], "changed", *line[5001 + k :]]) + "\nown line") for k in range(12)]
    t0 = time.time()
    out = lines.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), several=True).collect()
    assert time.time() - t0 < 60
    assert {r.n_dropped for r in out} == {2}
