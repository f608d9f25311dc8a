"""Language ID (op2) with more languages than a byte can number."""

import collections

from textmill.llm import langid


def test_four_hundred_languages(spark):
    rows = [(k, f"{chr(0x4E00 + k % 400)} word{k % 400} abc", f"lang{k % 400:03d}") for k in range(800)]
    counts = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1))
    assert len(counts.languages) == 400
    got = collections.Counter()
    for lang, length, n in zip(counts.lang.tolist(), counts.length.tolist(), counts.n.tolist()):
        got[counts.languages[lang], length] += n
    for k in range(langid.ORDER + 1):
        assert {lang: got[lang, k] for lang in counts.languages} == {
            lang: sum(len(t.encode()) - k for _, t, own in rows if own == lang) for lang in counts.languages}
    pred = langid.predict(spark.createDataFrame(rows[:400], "doc_id long, text string, lang string"), counts).collect()
    assert all(r.lang_pred == r.lang for r in pred)
