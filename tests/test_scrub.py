"""Hand-derived cases (FIXTURES.md §2) for the scrubbing steps D1-D17 and C9-C13."""

from textmill.functions import text as tx
from textmill.operators import profiles as pr


def test_strip_indent(one):
    assert one(tx.strip_indent, "  a\n b\nc ") == "a\nb\nc "


def test_mojibake(one):
    assert one(tx.fix_mojibake, "itâ\u0080\u0099s cafÃ©") == "it's café"
    assert one(tx.fix_mojibake, "â¦") == "â¦"


def test_italics_brackets(one):
    assert one(tx.unwrap_italics, "a _b_ c") == "a  b  c"
    assert one(tx.unwrap_italics, "x_y_z") == "x y z"
    assert one(tx.unwrap_brackets, "a [b] c") == "a  b  c"


def test_line_drops(one):
    assert one(tx.drop_md_headers, "# T\nbody") == "\nbody"
    assert one(tx.drop_md_headers, "#\nbody") == "#\nbody"
    assert one(tx.drop_chapter_lines, "Chapter 1") == ""
    assert one(tx.drop_chapter_lines, "chapterhouse was old") == ""
    assert one(tx.drop_chapter_lines, "Chapter") == "Chapter"
    assert one(tx.drop_bold_lines, "**Head** x\nbody") == "\nbody"
    assert one(tx.blockquote_to_space, ">a\n>b") == " a\n b"
    assert one(tx.bold_markers_to_space, "a**b**c") == "a b c"


def test_urls(one):
    assert one(tx.scrub_urls, "see www.example.com/x now") == "see   now"
    assert one(tx.scrub_urls, "end.Next one") == "  one"
    assert one(tx.scrub_urls, "mail a.b@c.org now") == "mail   now"


def test_illustrations(one):
    assert one(tx.drop_illustrations_books, "[Illustration\nmore]\nafter") == " \nafter"
    assert one(tx.drop_illustrations_pg, "x [a\nb] y") == "x  y"


def test_license_and_headers(one):
    assert one(tx.cut_license, "a\n*** END OF X ***\nb") == "a"
    assert one(tx.cut_license, "no licence here") == "no licence here"
    assert one(tx.strip_headers, "Produced by X\n\nBody one.\n\nBody two.") == "Body two."
    # a match ending at or after 10 000 chars is not stripped
    far = "x" * 10000 + "\nProduced by X\n\nBody."
    assert one(tx.strip_headers, far) == far


def test_list_runs(one):
    assert one(tx.drop_bold_runs, "**A** x\n**B** y\nend") == "end"
    assert one(tx.drop_numbered_runs, "1 a\n2 b\n3 c\ntext") == "text"
    assert one(tx.drop_numbered_runs, "1 a\n2 b\ntext") == "1 a\n2 b\ntext"
    tail = "a long tail line of text here"
    assert one(tx.drop_short_line_runs, "x\n" * 10 + tail) == "\n" + tail
    assert one(tx.drop_short_line_runs, "x\n" * 9 + tail) == "x\n" * 9 + tail
    assert one(tx.drop_short_line_runs, "x\n\n" * 5 + tail) == "\n" + tail
    assert one(tx.drop_contents_runs, "I went home\nIt was late\nIn bed\nend") == "end"


def test_list_runs_do_not_overflow_the_stack(one):
    assert one(tx.drop_short_line_runs, "x\n" * 100000 + "end of it all here") == "\nend of it all here"
    assert one(tx.drop_numbered_runs, "1 a\n" * 50000 + "text") == "text"


def test_strip_ws(one):
    assert one(tx.strip_ws, " \t x y \n　") == "x y"


def test_paragraph_quality(many):
    vals = ["Hello", "Hello!", "abc123", "ab1234", "Copyright 1999 by A", "éééééé"]
    assert many(tx.paragraph_ok, vals) == [False, True, True, False, False, False]


def test_upper_lines(many):
    keep = lambda c: tx.has_non_space(c) & ~tx.is_upper(c)
    assert many(keep, ["IN CAPITALS", "1234", "  ", "A1", "STRAßE x"]) == [False, True, False, False, True]


def test_cleaners(one):
    web = "Hello world this is text.\nISBN 123 bad line here\n\nshort\n\n> quoted _it_ line with words"
    assert one(pr.clean_webcrawl, web) == ["Hello world this is text.", "quoted it line with words"]
    assert one(pr.clean_wiki, "Intro text here.\n\nReferences\nSome Book Title") == ["Intro text here."]
    book = "**A** x\n**B** y\n\n\n\nChapter one is here\nThe story starts here today.\n\n\nISBN 1234"
    assert one(pr.clean_books3, book) == ["The story starts here today.", ""]
    pg = "Produced by Someone\n\nThe real text starts here.\nMORE CAPS\nand goes on.\n*** END OF IT ***\nlegal"
    assert one(pr.clean_gutenberg, pg) == ["The real text starts here.\nand goes on."]


def test_dispatch_and_validation(spark):
    import pytest
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("Wikipedia (en)", "Intro text here.\n\nSee also x")], "s string, t string")
    out = df.select(pr.clean_by_subset(F.col("t"), F.col("s")).alias("o")).first()["o"]
    assert out == ["Intro text here."]
    with pytest.raises(ValueError):
        pr.validate_subsets(["Nope"])


def test_register_python_profile(spark):
    from pyspark.sql import functions as F

    pr.register_profile("upper_lines", lambda t: [x.upper() for x in t.split("\n")], ["MySource"], python=True)
    df = spark.createDataFrame([("MySource", "a\nb")], "s string, t string")
    out = df.select(pr.clean_by_subset(F.col("t"), F.col("s"), ["MySource"]).alias("o")).first()["o"]
    assert out == ["A", "B"]


def test_books3_skipped_indent_strips_are_noops(many):
    import random

    from pyspark.sql import functions as F

    from textmill.functions.segment import split_chapters_books

    def every_step(c):
        b = c
        for f, _ in pr._BOOKS3_STEPS:
            b = tx.strip_indent(f(b))
        return pr._chapters_to_paragraphs(split_chapters_books(b), strip_after_collapse=True)

    rng = random.Random(21)
    parts = [" ", "  ", "\n", "\n\n\n", "# head", "**b** x", "_it_", "[br]", ">", "1 a", "Chapter 9", "x",
             "Some longer words of text.", "â\u0080\u0099", "Ã©", "**"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    assert many(pr.clean_books3, texts) == many(every_step, texts)


def test_license_cut_counts_code_points(one):
    assert one(tx.cut_license, "body😀😀😀\n*** END OF X ***\nlegal") == "body😀😀😀"


def test_upper_with_ordinal_indicators(one):
    for text in ("1ª EDICIÓN", "Nº 5", "ABC", "ABC 1", "123", "", "Ab", "ß", "ÀÉ ǅ", "Ⅷ", "ÇA"):
        assert one(tx.is_upper, text) == text.isupper(), text
