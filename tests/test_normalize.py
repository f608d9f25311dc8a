"""Normaliser columns."""

import unicodedata

from textmill.functions import normalize as nz


def test_special_map(one):
    assert one(nz.special_normalize, "¨") == '"'
    assert one(nz.special_normalize, "a​b") == "a b"
    assert one(nz.special_normalize, "♪●&lrm;") == " -"


def test_nfkc_matches_python(many):
    vals = ["ﬁ café … ½", "Ünïcödé", "plain ascii", "Ｆｕｌｌ", "é"]
    assert many(nz.nfkc, vals) == [unicodedata.normalize("NFKC", v) for v in vals]


def test_punct(one):
    assert one(nz.moses_punct_normalize, "«Hello World» — she said…") == '"Hello World" - she said...'
    assert one(nz.moses_punct_normalize, "a ( b ) , c :d 5 % x") == "a (b), c:d 5% x"


def test_detokenize(one):
    assert one(nz.fix_tokenized, 'Hello  ,  world !\n\nIt \' s " quoted " text . $ 5 ( x )') == \
        'Hello, world! It \'s "quoted" text. $5 (x)'
    assert one(nz.fix_tokenized, "The Jones ' house and ' single ' quote") == "The Jones' house and 'single' quote"
    assert one(nz.fix_tokenized, "  ") == ""
    assert one(nz.fix_tokenized, "a &amp; b") == "a & b"


def test_default_chain(one):
    assert one(nz.normalize_text, "«Hello World» — she said… and “yes”") == \
        '"Hello World" - she said... and "yes"'


def test_unescape_and_lower(one):
    assert one(nz.unescape_html, "a &amp; b &copy; &middot; &quot;q&quot; &#39;") == "a & b © · \"q\" '"
    assert one(nz.lowerize, "ÀB") == "àb"


def test_tokenize(one):
    toks = one(nz.moses_tokenize, "Hello, world! It's (x) $5.")
    assert toks[:4] == ["Hello", ",", "world", "!"]
    assert "&apos;s" in toks and toks[-1] == "."


def _rand(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_punct_groups_match_sequential_rules(many):
    import random

    from models import punct_normalize

    rng = random.Random(2)
    alphabet = ["a", "b", "1", " ", "  ", "(", ")", ".", ",", ":", ";", "%", "`", "'", '"', "„", "“", "”", "–", "—",
                "´", "‘", "’", "…", "«", "»", " ", "nº", "\r", "\n"]
    texts = [_rand(rng, alphabet, rng.randint(0, 40)) for _ in range(300)]
    assert many(nz.moses_punct_normalize, texts) == [punct_normalize(t) for t in texts]


def test_detokenize_matches_model(many):
    import random

    from models import detokenize

    rng = random.Random(4)
    words = ["word", "Jones", "is", "'s", "'", '"', "``", ",", ".", "?!", ")", "(", "$", "€", "5", "&amp;", "@-@", "it",
             "„", "“", "x y"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 15))) for _ in range(300)]
    assert many(nz.fix_tokenized, texts) == [detokenize(t) for t in texts]


def test_unescape_html5(one):
    assert one(nz.unescape_html, "&amp; &NotEqualTilde; &copy x") == "& ≂̸ © x"


def test_unescape_equals_the_standard_library(spark):
    """All names with and without semicolon, numbers, and references put together at random."""
    import html
    import random
    from html.entities import html5

    from pyspark.sql import functions as F

    rng = random.Random(5)
    numbers = [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFFFE, 0x10FFFE, 0x10FFFF, 0x110000, 2**40, 10**30]
    refs = [f"&{n}" for n in html5] + [f"&{n.rstrip(';')}" for n in html5] + [f"&#{n};" for n in numbers] + [f"&#x{n:X}" for n in numbers] + [f"&#X000{n:x};" for n in numbers]
    texts = ["|".join(refs[k : k + 40]) for k in range(0, len(refs), 40)]
    parts = refs + ["&", ";", " ", "x", "&&", "&#", "&#x", "&#;", "&notit;", "&notin", "é", "😀", "&é;", "&ampamp;", "&" + "a" * 40, "\n", "<", "&lt", "gt;", "1", "&#12", "&AMP", "$1", "\\"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(3000)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None])], "k int, t string")
    got = {r.k: r.o for r in df.select("k", nz.unescape_html(F.col("t")).alias("o")).collect()}
    assert [got[k] for k in range(len(texts))] == [html.unescape(t) for t in texts]
    assert got[len(texts)] is None


def test_latin1_fast_paths_match_python(many):
    import random
    import unicodedata

    rng = random.Random(17)
    alphabet = ["a", "Z", " ", "é", "ß", "Ñ", "ÿ", "ª", "²", "½", "¨", " ", "µ", "´", "́", "ﬁ", "Ω", "한",
                "…", "×", "¿", "ø"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    assert many(nz.nfkc, texts) == [unicodedata.normalize("NFKC", t) for t in texts]

    def strip(t):
        return "".join(ch for ch in unicodedata.normalize("NFD", t) if unicodedata.category(ch) != "Mn")

    assert many(nz.strip_accents, texts) == [strip(t) for t in texts]


def test_published_punctuation_pair(one):
    assert one(nz.moses_punct_normalize, "«Hello World» — she said…") == '"Hello World" - she said...'


def test_moses_sentence_periods_and_multi_dots(one):
    cases = {
        "Hello world. Next one... and more. End": "Hello world . Next one ... and more . End",
        "wait...": "wait ...",
        "Mr. Smith and Dr. No. went": "Mr. Smith and Dr. No. went",
        "No. 5 and No. Five": "No. 5 and No . Five",
        "the U.S. Army, e.g. this. that": "the U.S. Army , e.g. this. that",
        "It ended. 'Yes.' He left.": "It ended . &apos; Yes . &apos; He left .",
        "A. Person has 3.14, not 2.": "A. Person has 3.14 , not 2 .",
        "a | b [c] <d> & \"e\"": "a &#124; b &#91; c &#93; &lt; d &gt; &amp; &quot; e &quot;",
    }
    for text, want in cases.items():
        assert " ".join(one(nz.moses_tokenize, text)) == want


def test_detokenizer_unescapes_what_the_tokenizer_escapes(one):
    text = "a | b [c] & e"
    tokens = " ".join(one(nz.moses_tokenize, text))
    assert one(nz.fix_tokenized, tokens) == "a | b [c] & e"


def test_cjk_tokens_attach(one):
    assert one(nz.fix_tokenized, "你好 世界 and 日本 語の x 世") == "你好世界 and 日本語の x 世"
    assert one(nz.fix_tokenized, "你好 , 世界") == "你好, 世界"


def test_many_quotes_are_linear(one):
    import time

    t0 = time.time()
    out = one(nz.fix_tokenized, '" a \' b ' * 20_000)
    assert out.startswith('"a \'b"a\' b') or out.startswith('"a')
    assert time.time() - t0 < 10


def test_quotes_agree_with_the_model(many):
    import random

    from models import detokenize

    rng = random.Random(12)
    pieces = ['"', "'", "''", "“", "„", "`", "words", "a", "is", "'s", ",", "(", ")", "$", "世", "界x"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 24))) for _ in range(400)]
    assert many(nz.fix_tokenized, texts) == [detokenize(t) for t in texts]


def test_special_map_with_compatibility_characters(one):
    assert one(nz.special_normalize, "ﬁne Ａ１ ① ｶ ª º … ¨x") == 'fine A1 1 カ a o ... "x'
