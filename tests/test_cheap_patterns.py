"""Patterns that are cheap to search match what the plain ones match."""

import random

from pyspark.sql import functions as F
from textmill.functions import normalize as nz
from textmill.functions import rx
from textmill.functions import text as tx

WS = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
PLAIN_SPECIAL = ("(?:^|" + rx.PY_WS + ")(?:[\\p{Sc}(\\[{¿¡]+|[,.?!:;\\\\%}\\])]+|['\"„“`]+)(?=" + rx.PY_WS + "|$)"
                 "|" + rx.PY_WS + "'\\p{IsAlphabetic}|&|@-@|[" + nz.CJK + "]" + rx.PY_WS + "+[" + nz.CJK + "]")
PLAIN_BOUNDARY = r"""(?<=\."|\.\)|[.?!])(?![)'".])"""


def _texts():
    r = random.Random(3)
    parts = [*WS, *" .\"')(!?&@-,:;%$€„“«»`]你好é1aB", "a.b", "@-@", "www.x.org/y", "http://a.bc/d", " 'x", "word", "two words"]
    return ["", *("".join(r.choice(parts) for _ in range(r.choice([1, 2, 4, 12]))) for _ in range(1500))]


def test_trim_takes_what_python_takes(many):
    texts = _texts()
    assert set(rx.PY_WS_CHARS) == set(WS)
    assert many(tx.strip_ws, texts) == [t.strip() for t in texts]


def test_same_places(many):
    texts = _texts()
    for cheap, plain in ((nz._SPECIAL_TOKEN, PLAIN_SPECIAL), (rx.SENTENCE_BOUNDARY, PLAIN_BOUNDARY)):
        marked = [many(lambda c, p=p: F.regexp_replace(c, p, "<$0>"), texts) for p in (cheap, plain)]
        assert marked[0] == marked[1]
    assert many(tx.scrub_urls, texts) == many(lambda c: F.regexp_replace(c, rx.URL, " "), texts)
    spaces = ["", " ", "  ", "a  b c   d ", "\n \n  "]
    assert many(tx.collapse_spaces, spaces) == many(lambda c: F.regexp_replace(c, " +", " "), spaces)


def test_accents_of_every_latin_letter(many):
    import unicodedata

    texts = [*map(chr, range(0xA0, 0x180)), "plain", "Größe déjà", "é"]
    assert many(nz.strip_accents, texts) == ["".join(x for x in unicodedata.normalize("NFD", t) if unicodedata.category(x) != "Mn") for t in texts]
