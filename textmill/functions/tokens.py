"""Word normalisation and pre-tokenisation (G1), BERT style, as JVM expressions.

Steps, in order: drop control characters, map whitespace to a space, pad CJK
ideographs with spaces, lower-case, strip accents, then split on whitespace
and isolate every punctuation character as its own token.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions import rx
from textmill.functions.normalize import strip_accents
from textmill.functions.text import _c, let


# CJK ideograph blocks the BERT normaliser pads with spaces.
CJK = (r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
       r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}]")
# BERT punctuation: ASCII symbol ranges plus every Unicode P* character.
PUNCT = r"[\p{P}!-/:-@\[-`{-~]"
CONTROL = r"[\p{C}&&[^\t\n\r]]|\x{FFFD}"
WHITESPACE = r"[\s\p{Z}]"


# Built by rule from Unicode data, for the characters below U+0100 that the normaliser neither drops nor pads: the
# punctuation among them, and those with an accent and what is left of them.
_LATIN = [ch for ch in map(chr, range(0x100)) if ch in "\t\n\r " or unicodedata.category(ch)[0] not in "CZ"]
_RARE = "[^" + "".join(map(rx.singles, _LATIN, _LATIN)) + "]"
_NON_ASCII = "[^" + rx.singles("\0", "\x7f") + "]"
_LATIN_PUNCT = "".join(rx.singles(ch, ch) for ch in _LATIN if unicodedata.category(ch)[0] == "P" or "!" <= ch <= "~" and not ch.isalnum())
_ACCENTED = "".join(ch for ch in _LATIN if unicodedata.normalize("NFD", ch) != ch)
_BARE = "".join(unicodedata.normalize("NFD", ch)[0] for ch in _ACCENTED)


def word_normalize(c) -> Column:
    """BERT normaliser: clean, pad CJK, lower-case, strip accents."""
    t = F.regexp_replace(_c(c), CONTROL, "")
    t = F.regexp_replace(t, WHITESPACE, " ")
    t = F.regexp_replace(t, "(" + CJK + ")", " $1 ")
    return strip_accents(F.lower(t))


def word_tokens(c) -> Column:
    """G1: ``ARRAY<STRING>`` of word and punctuation tokens.  A text of plain Latin-1 characters only, in which
    nothing is dropped or padded but punctuation, takes fewer and cheaper scans to the same tokens."""

    def latin(t):
        low = let(F.lower(t), lambda x: F.when(F.regexp_like(x, F.lit(_NON_ASCII)), F.translate(x, _ACCENTED, _BARE)).otherwise(x))
        return F.split(F.regexp_replace(low, "[" + _LATIN_PUNCT + "]", " $0 "), r"[ \t\n\r]", -1)

    def body(t):
        whole = F.split(F.regexp_replace(word_normalize(t), "(" + PUNCT + ")", " $1 "), " +", -1)
        return F.when(F.regexp_like(t, F.lit(_RARE)), whole).otherwise(latin(t))

    return F.filter(let(c, body), lambda w: w != "")
