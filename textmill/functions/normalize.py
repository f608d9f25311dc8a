"""Text normaliser columns.

Unicode NFKC / NFD have no Spark SQL built-in, but a library that Spark itself
ships (ICU4J) has static methods for them, called with ``java_method``.  HTML
references are looked up in constant maps (``entities``).  Everything stays
JVM-side, no Python.

The punctuation normaliser and the (de)tokeniser follow the English rules of
the Moses toolkit (Koehn et al., 2007) as published in its scripts; they are
ordered regex rewrites plus, for the detokeniser, a per-token state machine
written with higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions import rx
from textmill.functions.segment import prefix_sums
from textmill.functions.text import _c, let, strip_ws


def _java(cls: str, method: str, *args) -> Column:
    return F.call_function("java_method", F.lit(cls), F.lit(method), *args)


def _latin1_rules():
    """Built by rule from Unicode data, for U+0000-U+00FF: the characters that
    NFKC leaves unchanged (none of them is a combining mark, so a text made
    only of them is NFKC already)."""
    import unicodedata

    stable = [chr(i) for i in range(0x100) if unicodedata.normalize("NFKC", chr(i)) == chr(i)]
    cls = "".join("\\x{%X}" % ord(ch) for ch in stable)
    return "[^" + cls + "]"


_NFKC_GATE = _latin1_rules()


def nfkc(c) -> Column:
    """Unicode NFKC (ICU4J).  A text made only of characters NFKC leaves
    unchanged (ASCII and most of Latin-1) skips the call."""

    def body(t):
        return F.when(F.regexp_like(t, F.lit(_NFKC_GATE)),
                      _java("com.ibm.icu.text.Normalizer", "compose", t, F.lit(True))).otherwise(t)

    return let(c, body)


def nfd(c) -> Column:
    """Unicode NFD (ICU4J); ASCII skips it."""

    def body(t):
        return F.when(F.regexp_like(t, F.lit("[^\\x00-\\x7F]")),
                      _java("com.ibm.icu.text.Normalizer", "decompose", t, F.lit(False))).otherwise(t)

    return let(c, body)


def strip_accents(c) -> Column:
    """NFD, then drop non-spacing marks; ASCII skips both."""

    def body(t):
        return F.when(F.regexp_like(t, F.lit("[^" + rx.singles("\0", "\x7f") + "]")),
                      F.regexp_replace(_java("com.ibm.icu.text.Normalizer", "decompose", t, F.lit(False)),
                                       "[[^" + rx.singles("\0", "\x7f") + "]&&\\p{Mn}]", "")).otherwise(t)

    return let(c, body)


def unescape_html(c) -> Column:
    """HTML 5 entities (with or without semicolon) and numeric character references
    -> characters, in the JVM.  Rows without ``&`` skip it."""
    from textmill.functions import entities

    return let(c, lambda t: F.when(F.instr(t, "&") > 0, entities.unescape(t)).otherwise(t))


def lowerize(c) -> Column:
    """D19."""
    return F.lower(_c(c))


def special_normalize(c) -> Column:
    """The special map, NFKC after every entry.

    NFKC is idempotent, so after the first (unconditional) pass a later entry
    needs a new NFKC pass only in rows where its replacement fired.
    """
    (k0, v0), rest = rx.SPECIAL_MAP[0], rx.SPECIAL_MAP[1:]
    t = nfkc(F.replace(_c(c), F.lit(k0), F.lit(v0)))
    def entry(k, v):
        return lambda x: F.when(F.instr(x, k) > 0, nfkc(F.replace(x, F.lit(k), F.lit(v)))).otherwise(x)

    for k, v in rest:
        t = let(t, entry(k, v))
    return t


# Moses punctuation normalisation rules for English, in order
# (regex, replacement), as published with the Moses scripts.
PUNCT_RULES = [
    # extra whitespace
    (r"\r", ""),
    (r"\(", " ("),
    (r"\)", ") "),
    (r" {2,}", " "),
    (r"\) ([.!:?;,])", ")$1"),
    (r"\( ", "("),
    (r" \)", ")"),
    (r"(\p{Nd}) %", "$1%"),
    (r" :", ":"),
    (r" ;", ";"),
    # backtick and doubled apostrophe
    (r"`", "'"),
    (r"''", ' " '),
    # unicode punctuation
    (r"„", '"'),
    (r"“", '"'),
    (r"”", '"'),
    (r"–", "-"),
    (r"—", " - "),
    (r" {2,}", " "),
    (r"´", "'"),
    (r"([a-zA-Z])‘([a-zA-Z])", "$1'$2"),
    (r"([a-zA-Z])’([a-zA-Z])", "$1'$2"),
    (r"‘", "'"),
    (r"‚", "'"),
    (r"’", "'"),
    (r"''", '"'),
    (r"´´", '"'),
    (r"…", "..."),
    # French quotes
    ("\u00a0«\u00a0", '"'),
    ("«\u00a0", '"'),
    ("«", '"'),
    ("\u00a0»\u00a0", '"'),
    ("\u00a0»", '"'),
    ("»", '"'),
    # pseudo spaces
    ("\u00a0%", "%"),
    ("nº\u00a0", "nº "),
    ("\u00a0:", ":"),
    ("\u00a0ºC", " ºC"),
    ("\u00a0cm", " cm"),
    ("\u00a0\\?", "?"),
    ("\u00a0\\!", "!"),
    ("\u00a0;", ";"),
    (",\u00a0", ", "),
    (r" {2,}", " "),
    # English: quotation followed by comma / period
    (r'"([,.]+)', '$1"'),
    # numbers
    ("(\\p{Nd})\u00a0(\\p{Nd})", "$1.$2"),
]


# Rule groups (slices of PUNCT_RULES) and a pattern that matches whenever any
# rule of the group could fire.  A group whose pattern does not match the
# current text is skipped: every rule in it would leave the text unchanged.
_NBSP = "\u00a0"
PUNCT_GROUPS = [
    (slice(0, 3), r"[\r()]"),
    (slice(3, 4), "  "),
    (slice(4, 10), "(?![" + rx.LETTERS + r"])(?:\) [.!:?;,]|\( | \)|\p{Nd} %| [:;])"),
    (slice(10, 12), r"`|''"),
    (slice(12, 27), "(?![" + rx.LETTERS + "])(?:[„“”–—´‘‚’…]|''|  )"),
    (slice(27, 33), "[«»]"),
    (slice(33, 43), _NBSP + "|  "),
    (slice(43, 44), r'"[,.]'),
    (slice(44, 45), _NBSP),
]


def moses_punct_normalize(c) -> Column:
    """Ordered punctuation rewrites, then strip.

    The 45 rewrites run in 9 ordered groups; a group runs only on texts where
    one of its rules can match, so plain text pays for a few scans, not 45.
    """
    def rules(sl):
        def apply(x):
            for pat, rep in PUNCT_RULES[sl]:
                x = F.regexp_replace(x, pat, rep)
            return x
        return apply

    def guarded(apply, guard):
        return lambda x: F.when(F.regexp_like(x, F.lit(guard)), apply(x)).otherwise(x)

    t = _c(c)
    for sl, guard in PUNCT_GROUPS:
        t = let(t, guarded(rules(sl), guard))
    return strip_ws(t)


# XML unescapes the Moses detokeniser applies first.
XML_UNESCAPES = [("&bar;", "|"), ("&lt;", "<"), ("&gt;", ">"), ("&bra;", "["), ("&ket;", "]"),
                 ("&quot;", '"'), ("&apos;", "'"), ("&#91;", "["), ("&#93;", "]"), ("&#124;", "|"), ("&amp;", "&")]
# The blocks whose characters the Moses detokeniser writes without spaces between.
CJK = (r"\x{1100}-\x{11FF}\x{2E80}-\x{A4CF}\x{A840}-\x{A87F}\x{AC00}-\x{D7AF}\x{F900}-\x{FAFF}"
       r"\x{FE30}-\x{FE4F}\x{FF65}-\x{FFDC}\x{20000}-\x{2FFFF}")

_RIGHT_SHIFT = r"^[\p{Sc}(\[{¿¡]+$"
_LEFT_SHIFT = r"^[,.?!:;\\%}\])]+$"
_CONTRACTION = r"^'\p{IsAlphabetic}"
_QUOTE = r"^['\"„“`]+$"
_DOUBLE_QUOTES = r"^[„“”]+$"


def ws_tokens(c) -> Column:
    """Python ``str.split()``: runs of whitespace separate, no empty tokens."""
    return F.filter(F.split(_c(c), rx.PY_WS + "+", -1), lambda t: t != "")


def detokenize(tokens) -> Column:
    """Moses detokenisation of a token list (English rules).

    Each token either takes a space before it or attaches to the previous one:
    closing punctuation and contractions attach left, currency signs and
    opening brackets attach right, and stand-alone quote tokens alternate
    opening / closing per quote kind (a lone ``'`` after a word ending in
    ``s`` attaches left as a possessive without counting).  A token that begins
    with a CJK character attaches to one that ends with such a character.
    """
    text = F.concat(F.lit(" "), F.array_join(_c(tokens), " "), F.lit(" "))
    text = F.replace(text, F.lit(" @-@ "), F.lit("-"))
    for k, v in XML_UNESCAPES:
        text = F.replace(text, F.lit(k), F.lit(v))

    def with_tokens(toks):
        n = F.size(toks)
        kinds = F.transform(toks, lambda t, i: F.when(F.regexp_like(t, F.lit(f"^[{CJK}]")), F.lit("K"))
                            .when(F.regexp_like(t, F.lit(_RIGHT_SHIFT)), F.lit("R"))
                            .when(F.regexp_like(t, F.lit(_LEFT_SHIFT)), F.lit("L"))
                            .when((i > 0) & F.regexp_like(t, F.lit(_CONTRACTION)), F.lit("C"))
                            .when(F.regexp_like(t, F.lit(_QUOTE)), F.lit("Q"))
                            .otherwise(F.lit("N")))

        def with_kinds(kd):
            idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
            return let(F.filter(idx, lambda i: F.element_at(kd, i + 1) == "Q"), lambda qidx: with_q(kd, qidx))

        def with_q(kd, qidx):
            # Quotes of one kind open and close in turn; "n" counts, "p" is a possessive, which
            # counts only where it closes.  Read from the left, "n" and whatever follows it are
            # a pair (0 opens, 1 closes), any other "p" stands alone (2).  The kinds are laid
            # out one after the other, so one regex scan decides all of them.
            def quote(i):
                tok = F.element_at(toks, i + 1)
                poss = (tok == "'") & (i > 0) & F.element_at(toks, F.greatest(i, F.lit(1))).endswith("s")
                return F.struct(F.when(F.regexp_like(tok, F.lit(_DOUBLE_QUOTES)), F.lit('"')).otherwise(tok).alias("key"),
                                i.alias("i"), F.when(poss, F.lit("p")).otherwise(F.lit("n")).alias("f"))

            def decide(qs):
                flags = F.array_join(F.transform(qs, lambda q, j: F.when(
                    (j > 0) & (q["key"] != F.element_at(qs, F.greatest(j, F.lit(1)))["key"]), F.concat(F.lit("|"), q["f"])).otherwise(q["f"])), "")
                decided = F.translate(F.regexp_replace(flags, "n[np]", "01"), "np|", "02")
                by_place = F.array_sort(F.zip_with(qs, F.split(decided, ""), lambda q, x: F.struct(q["i"].alias("i"), x.try_cast("int").alias("d"))))
                return F.transform(F.filter(by_place, lambda x: x["i"].isNotNull()), lambda x: x["d"])

            dec = let(F.array_sort(F.transform(qidx, quote)), decide)
            # rank of each quote token among the quote tokens (1-based), O(n)
            qrank = prefix_sums(F.transform(kd, lambda k: F.when(k == "Q", F.lit(1)).otherwise(F.lit(0))))

            def body(d, r):
                def qd(i):
                    return F.try_element_at(d, F.greatest(F.element_at(r, i + 1), F.lit(1)))

                def opens(i):  # token i leaves no space after it
                    k = F.element_at(kd, i + 1)
                    return (k == "R") | ((k == "Q") & (qd(i) == 0))

                def attaches_left(i):
                    k = F.element_at(kd, i + 1)
                    after_cjk = F.regexp_like(F.element_at(toks, F.greatest(i, F.lit(1))), F.lit(f"[{CJK}]$"))
                    return (k == "L") | (k == "C") | ((k == "Q") & (qd(i) != 0)) | ((k == "K") & after_cjk)

                pieces = F.transform(toks, lambda t, i: F.when(
                    (i > 0) & ~attaches_left(i) & ~opens(F.greatest(i - 1, F.lit(0))), F.concat(F.lit(" "), t))
                    .otherwise(t))
                return F.array_join(pieces, "")

            return let(dec, lambda d: let(qrank, lambda r: body(d, r)))

        return let(kinds, with_kinds)

    out = let(ws_tokens(text), with_tokens)
    return strip_ws(F.regexp_replace(out, " {2,}", " "))


# A token that is not plain for the detokeniser: right- or left-shifting
# punctuation, a contraction, or a stand-alone quote; or text the detokeniser
# rewrites before splitting (XML entities, ``@-@``).
_WS = rx.PY_WS
_SHIFTED = "(?:[\\p{Sc}(\\[{¿¡]+|[,.?!:;\\\\%}\\])]+|['\"„“`]+)(?=" + _WS + "|$)"
_OTHER = rx.singles("!", "%") + rx.singles("'", "?") + rx.singles("A", "~")
# But at the start, all forms begin with whitespace, ``&``, ``@`` or a CJK character: other characters are passed by, and
# so is whitespace before a letter or digit.
_SPECIAL_TOKEN = ("^" + _SHIFTED + "|(?=[^" + _OTHER + "])(?:[[ \\t\\n]" + _WS + "](?![" + rx.LETTERS + rx.DIGITS + "])(?:" + _SHIFTED +
                  "|'\\p{IsAlphabetic})|&|@-@|[[^ " + _OTHER + "]&&[" + CJK + "]]" + _WS + "+[" + CJK + "])")


def fix_tokenized(c) -> Column:
    """Split on any whitespace and detokenise (newlines vanish).

    Text whose tokens are all plain words comes out as its tokens joined by
    single spaces; only text with a special token runs the full detokeniser.
    """

    def body(t):
        plain = F.array_join(ws_tokens(t), " ")
        return F.when(F.regexp_like(t, F.lit(_SPECIAL_TOKEN)), detokenize(ws_tokens(t))).otherwise(plain)

    return let(c, body)


def normalize_text(c) -> Column:
    """The default chain special map + NFKC -> punctuation -> fix_tokenized."""
    return fix_tokenized(moses_punct_normalize(special_normalize(c)))


# Moses tokeniser (D22) rules for English, as published with the Moses scripts;
# the word-final period is handled between the two lists.
TOKENIZE_RULES = [
    (r"(?U)\s+", " "),
    (r"[\x00-\x1f]", ""),
    (r"([^\p{IsAlphabetic}\p{N}\s\.'`,\-])", " $1 "),
    (r"(\.{2,})", " $1 "),
    (r"([^\p{N}]),", "$1 , "),
    (r",([^\p{N}])", " , $1"),
    (r"(\p{N}),$", "$1 ,"),
    (r"([^\p{IsAlphabetic}])'([^\p{IsAlphabetic}])", "$1 ' $2"),
    (r"([^\p{IsAlphabetic}\p{N}])'(\p{IsAlphabetic})", "$1 ' $2"),
    (r"(\p{IsAlphabetic})'([^\p{IsAlphabetic}])", "$1 ' $2"),
    (r"(\p{IsAlphabetic})'(\p{IsAlphabetic})", "$1 '$2"),
    (r"(\p{N})'(s)", "$1 '$2"),
]
ESCAPE_RULES = [
    (r"&", "&amp;"),
    (r"\|", "&#124;"),
    (r"<", "&lt;"),
    (r">", "&gt;"),
    (r"'", "&apos;"),
    (r"\"", "&quot;"),
    (r"\[", "&#91;"),
    (r"\]", "&#93;"),
]
# English words whose final period is no sentence end (single capitals are added by
# rule), and those for which that holds only before a number.
PERIOD_WORDS = [
    "Adj", "Adm", "Adv", "Asst", "Bart", "Bldg", "Brig", "Bros", "Capt", "Cmdr", "Col", "Comdr", "Con", "Corp", "Cpl", "DR", "Dr", "Drs",
    "Ens", "Gen", "Gov", "Hon", "Hr", "Hosp", "Insp", "Lt", "MM", "MR", "MRS", "MS", "Maj", "Messrs", "Mlle", "Mme", "Mr", "Mrs", "Ms",
    "Msgr", "Op", "Ord", "Pfc", "Ph", "Prof", "Pvt", "Rep", "Reps", "Res", "Rev", "Rt", "Sen", "Sens", "Sfc", "Sgt", "Sr", "St", "Supt",
    "Surg", "v", "vs", "i.e", "rev", "e.g", "Nos", "Nr",
]
NUMBER_WORDS = ["No", "Art", "pp"]


def _split_period(t, following) -> Column:
    """A word-final period becomes a token unless the word is an abbreviation (it holds another
    period and a letter, is listed, or a lower-case word follows)."""
    pre = F.regexp_extract(t, r"^(\S+)\.$", 1)
    kept = ((F.instr(pre, ".") > 0) & F.regexp_like(pre, F.lit(r"\p{IsAlphabetic}"))) | F.regexp_like(pre, F.lit("^[A-Z]$")) \
        | pre.isin(*PERIOD_WORDS) | F.regexp_like(following, F.lit(r"^\p{IsLowercase}")) \
        | (pre.isin(*NUMBER_WORDS) & F.regexp_like(following, F.lit("^[0-9]")))
    return F.when((pre == "") | F.regexp_like(t, F.lit(r"^\.+$")) | kept, t).otherwise(F.concat(pre, F.lit(" .")))


def moses_tokenize(c) -> Column:
    """``ARRAY<STRING>`` Moses tokens (English)."""
    t = strip_ws(_c(c))
    for pat, rep in TOKENIZE_RULES:
        t = F.regexp_replace(t, pat, rep)
    words = F.filter(F.split(t, " +", -1), lambda x: x != "")
    t = let(words, lambda w: F.array_join(F.transform(w, lambda x, i: _split_period(x, F.coalesce(F.get(w, i + 1), F.lit("")))), " "))
    t = F.regexp_replace(t, r"\.' ?$", " . ' ")
    for pat, rep in ESCAPE_RULES:
        t = F.regexp_replace(t, pat, rep)
    return F.filter(F.split(t, " +", -1), lambda x: x != "")
