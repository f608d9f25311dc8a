"""Text-scrubbing column expressions (all JVM-side, no Python per row).

Each function maps a string ``Column`` to a string ``Column`` and can be
composed freely; the cleaner profiles in ``textmill.operators.profiles`` chain
them in the order each source needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions import rx


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_indent(c) -> Column:
    """Remove leading spaces (U+0020 only) of every line."""
    return F.regexp_replace(_c(c), rx.LEADING_SPACES, "")


def fix_mojibake(c) -> Column:
    """UTF-8 punctuation read as Latin-1 -> apostrophe; ``Ã©`` -> ``é``."""
    out = F.regexp_replace(_c(c), rx.MOJIBAKE_QUOTE, "'")
    return F.replace(out, F.lit(rx.MOJIBAKE_EACUTE[0]), F.lit(rx.MOJIBAKE_EACUTE[1]))


def unwrap_italics(c) -> Column:
    """D3: ``_x_`` -> `` x `` (lazy, within a line)."""
    return F.regexp_replace(_c(c), rx.ITALICS, " $1 ")


def unwrap_brackets(c) -> Column:
    """``[x]`` -> `` x `` (lazy, within a line)."""
    return F.regexp_replace(_c(c), rx.BRACKETS, " $1 ")


def blockquote_to_space(c) -> Column:
    """A ``>`` at line start becomes a space."""
    return F.regexp_replace(_c(c), rx.BLOCKQUOTE, " ")


def drop_md_headers(c) -> Column:
    """Markdown header lines of at most 100 chars after the hashes -> empty."""
    return F.regexp_replace(_c(c), rx.MD_HEADER_LINE, "")


def drop_bold_lines(c) -> Column:
    """Lines opening with a ``**...**`` heading -> empty."""
    return F.regexp_replace(_c(c), rx.BOLD_LINE, "")


def drop_chapter_lines(c) -> Column:
    """Lines starting with Chapter/chapter/CHAPTER plus 1-100 chars -> empty."""
    return F.regexp_replace(_c(c), rx.CHAPTER_LINE, "")


def bold_markers_to_space(c) -> Column:
    """Every ``**`` -> one space."""
    return F.replace(_c(c), F.lit("**"), F.lit(" "))


def scrub_urls(c) -> Column:
    """URLs, bare domains and e-mail addresses -> one space."""
    # Both forms hold a point before a domain's last part; other texts skip the costly scan.
    return let(c, lambda t: F.when(F.regexp_like(t, F.lit(rx.URL_GATE)), F.regexp_replace(t, rx.URL, " ")).otherwise(t))


def drop_illustrations_books(c) -> Column:
    """A line opening with ``[`` through a ``]`` up to 10 lines later -> space."""
    return F.regexp_replace(_c(c), rx.ILLUSTRATION_BOOKS, " ")


def drop_illustrations_pg(c) -> Column:
    """Any ``[`` through the last ``]`` within 10 more lines -> removed."""
    return F.regexp_replace(_c(c), rx.ILLUSTRATION_PG, "")


def let(value, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Expressions referenced several times inside higher-order functions (or
    inside one ``CASE``) are not shared by Spark; binding them through a
    one-element ``transform`` is.
    """
    return F.element_at(F.transform(F.array(_c(value)), body), 1)


def cut_license(c) -> Column:
    """Truncate before the newline that opens the first end-of-book licence line."""
    return F.regexp_replace(_c(c), rx.END_LICENSE + r"(?s:.*)\z", "")


def header_match_end(c) -> Column:
    """Length of the prefix up to the end of the first Gutenberg header match (0 if none)."""
    return F.length(F.regexp_extract(_c(c), rx.HEADER_PREFIX, 0))


def strip_headers(c) -> Column:
    """Strip the header block, again and again while a match ends before 10 000.

    Runs as one ``aggregate``: odd steps find the end of the first match, even
    steps cut, so each regex search runs once per round, and a text without a
    header stops after one search.  Every strip consumes a distinct blank-line
    separator (a match ends with two newlines), so the number of separators in
    the text bounds the rounds exactly; finished rows skip the rest in O(1).
    """
    limit = rx.GUTENBERG_HEADER_LIMIT

    def body(t):
        n_sep = ((F.length(t) - F.length(F.replace(t, F.lit("\n\n"), F.lit("")))) / 2).cast("int")
        init = F.struct(t.alias("t"), F.lit(0).alias("e"), F.lit(False).alias("done"))

        def step(acc, i):
            find = F.struct(acc["t"].alias("t"), header_match_end(acc["t"]).alias("e"),
                            F.lit(False).alias("done"))
            hit = (acc["e"] > 0) & (acc["e"] < limit)
            cut = F.when(hit, F.struct(acc["t"].substr(acc["e"] + 1, F.lit(2**31 - 1)).alias("t"),
                                       F.lit(0).alias("e"), F.lit(False).alias("done"))) \
                   .otherwise(F.struct(acc["t"].alias("t"), F.lit(0).alias("e"), F.lit(True).alias("done")))
            return F.when(acc["done"], acc).when(i % 2 == 1, find).otherwise(cut)

        return F.aggregate(F.sequence(F.lit(1), n_sep * 2 + 1), init, step)["t"]

    return let(c, body)


def collapse_spaces(c) -> Column:
    """Runs of spaces -> one space."""
    return F.regexp_replace(_c(c), rx.SPACE_RUN, " ")


def strip_ws(c) -> Column:
    """Python ``str.strip()``: all Unicode whitespace at both ends."""
    return F.btrim(_c(c), F.lit(rx.PY_WS_CHARS))


def drop_bold_runs(c) -> Column:
    """Runs of two or more bold-heading lines (blank lines between allowed)."""
    return F.regexp_replace(_c(c), rx.BOLD_RUN, "")


def drop_numbered_runs(c) -> Column:
    """Runs of three or more lines that start with a digit (<= 101 chars)."""
    return F.regexp_replace(_c(c), rx.NUMBERED_RUN, "")


def drop_short_line_runs(c) -> Column:
    """Runs of ten or more lines of at most 20 chars -> one newline."""
    return F.regexp_replace(_c(c), rx.SHORT_LINE_RUN, "\n")


def drop_contents_runs(c) -> Column:
    """D17d: runs of three or more table-of-contents lines."""
    return F.regexp_replace(_c(c), rx.CONTENTS_RUN, "")


def is_upper(c) -> Column:
    """Python ``str.isupper()``: has an upper-case character, and none of lower or title case
    (by Unicode property: the ordinal indicators count as lower case)."""
    c = _c(c)
    return F.regexp_like(c, F.lit(r"\p{IsUppercase}")) & ~F.regexp_like(c, F.lit(r"[\p{IsLowercase}\p{Lt}]"))


def has_non_space(c) -> Column:
    """Python ``bool(s.strip())``."""
    return F.regexp_like(_c(c), F.lit("[^" + rx.PY_WS[1:-1] + "]"))


_ASCII_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def paragraph_ok(c) -> Column:
    """ASCII letters > len/3, no keyword, and longer than 5 chars."""
    c = _c(c)
    n = F.length(c)
    letters = n - F.length(F.translate(c, _ASCII_LETTERS, ""))
    no_kw = ~reduce(lambda a, b: a | b, [F.instr(c, k) > 0 for k in rx.PARAGRAPH_KEYWORDS])
    return (n > 5) & (letters * 3 > n) & no_kw


def starts_with_any(c, prefixes) -> Column:
    c = _c(c)
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes])


def md5_hex(c) -> Column:
    """md5 of the UTF-8 bytes, lower-case hex."""
    return F.md5(_c(c))
