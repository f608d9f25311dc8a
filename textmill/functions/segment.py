"""Array / segmentation column expressions.

Paragraph lists stay ``ARRAY<STRING>`` columns; nothing is exploded until the
job needs rows.  Everything here runs in time linear (or n log n) in the text:
running offsets use doubling prefix sums, windows one regex scan, and the
sentence packer cuts segments from UTF-8 byte offsets.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions import rx
from textmill.functions.text import _c, let, strip_ws


def split_keep_empty(c, pattern: str) -> Column:
    """Python ``re.split`` semantics: leading/trailing empty pieces kept."""
    return F.split(_c(c), pattern, -1)


def split_chapters_books(c) -> Column:
    """Chapters separated by three or more newlines."""
    return split_keep_empty(c, rx.CHAPTER_SPLIT_BOOKS)


def split_chapters_web(c) -> Column:
    """Chapters separated by two or more newlines."""
    return split_keep_empty(c, rx.CHAPTER_SPLIT_WEB)


def split_chapters_pg(c) -> Column:
    """Chapters separated by three newlines or five spaced asterisks."""
    return split_keep_empty(c, rx.CHAPTER_SPLIT_PG)


def split_lines(c) -> Column:
    """Lines."""
    return split_keep_empty(c, rx.LINE_SPLIT)


def prefix_sums(arr, block: int = 128) -> Column:
    """Inclusive running sums of an int array without a quadratic fold: block
    totals, their running offsets (a fold over n/block values), then each
    element adds the sum of its own block prefix (at most ``block`` values)."""

    def body(a):
        n = F.size(a)
        nb = F.ceil(n / F.lit(block)).cast("int")
        blocks = F.when(nb > 0, F.sequence(F.lit(0), nb - 1)).otherwise(F.array().cast("array<int>"))
        tot = F.transform(blocks, lambda j: F.aggregate(F.slice(a, j * block + 1, F.lit(block)), F.lit(0),
                                                        lambda x, y: x + y))
        offs = F.aggregate(tot, F.struct(F.array().cast("array<int>").alias("o"), F.lit(0).alias("s")),
                           lambda acc, x: F.struct(F.concat(acc["o"], F.array(acc["s"])).alias("o"),
                                                   (acc["s"] + x).alias("s")))["o"]

        def with_offs(o):
            def elem(x, i):
                j = F.floor(i / F.lit(block)).cast("int")
                within = F.aggregate(F.slice(a, j * block + 1, i - j * block + 1), F.lit(0), lambda u, v: u + v)
                return F.element_at(o, j + 1) + within

            return F.transform(a, elem)

        return let(offs, with_offs)

    return let(arr, body)


def sentence_boundaries(c) -> Column:
    """End offsets (0-based, exclusive) of every sentence boundary, ascending."""
    pieces = split_keep_empty(c, rx.SENTENCE_BOUNDARY)
    return prefix_sums(F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda x: F.length(x)))


PACK_BLOCK = 256


def _pack_linear(text, m: int, carry: bool = False) -> Column:
    """The default packer in time linear in the text (see ``sentence_pack``).

    One fold over the sentence pieces keeps running (char, byte) offsets.  A
    run of hard cuts always advances by exactly ``m`` chars from the last
    boundary cut, so the fold records spans ``(byte start, byte end, h)``
    between boundary cuts, ``h`` being the number of hard cuts inside.  Each
    span is then decoded once from the UTF-8 bytes (a byte offset costs O(1);
    a character offset into a string costs a scan from its start) and cut by
    one regex scan into ``h`` chunks of ``m`` chars plus the rest.  The fold
    runs in blocks of pieces so that growing the span list stays linear too.
    """
    mm = F.lit(m)
    runs = F.lit("(?s).{1," + str(m) + "}")
    null_int = F.lit(None).cast("int")

    def st(off, boff, a, ba, h, last, blast, spans):
        return F.struct(off.alias("off"), boff.alias("boff"), a.alias("a"), ba.alias("ba"), h.alias("h"),
                        last.alias("last"), blast.alias("blast"), spans.alias("spans"))

    def body(t):
        pieces = split_keep_empty(t, rx.SENTENCE_BOUNDARY)
        lens = F.transform(F.slice(pieces, 1, F.size(pieces) - 1),
                           lambda p: F.struct(F.length(p).alias("n"), F.octet_length(p).alias("nb")))
        init = st(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), null_int, null_int,
                  F.array().cast("array<struct<b0:int,b1:int,h:int>>"))

        def span(acc):
            return F.array(F.struct(acc["ba"].alias("b0"), acc["blast"].alias("b1"), acc["h"].alias("h")))

        def step(acc, z):
            b, bb = acc["off"] + z["n"], acc["boff"] + z["nb"]
            pos = acc["a"] + acc["h"] * mm
            keep = st(b, bb, acc["a"], acc["ba"], acc["h"], b, bb, acc["spans"])
            if not carry:
                # The boundary that does not fit is used up.
                at_last = st(b, bb, acc["last"], acc["blast"], F.lit(0), null_int, null_int,
                             F.concat(acc["spans"], span(acc)))
                hard = st(b, bb, acc["a"], acc["ba"], acc["h"] + 1, null_int, null_int, acc["spans"])
                return F.when(b - pos < mm, keep).when(acc["last"].isNotNull(), at_last).otherwise(hard)
            # carry: cut, add hard cuts until the boundary is in reach, then take it.
            has_last = acc["last"].isNotNull()
            a1 = F.when(has_last, acc["last"]).otherwise(acc["a"])
            ba1 = F.when(has_last, acc["blast"]).otherwise(acc["ba"])
            h1 = F.when(has_last, F.lit(0)).otherwise(acc["h"] + 1)
            spans1 = F.when(has_last, F.concat(acc["spans"], span(acc))).otherwise(acc["spans"])
            h2 = h1 + F.floor((b - (a1 + h1 * mm)) / mm).cast("int")
            takes = b > a1 + h2 * mm
            closed = st(b, bb, a1, ba1, h2, F.when(takes, b).otherwise(null_int),
                        F.when(takes, bb).otherwise(null_int), spans1)
            return F.when(b - pos < mm, keep).otherwise(closed)

        no_spans = F.array().cast("array<struct<b0:int,b1:int,h:int>>")

        def blocked(L):
            # The fold runs block by block (PACK_BLOCK pieces each): a block
            # collects its own spans, so appends copy at most a block's worth.
            nblk = F.ceil(F.size(L) / F.lit(PACK_BLOCK)).cast("int")
            blocks = F.when(nblk > 0, F.sequence(F.lit(0), nblk - 1)).otherwise(F.array().cast("array<int>"))

            def outer(acc, j):
                s0 = acc["s"]
                start = st(s0["off"], s0["boff"], s0["a"], s0["ba"], s0["h"], s0["last"], s0["blast"], no_spans)
                inner = F.aggregate(F.slice(L, j * PACK_BLOCK + 1, F.lit(PACK_BLOCK)), start, step)
                return let(inner, lambda r: F.struct(r.alias("s"), F.concat(acc["all"], F.array(r["spans"])).alias("all")))

            def finish(acc):
                s0, spans = acc["s"], F.flatten(acc["all"])
                spans = F.when(s0["last"].isNotNull(), F.concat(spans, span(s0))).otherwise(spans)
                return F.struct(spans.alias("spans"), F.coalesce(s0["blast"], s0["ba"]).alias("ba"))

            init_o = F.struct(init.alias("s"), F.array().cast("array<array<struct<b0:int,b1:int,h:int>>>").alias("all"))
            return F.aggregate(blocks, init_o, outer, finish)

        res = let(lens, blocked)

        def with_bin(bin_):
            def with_res(r):
                def cut_span(sp):
                    region = F.decode(F.substring(bin_, sp["b0"] + 1, sp["b1"] - sp["b0"]), "UTF-8")
                    return let(F.regexp_extract_all(region, runs, 0), lambda ch: F.concat(
                        F.slice(ch, 1, sp["h"]),
                        F.array(F.array_join(F.slice(ch, sp["h"] + 1, F.greatest(F.size(ch) - sp["h"], F.lit(0))),
                                             ""))))

                main = F.flatten(F.transform(r["spans"], cut_span))
                rest = F.decode(F.substring(bin_, r["ba"] + 1, F.lit(2**31 - 1)), "UTF-8")
                return F.transform(F.concat(main, F.regexp_extract_all(rest, runs, 0)), strip_ws)

            return let(res, with_res)

        return let(F.encode(t, "UTF-8"), with_bin)

    return let(text, body)


def sentence_pack(c, max_len: int, carry_boundary: bool = False) -> Column:
    """Greedy sentence packing into segments of fewer than ``max_len`` chars.

    A segment grows while the next boundary ends less than ``max_len`` chars
    after the segment start; with no boundary in reach it is cut hard at
    ``max_len``.  By default the boundary that did not fit is lost (the next
    segment may then be cut hard mid-sentence), as in the reference;
    ``carry_boundary=True`` keeps it for the next segment.  Segments are
    whitespace-stripped.  Both forms run in time linear in the text.
    """
    return _pack_linear(c, max_len, carry_boundary)


def pack_paragraphs(paras, max_len: int, carry_boundary: bool = False) -> Column:
    """Every paragraph packed, flattened to one list."""
    return F.flatten(F.transform(_c(paras), lambda p: sentence_pack(p, max_len, carry_boundary)))


def char_windows(c, width: int) -> Column:
    """Consecutive windows of ``width`` chars; the last one may be short.
    One regex scan (linear; a substring per window would rescan the text)."""
    return F.regexp_extract_all(_c(c), F.lit("(?s).{1," + str(width) + "}"), 0)


def join_lines(arr) -> Column:
    """Join paragraphs with a newline."""
    return F.array_join(_c(arr), "\n")
