"""Per-source cleaner profiles (E13-E16), the source registry (U1-U2) and the
per-row dispatch (C14).

A cleaner maps a raw-text ``Column`` to an ``ARRAY<STRING>`` column of cleaned
paragraphs.  Users may register their own cleaner (a ``Column -> Column``
function, or a plain Python ``str -> list[str]`` callable that is wrapped in an
Arrow UDF).
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions import rx
from textmill.functions import text as tx
from textmill.functions.segment import split_chapters_books, split_chapters_pg, split_chapters_web, split_lines


def _chapters_to_paragraphs(chapters: Column, strip_after_collapse: bool) -> Column:
    """Shared tail of the books3 and webcrawl cleaners."""
    chapters = F.filter(chapters, lambda ch: F.length(ch) > 5)

    def clean(ch):
        kept = F.filter(split_lines(ch), tx.paragraph_ok)
        joined = tx.strip_ws(tx.strip_indent(F.array_join(kept, "\n")))
        out = tx.strip_indent(tx.collapse_spaces(joined))
        return tx.strip_ws(out) if strip_after_collapse else out

    return F.transform(chapters, clean)


# Books3 steps and whether a step can put a space at the start of a line.
# Every step is followed by D1 (leading spaces of lines removed); after a step
# that cannot create a line-leading space D1 would find nothing to do, so it
# is skipped there (only whole lines or non-space characters change).
_BOOKS3_STEPS = [
    (tx.drop_bold_runs, True),  # the first D1 also clears the input's own indents
    (tx.drop_numbered_runs, False),
    (tx.drop_short_line_runs, False),
    (tx.fix_mojibake, False),
    (tx.unwrap_italics, True),
    (tx.unwrap_brackets, True),
    (tx.drop_illustrations_books, True),
    (tx.blockquote_to_space, True),
    (tx.drop_md_headers, False),
    (tx.drop_bold_lines, False),
    (tx.drop_chapter_lines, False),
    (tx.bold_markers_to_space, True),
]


def clean_books3(c) -> Column:
    """Books3 cleaner."""
    b = tx._c(c)
    for f, may_indent in _BOOKS3_STEPS:
        b = tx.strip_indent(f(b)) if may_indent else f(b)
    return _chapters_to_paragraphs(split_chapters_books(b), strip_after_collapse=True)


def clean_webcrawl(c) -> Column:
    """OpenWebText2 / Pile-CC cleaner (no final strip: may keep empty strings)."""
    t = tx._c(c)
    for f in (tx.unwrap_italics, tx.unwrap_brackets, tx.blockquote_to_space, tx.bold_markers_to_space,
              tx.scrub_urls):
        t = tx.strip_indent(f(t))
    return _chapters_to_paragraphs(split_chapters_web(t), strip_after_collapse=False)


def clean_wiki(c) -> Column:
    """Webcrawl cleaner, then drop back-matter paragraphs."""
    return F.filter(clean_webcrawl(c), lambda p: ~tx.starts_with_any(p, rx.WIKI_BACKMATTER_PREFIXES))


def clean_gutenberg(c) -> Column:
    """Project Gutenberg cleaner."""
    b = tx.fix_mojibake(tx._c(c))
    b = tx.drop_illustrations_pg(b)
    for f in (tx.unwrap_italics, tx.unwrap_brackets, tx.blockquote_to_space):
        b = tx.strip_indent(f(b))
    b = tx.strip_headers(tx.cut_license(b))

    def chapter(ch):
        # C12 + D16: drop blank and all-upper-case lines; the unwrap is a no-op
        # on single lines, only its strip acts.
        lines = F.filter(split_lines(ch), lambda p: tx.has_non_space(p) & ~tx.is_upper(p))
        joined = tx.strip_ws(tx.strip_indent(F.array_join(F.transform(lines, tx.strip_ws), "\n")))
        return tx.strip_indent(tx.drop_contents_runs(joined))

    chapters = F.transform(split_chapters_pg(b), chapter)
    chapters = F.filter(chapters, tx.paragraph_ok)
    return F.transform(chapters, lambda ch: tx.strip_ws(tx.strip_indent(tx.collapse_spaces(ch))))


# ---------------------------------------------------------------------------
# Registry (U2) and dispatch (C14)
# ---------------------------------------------------------------------------

_PROFILES: dict[str, Callable[[Column], Column]] = {
    "books3": clean_books3,
    "gutenberg": clean_gutenberg,
    "webcrawl": clean_webcrawl,
    "wiki": clean_wiki,
}
_SUBSETS: dict[str, str] = dict(rx.SUBSET_PROFILES)


def register_profile(name: str, fn: Callable, subsets: list[str] | None = None, python: bool = False) -> None:
    """Add a cleaner and map source names to it.

    ``fn`` is a ``Column -> Column`` function, or with ``python=True`` a plain
    ``str -> list[str]`` callable, run batch-wise in an Arrow UDF.
    """
    if python:
        pyfn = fn

        @F.pandas_udf(T.ArrayType(T.StringType()))
        def _wrapped(s: pd.Series) -> pd.Series:
            return s.map(lambda v: None if v is None else list(pyfn(v)))

        fn = lambda c: _wrapped(tx._c(c))
    _PROFILES[name] = fn
    for s in subsets or []:
        _SUBSETS[s] = name


def profiles() -> dict[str, str]:
    return dict(_SUBSETS)


def validate_subsets(subsets: list[str]) -> None:
    """C1 validation: an unknown source name is an error on the driver."""
    for s in subsets:
        if s not in _SUBSETS:
            raise ValueError(f"Subset {s} not supported")


def clean_by_subset(text, subset, subsets: list[str] | None = None) -> Column:
    """C14: pick the cleaner from the row's source name (NULL for other sources).

    Only the branch a row selects is evaluated, so each row pays for one cleaner.
    """
    names = subsets if subsets is not None else list(_SUBSETS)
    validate_subsets(names)
    subset = tx._c(subset)
    by_profile: dict[str, list[str]] = {}
    for s in names:
        by_profile.setdefault(_SUBSETS[s], []).append(s)
    out = None
    for prof, members in by_profile.items():
        branch = _PROFILES[prof](text)
        cond = subset.isin(*members)
        out = F.when(cond, branch) if out is None else out.when(cond, branch)
    return out
