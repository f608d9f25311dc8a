"""Regular expressions for the text operators, in Java regex syntax.


* ``(?d)`` (UNIX_LINES) everywhere ``.``, ``^`` or ``$`` appear, so that only
  ``\\n`` ends a line, as in Python.
* ``(?m)`` where the behaviour being matched is a per-line anchor.
* Repeated line groups are written possessive (``{n,}+``, ``++``) so that a run
  of 100 000 lines does not overflow the JVM stack.  Every repetition in those
  groups consumes exactly one whole line, so giving back characters can never
  make a match succeed that a backtracking engine would find; the possessive
  form matches the same text.
"""

# ---------------------------------------------------------------------------
# These must equal the reference behaviour for equal results.
# ---------------------------------------------------------------------------

# Paragraph keywords that reject a paragraph (or a whole Gutenberg chapter).
PARAGRAPH_KEYWORDS = [
    "Transcriber's Note",
    "CONTENTS",
    "Copyright",
    "copyright",
    "ISBN",
    "EBOOK",
    "©",
]

# Wikipedia back-matter paragraph prefixes.
WIKI_BACKMATTER_PREFIXES = ["See also", "References", "External links", "Category", "Bibliography"]

# Subset (pile_set_name) -> cleaner profile.
SUBSET_PROFILES = {
    "Books3": "books3",
    "Gutenberg (PG-19)": "gutenberg",
    "OpenWebText2": "webcrawl",
    "Pile-CC": "webcrawl",
    "Wikipedia (en)": "wiki",
}

# Mojibake: UTF-8 punctuation decoded as Latin-1.  U+00E2 U+0080 followed by one
# of the listed C1 characters becomes an apostrophe; U+00C3 U+00A9 becomes e-acute.
MOJIBAKE_QUOTE = "â\u0080[\u0094\u0099\u009c\u009d\u0098\u008a¦]"
MOJIBAKE_EACUTE = ("Ã©", "é")

# Header phrases whose paragraph (plus up to three lines) opens a Gutenberg book.
GUTENBERG_HEADER_PHRASES = [
    r"\*\*\*.*START OF.*\*\*\*",
    r"Produced by.*",
    r"This etext was produced.*",
    r"E\-text prepared by .*",
    r".*Transcribed from.*",
    r".*Project Gutenberg's Etext of.*",
]
# A header match must end before this offset to be stripped.
GUTENBERG_HEADER_LIMIT = 10000

# Lines that mark the licence at the end of a Gutenberg book.
GUTENBERG_END_MARKERS = [
    r"\*\*\*.*END OF.*\*\*\*",
    r"End.*Project Guten.*",
    r"\*THE END.\*",
]

# Special normalisation map, applied in this order, NFKC after every entry.
SPECIAL_MAP = [
    ("¨", '"'),
    ("\u200b", " "),  # zero-width space
    ("’", "'"),
    ("♪", " "),
    ("♫", " "),
    ("●", "-"),
    ("&lrm;", ""),
    ("&rlm;", ""),
]

# ---------------------------------------------------------------------------
# The reference's cleaning patterns, re-typed in Java syntax
# (UNIX_LINES flags, non-capturing groups, possessive line runs; see above).
# ---------------------------------------------------------------------------

LEADING_SPACES = r"(?md)^ +"
ITALICS = r"(?d)_(.*?)_"
BRACKETS = r"(?d)\[(.*?)\]"
BLOCKQUOTE = r"(?md)^>"
MD_HEADER_LINE = r"(?md)^#{1,6}.{1,100}$"
BOLD_LINE = r"(?md)^\*\*.{1,100}\*\*.{0,100}$"
CHAPTER_LINE = r"(?md)^(?:[Cc]hapter|CHAPTER).{1,100}$"
BOLD_MARKER = r"\*\*"
# Bare domains / e-mails, or http(s) URLs; tld of 1-6 alnum or parenthesis chars.
URL = (
    r"(?U)[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b(?:[-a-zA-Z0-9()@:%_\+.~#?&/=]*)"
    r"|https?://(?:www\.)?[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b(?:[-a-zA-Z0-9()@:%_\+.~#?&/=]*)"
)
URL_GATE = r"\.[a-zA-Z0-9()]"
ILLUSTRATION_BOOKS = r"(?md)^\[.*(?:\n.*){0,10}\]"
ILLUSTRATION_PG = r"(?d)\[.*(?:\n.*){0,10}\]"
END_LICENSE = r"(?d)\n.*(?:" + "|".join(GUTENBERG_END_MARKERS) + ")"
# Leftmost header match from the start of the text, whose start lies within the
# limit.  The two phrases that open with ``.*`` are anchored at a line start: a
# match found at any later offset of that line would also be found there first.
HEADER_PREFIX = (
    r"(?d)\A(?s:.{0," + str(GUTENBERG_HEADER_LIMIT - 1) + r"}?)(?:"
    + "|".join(p if not p.startswith(".*") else "(?m:^)" + p for p in GUTENBERG_HEADER_PHRASES)
    + r")(?:\n.*){0,3}\n\n"
)
SPACE_RUN = r" {2,}"

# Python str.isspace() characters.
PY_WS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
PY_WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def singles(first: str, last: str) -> str:
    """The characters of a range one by one: Java looks those below U+0100 up in one table, ranges one after another."""
    return "".join("\\x%02X" % k for k in range(ord(first), ord(last) + 1))


LETTERS, DIGITS = singles("A", "Z") + singles("a", "z"), singles("0", "9")

# Runs of list-like lines (possessive; see module doc).
BOLD_RUN = r"(?md)(?:^\*\*.{1,100}\*\*.{0,100}\n++){2,}+"
NUMBERED_RUN = r"(?mdU)(?:^\d.{0,100}+\n++){3,}+"
SHORT_LINE_RUN = r"(?md)(?:^.{0,20}+\n){10,}+"
CONTENTS_RUN = r"(?mdU)(?:^(?:[Cc]hapter|CHAPTER)*+ *+[\dIVX]++.{0,200}+\n++){3,}+"

# Chapter / paragraph separators.
CHAPTER_SPLIT_BOOKS = r"\n\n\n+"
CHAPTER_SPLIT_WEB = r"\n\n+"
CHAPTER_SPLIT_PG = r"\n\n\n+|(?:\* *){5}"
LINE_SPLIT = r"\n"

# Sentence boundary: after ``."``, ``.)``, ``.``, ``?`` or ``!`` unless the next
# character is ``)``, ``'``, ``"`` or ``.`` (zero-width, for ``split``).  The first
# look-behind rejects most places by one character.
SENTENCE_BOUNDARY = r"""(?<=[.?!")])(?<=\."|\.\)|[.?!])(?![)'".])"""
