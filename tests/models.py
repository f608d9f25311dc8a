"""Plain-Python models of the reference behaviour, written for the tests.

They state the specified semantics directly (loops over lines and offsets)
and serve as independent checks of the Spark column expressions.
"""

import re

BOUNDARY_CHARS = ".?!"
NO_BOUNDARY_NEXT = ")'\".'"


def boundaries(s: str) -> list[int]:
    """End offsets of sentence boundaries, scanning characters."""
    out = []
    for i, ch in enumerate(s):
        nxt = s[i + 1] if i + 1 < len(s) else ""
        if nxt and nxt in ")'\".":
            continue
        if ch in BOUNDARY_CHARS or (ch in "\")" and i > 0 and s[i - 1] == "."):
            out.append(i + 1)
    return out


def pack(s: str, max_len: int, carry: bool = False) -> list[str]:
    bs = boundaries(s)
    segs, start, k = [], 0, 0
    while start < len(s):
        best = None
        while k < len(bs):
            b = bs[k]
            if b - start < max_len:
                if not (carry and b == start):  # a carried boundary at the start opens no empty segment
                    best = b
                k += 1
            else:
                if not carry:
                    k += 1  # the failing boundary is used up
                break
        cut = best if best is not None else start + max_len
        if carry and best is None and cut > len(s):
            cut = start + max_len
        segs.append(s[start:cut].strip())
        start = cut
    return segs


HEADER = re.compile(
    r"(?:\*\*\*.*START OF.*\*\*\*|Produced by.*|This etext was produced.*|E\-text prepared by .*"
    r"|.*Transcribed from.*|.*Project Gutenberg's Etext of.*)(?:\n.*){0,3}\n\n")


def strip_headers(s: str) -> str:
    while True:
        m = HEADER.search(s)
        if not m or m.end() >= 10000:
            return s
        s = s[m.end():]


def short_line_runs(s: str) -> str:
    """Ten or more consecutive lines (each followed by a newline) of at
    most 20 chars become one newline."""
    lines = s.split("\n")
    # each element except the last is followed by a newline
    out, i, n = [], 0, len(lines) - 1
    while i < n:
        j = i
        while j < n and len(lines[j]) <= 20:
            j += 1
        if j - i >= 10:
            out.append(None)  # marker for the single newline
            i = j
        else:
            out.append(lines[i])
            i += 1
    res = ""
    for part in out:
        res += "\n" if part is None else part + "\n"
    return res + lines[-1]


def punct_normalize(s: str) -> str:
    """The English punctuation rules, one replacement after the other, then strip."""
    s = s.replace("\r", "").replace("(", " (").replace(")", ") ")
    s = re.sub(" +", " ", s)
    s = re.sub(r"\) ([.!:?;,])", r")\1", s).replace("( ", "(").replace(" )", ")")
    s = re.sub(r"(\d) %", r"\1%", s).replace(" :", ":").replace(" ;", ";")
    s = s.replace("`", "'").replace("''", ' " ')
    for a, b in [("„", '"'), ("“", '"'), ("”", '"'), ("–", "-"), ("—", " - ")]:
        s = s.replace(a, b)
    s = re.sub(" +", " ", s).replace("´", "'")
    for q in "‘’‚":
        s = s.replace(q, "'")
    s = s.replace("''", '"').replace("…", "...")
    nb = "\u00a0"
    for q in ("«", "»"):
        s = s.replace(nb + q + nb, '"').replace(q + nb if q == "«" else nb + q, '"').replace(q, '"')
    for mark in "%:?!;":
        s = s.replace(nb + mark, mark)
    s = s.replace("nº" + nb, "nº ").replace(nb + "ºC", " ºC").replace(nb + "cm", " cm").replace("," + nb, ", ")
    s = re.sub(" +", " ", s)
    s = re.sub('"([,.]+)', r'\1"', s)
    return re.sub(rf"(\d){nb}(\d)", r"\1.\2", s).strip()


def xml_unescape(s: str) -> str:
    import html

    for name, char in (("bar", "|"), ("bra", "["), ("ket", "]")):
        s = s.replace(f"&{name};", char)
    for code in ("lt", "gt", "quot", "apos", "#91", "#93", "#124", "amp"):
        s = s.replace(f"&{code};", html.unescape(f"&{code};"))
    return s


def is_cjk(char: str) -> bool:
    blocks = ((0x1100, 0x11FF), (0x2E80, 0xA4CF), (0xA840, 0xA87F), (0xAC00, 0xD7AF), (0xF900, 0xFAFF), (0xFE30, 0xFE4F), (0xFF65, 0xFFDC), (0x20000, 0x2FFFF))
    return any(a <= ord(char) <= b for a, b in blocks)


def detokenize(text: str) -> str:
    """The English detokeniser rules over whitespace tokens, one token at a time."""
    t = " " + " ".join(text.split()) + " "
    t = t.replace(" @-@ ", "-")
    toks = xml_unescape(t).split()
    out, glue_next, counts = [], False, {}
    for i, tok in enumerate(toks):
        space = "" if (i == 0 or glue_next) else " "
        if is_cjk(tok[0]):
            out.append(tok if i > 0 and is_cjk(toks[i - 1][-1]) else space + tok)
            glue_next = False
            continue
        if re.fullmatch(r"[\p{Sc}(\[{¿¡]+".replace(r"\p{Sc}", "$€£¥"), tok):
            out.append(space + tok)
            glue_next = True
        elif re.fullmatch(r"[,.?!:;\\%}\])]+", tok):
            out.append(tok)
            glue_next = False
        elif i > 0 and len(tok) > 1 and tok[0] == "'" and tok[1].isalpha():
            out.append(tok)
            glue_next = False
        elif re.fullmatch(r"['\"„“`]+", tok):
            key = '"' if re.fullmatch("[„“”]+", tok) else tok
            n = counts.get(key, 0)
            if n % 2 == 0 and tok == "'" and i > 0 and toks[i - 1].endswith("s"):
                out.append(tok)
                glue_next = False
            elif n % 2 == 0:
                out.append(space + tok)
                glue_next = True
                counts[key] = n + 1
            else:
                out.append(tok)
                glue_next = False
                counts[key] = n + 1
        else:
            out.append(space + tok)
            glue_next = False
    return re.sub(" {2,}", " ", "".join(out)).strip()


def plain_bpe(words: dict, n_merges: int, min_count: int = 2) -> tuple[list, dict]:
    """(merges, symbols by word) of plain BPE: all pairs counted again for every merge, ties by the pair."""
    sym = {w: ["▁", *w] for w in words}
    merges = []
    while len(merges) < n_merges:
        counts = {}
        for w, f in words.items():
            for pair in zip(sym[w], sym[w][1:]):
                counts[pair] = counts.get(pair, 0) + f
        best = min(((-c, p) for p, c in counts.items() if c >= min_count), default=None)
        if best is None:
            break
        merges.append(best[1])
        for w in words:
            out = []
            for s in sym[w]:
                if out and (out[-1], s) == best[1]:
                    out[-1] += s
                else:
                    out.append(s)
            sym[w] = out
    return merges, sym
