"""DuckDB SQL for the oracle side of the correctness check.

An independent second rendering of each operator in DuckDB's dialect (RE2
regexes, list lambdas).  RE2 has no possessive quantifiers or look-around, so
the list-run patterns use the plain (backtracking-equivalent, leftmost-first)
forms and sentence boundaries are found character by character.  Every
helper returns SQL expression text.
"""

from __future__ import annotations

from textmill.functions import rx


def lit(s: str) -> str:
    """SQL string literal; characters below U+00A0 outside printable ASCII go through chr()."""
    parts, buf = [], []
    for ch in s:
        if ch in "\n\t\r" or 0x7F <= ord(ch) < 0xA0:
            if buf:
                parts.append("'" + "".join(buf).replace("'", "''") + "'")
                buf = []
            parts.append(f"chr({ord(ch)})")
        else:
            buf.append(ch)
    if buf or not parts:
        parts.append("'" + "".join(buf).replace("'", "''") + "'")
    return parts[0] if len(parts) == 1 else "(" + " || ".join(parts) + ")"


def rr(x: str, pat: str, rep: str, g: bool = True) -> str:
    return f"regexp_replace({x}, {lit(pat)}, {lit(rep)}{', ' + lit('g') if g else ''})"


def let(value: str, var: str, body: str) -> str:
    return f"list_transform([{value}], lambda {var}: {body})[1]"


WS = r"\s"

# Fixed values below: the same reference patterns as textmill.functions.rx,
# written for RE2 (plain, non-possessive forms; ``\1`` replacements).


def strip_indent(x):
    return rr(x, r"(?m)^ +", "")


def fix_mojibake(x):
    pat = "â\u0080[\u0094\u0099\u009c\u009d\u0098\u008a¦]"
    return f"replace({rr(x, pat, chr(39))}, 'Ã©', 'é')"


def unwrap_italics(x):
    return rr(x, r"_(.*?)_", r" \1 ")


def unwrap_brackets(x):
    return rr(x, r"\[(.*?)\]", r" \1 ")


def blockquote_to_space(x):
    return rr(x, r"(?m)^>", " ")


def drop_md_headers(x):
    return rr(x, r"(?m)^#{1,6}.{1,100}$", "")


def drop_bold_lines(x):
    return rr(x, r"(?m)^\*\*.{1,100}\*\*.{0,100}$", "")


def drop_chapter_lines(x):
    return rr(x, r"(?m)^(?:[Cc]hapter|CHAPTER).{1,100}$", "")


def bold_markers_to_space(x):
    return f"replace({x}, '**', ' ')"


URL = (r"[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b(?:[-a-zA-Z0-9()@:%_\+.~#?&/=]*)"
       r"|https?://(?:www\.)?[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b(?:[-a-zA-Z0-9()@:%_\+.~#?&/=]*)")


def scrub_urls(x):
    return rr(x, URL, " ")


def drop_illustrations_books(x):
    return rr(x, r"(?m)^\[.*(?:\n.*){0,10}\]", " ")


def drop_illustrations_pg(x):
    return rr(x, r"\[.*(?:\n.*){0,10}\]", "")


def cut_license(x):
    return rr(x, r"\n.*(?:" + "|".join(rx.GUTENBERG_END_MARKERS) + r")(?s:.*)\z", "", g=False)


HEADER = r"^(?s:.*?)(?:" + "|".join(rx.GUTENBERG_HEADER_PHRASES) + r")(?:\n.*){0,3}\n\n"


def strip_headers(x):
    e = f"length(regexp_extract(acc.t, {lit(HEADER)}, 0))"
    n_sep = f"((length(t0) - length(replace(t0, chr(10) || chr(10), ''))) // 2)"
    body = (f"list_reduce(range(0, {n_sep} + 1), lambda acc, i: CASE WHEN acc.done THEN acc "
            f"WHEN {e} > 0 AND {e} < {rx.GUTENBERG_HEADER_LIMIT} "
            f"THEN {{'t': substr(acc.t, {e} + 1), 'done': false}} "
            f"ELSE {{'t': acc.t, 'done': true}} END, {{'t': t0, 'done': false}}).t")
    return let(x, "t0", body)


def collapse_spaces(x):
    return rr(x, r" +", " ")


def strip_ws(x):
    return rr(x, r"^\s+|\s+$", "")


def drop_bold_runs(x):
    return rr(x, r"(?m)(?:^\*\*.{1,100}\*\*.{0,100}\n+){2,}", "")


def drop_numbered_runs(x):
    return rr(x, r"(?m)(?:^\d.{0,100}\n+){3,}", "")


def drop_short_line_runs(x):
    return rr(x, r"(?m)(?:^.{0,20}\n+){10,}", "\n")


def drop_contents_runs(x):
    return rr(x, r"(?m)(?:^(?:[Cc]hapter|CHAPTER)* *[\dIVX]+.{0,200}\n+){3,}", "")


def is_upper(p):
    return f"(regexp_matches({p}, '\\p{{Lu}}') AND NOT regexp_matches({p}, '[\\p{{Ll}}\\p{{Lt}}ªº]'))"


def has_non_space(p):
    return f"regexp_matches({p}, {lit(r'[^' + WS + ']')})"


def paragraph_ok(p):
    kws = " OR ".join(f"contains({p}, {lit(k)})" for k in rx.PARAGRAPH_KEYWORDS)
    return (f"(length({p}) > 5 AND (length({p}) - length(regexp_replace({p}, '[a-zA-Z]', '', 'g'))) * 3 > length({p}) "
            f"AND NOT ({kws}))")


def split(x, pat):
    return f"string_split_regex({x}, {lit(pat)})"


def _chapters_to_paragraphs(chapters, strip_after_collapse):
    kept = f"list_filter({split('ch', rx.LINE_SPLIT)}, lambda p: {paragraph_ok('p')})"
    joined = strip_ws(strip_indent(f"array_to_string({kept}, chr(10))"))
    out = strip_indent(collapse_spaces(joined))
    if strip_after_collapse:
        out = strip_ws(out)
    return f"list_transform(list_filter({chapters}, lambda ch: length(ch) > 5), lambda ch: {out})"


def clean_books3(x):
    b = x
    for f in (drop_bold_runs, drop_numbered_runs, drop_short_line_runs, fix_mojibake, unwrap_italics,
              unwrap_brackets, drop_illustrations_books, blockquote_to_space, drop_md_headers, drop_bold_lines,
              drop_chapter_lines, bold_markers_to_space):
        b = strip_indent(f(b))
    return _chapters_to_paragraphs(split(b, rx.CHAPTER_SPLIT_BOOKS), True)


def clean_webcrawl(x):
    t = x
    for f in (unwrap_italics, unwrap_brackets, blockquote_to_space, bold_markers_to_space, scrub_urls):
        t = strip_indent(f(t))
    return _chapters_to_paragraphs(split(t, rx.CHAPTER_SPLIT_WEB), False)


def clean_wiki(x):
    cond = " OR ".join(f"starts_with(p, {lit(w)})" for w in rx.WIKI_BACKMATTER_PREFIXES)
    return f"list_filter({clean_webcrawl(x)}, lambda p: NOT ({cond}))"


def clean_gutenberg(x):
    b = drop_illustrations_pg(fix_mojibake(x))
    for f in (unwrap_italics, unwrap_brackets, blockquote_to_space):
        b = strip_indent(f(b))
    b = strip_headers(cut_license(b))
    lines = f"list_filter({split('ch', rx.LINE_SPLIT)}, lambda p: {has_non_space('p')} AND NOT {is_upper('p')})"
    joined = strip_ws(strip_indent(f"array_to_string(list_transform({lines}, lambda p: {strip_ws('p')}), chr(10))"))
    chapter = strip_indent(drop_contents_runs(joined))
    chapters = f"list_transform({split(b, rx.CHAPTER_SPLIT_PG)}, lambda ch: {chapter})"
    chapters = f"list_filter({chapters}, lambda p: {paragraph_ok('p')})"
    return f"list_transform({chapters}, lambda ch: {strip_ws(strip_indent(collapse_spaces('ch')))})"


PROFILE_SQL = {"books3": clean_books3, "gutenberg": clean_gutenberg, "webcrawl": clean_webcrawl, "wiki": clean_wiki}


def clean_by_subset(x, subset, subsets):
    groups: dict[str, list[str]] = {}
    for s in subsets:
        groups.setdefault(rx.SUBSET_PROFILES[s], []).append(s)
    whens = " ".join(
        f"WHEN {subset} IN ({', '.join(lit(s) for s in members)}) THEN {PROFILE_SQL[prof](x)}"
        for prof, members in groups.items())
    return f"CASE {whens} END"


# --- sentence boundaries and packing -------------------------------------------------

def sentence_boundaries(x):
    """Boundary end offsets, character by character (RE2 has no look-around)."""
    cond = ("(c[i] IN ('.', '?', '!') OR (c[i] IN ('\"', ')') AND i > 1 AND c[i - 1] = '.')) "
            "AND (i = len(c) OR c[i + 1] NOT IN (')', '''', '\"', '.'))")
    body = f"list_filter(range(1, len(c) + 1), lambda i: {cond})"
    return let(f"string_split({x}, '')", "c", body)


def sentence_pack(x, max_len: int):
    """The packer as a list_reduce over boundary offsets, then hard-cut tail."""
    m = max_len
    step = (f"CASE WHEN b - acc.pos < {m} THEN {{'pos': acc.pos, 'last': b::BIGINT, 'cuts': acc.cuts}} "
            f"ELSE {{'pos': coalesce(acc.last, acc.pos + {m})::BIGINT, 'last': NULL::BIGINT, "
            f"'cuts': list_append(acc.cuts, coalesce(acc.last, acc.pos + {m})::BIGINT)}} END")
    init = "{'pos': 0::BIGINT, 'last': NULL::BIGINT, 'cuts': []::BIGINT[]}"
    red = f"list_reduce({sentence_boundaries('t')}, lambda acc, b: {step}, {init})"
    fin = ("list_concat(CASE WHEN r.last IS NULL THEN r.cuts ELSE list_append(r.cuts, r.last) END, "
           f"CASE WHEN coalesce(r.last, r.pos) < length(t) THEN "
           f"range(coalesce(r.last, r.pos) + {m}, length(t) + {m}, {m}) ELSE []::BIGINT[] END)")
    cuts = let(red, "r", fin)
    segs = ("list_transform(cs, lambda e, i: " + strip_ws(
        "substr(t, CASE WHEN i = 1 THEN 0 ELSE cs[i - 1] END + 1, e - CASE WHEN i = 1 THEN 0 ELSE cs[i - 1] END)")
        + ")")
    return let(x, "t", let(cuts, "cs", segs))


def char_windows(x, width: int):
    return let(x, "t", f"list_transform(range(0, length(t), {width}), lambda i: substr(t, i + 1, {width}))")


# --- word tokens, vocabulary, ratios ---------------------------------------------------

PUNCT = r"[\pP!-/:-@\[-`{-~]"
CJK = (r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
       r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}]")


def word_tokens(x):
    t = rr(x, r"[^\PC\t\n\r]|\x{FFFD}", "")
    t = rr(t, r"[\s\pZ]", " ")
    t = rr(t, "(" + CJK + ")", r" \1 ")
    t = rr(f"strip_accents(lower({t}))", "(" + PUNCT + ")", r" \1 ")
    return f"list_filter(string_split({t}, ' '), lambda w: w <> '')"


def vocab_cte(src: str = "documents", size: int = 2**16, min_freq: int = 8) -> str:
    """G2 as SQL: ``vocab(token, id, freq)``."""
    return (f"vocab AS (SELECT token, CAST(id AS INTEGER) AS id, CAST(freq AS BIGINT) AS freq FROM ("
            f"SELECT token, rk + 1 AS id, freq FROM (SELECT token, freq, row_number() OVER "
            f"(ORDER BY freq DESC, token ASC) AS rk FROM (SELECT token, count(*) AS freq FROM "
            f"(SELECT unnest({word_tokens('text')}) AS token FROM {src}) GROUP BY token "
            f"HAVING count(*) >= {min_freq})) WHERE rk <= {size - 2} "
            f"UNION ALL SELECT '<pad>', 0, 0 UNION ALL SELECT '<unk>', 1, 0))")


def unk_ratio_cte(src: str, key: str = "doc_id", text: str = "text", name: str = "ratios") -> str:
    """G4 as SQL (needs the ``vocab`` CTE): ``name(key, n_tokens, n_unk, unk_ratio)``;
    documents without tokens have a NULL ratio."""
    return (f"{name} AS (SELECT d.{key}, CAST(count(t.token) AS BIGINT) AS n_tokens, "
            f"CAST(count(t.token) - count(v.id) AS BIGINT) AS n_unk, "
            f"CASE WHEN count(t.token) > 0 THEN (count(t.token) - count(v.id)) / count(t.token) END AS unk_ratio "
            f"FROM {src} d LEFT JOIN (SELECT {key}, unnest({word_tokens(text)}) AS token FROM {src}) t ON d.{key} = t.{key} "
            f"LEFT JOIN vocab v ON v.token = t.token GROUP BY d.{key})")


def piece_count_cte(src: str, keys: str, text: str, name: str) -> str:
    """G5 as SQL (needs ``vocab``): known word = 1 piece, else one per character."""
    return (f"{name} AS (SELECT {keys}, CAST(sum(CASE WHEN v.id > 1 THEN 1 ELSE length(t.token) END) AS BIGINT) "
            f"AS n_pieces FROM (SELECT {keys}, unnest({word_tokens(text)}) AS token FROM {src}) t "
            f"LEFT JOIN vocab v USING (token) GROUP BY {keys})")


def bpe_pieces(x: str, merges: list[tuple[str, str]]) -> str:
    """G5 with a given model: every merge is a replacement in a string of marked symbols."""
    w = f"concat(chr(1), '▁', chr(2), regexp_replace({x}, '(.)', chr(1) || '\\1' || chr(2), 'g'))"
    for a, b in merges:
        w = f"replace({w}, chr(1) || {lit(a)} || chr(2) || chr(1) || {lit(b)} || chr(2), chr(1) || {lit(a + b)} || chr(2))"
    return f"(length({w}) - length(replace({w}, chr(1), '')))"


# --- normaliser ----------------------------------------------------------------------
# Written apart from textmill.functions.normalize, so that a slip there shows.

# NFKC is not in DuckDB: the compatibility characters that the test view holds, with their forms.
NFKC_PAIRS = [("ﬁ", "fi"), ("Ａ", "A"), ("１", "1"), ("①", "1"), ("ｶ", "カ"), ("ª", "a"), ("º", "o"), ("\u00a0", " "), ("…", "..."), ("²", "2")]


def special_map(x):
    """Diaeresis, zero-width space, quote, notes, bullet and direction marks, then compatibility forms."""
    for k, v in [("¨", '"'), *NFKC_PAIRS, ("\u200b", " "), ("’", "'"), ("♪", " "), ("♫", " "), ("●", "-"), ("&lrm;", ""), ("&rlm;", "")]:
        x = f"replace({x}, {lit(k)}, {lit(v)})"
    return x


DOUBLE = '"'


def moses_punct_normalize(x):
    """Carriage returns, parentheses, spaces, quotes, dashes, no-break spaces, quotation order."""
    x = f"replace(replace(replace({x}, chr(13), ''), '(', ' ('), ')', ') ')"
    x = rr(rr(x, " {1,}", " "), r"\) ([.!:?;,])", r")\1")
    x = rr(f"replace(replace({x}, '( ', '('), ' )', ')')", r"(\p{Nd}) %", r"\1%")
    x = f"replace(replace({x}, ' :', ':'), ' ;', ';')"
    one, two = lit("'"), lit("'" * 2)
    x = f"replace(replace({x}, '`', {one}), {two}, {lit(' " ')})"
    for q in "„“”":
        x = f"replace({x}, '{q}', {lit(DOUBLE)})"
    x = rr(f"replace(replace({x}, '–', '-'), '—', ' - ')", " {1,}", " ")
    x = f"replace({x}, '´', {one})"
    for q in "‘’‚":
        x = f"replace({x}, '{q}', {one})"  # between letters or not, the same
    x = f"replace(replace({x}, {two}, {lit(DOUBLE)}), '…', '...')"
    nb = "\u00a0"
    for k in (f"{nb}«{nb}", f"«{nb}", "«", f"{nb}»{nb}", f"{nb}»", "»"):
        x = f"replace({x}, '{k}', {lit(DOUBLE)})"
    for k, v in ((f"{nb}%", "%"), (f"nº{nb}", "nº "), (f"{nb}:", ":"), (f"{nb}ºC", " ºC"), (f"{nb}cm", " cm"), (f"{nb}?", "?"), (f"{nb}!", "!"),
                 (f"{nb};", ";"), (f",{nb}", ", ")):
        x = f"replace({x}, '{k}', '{v}')"
    x = rr(rr(x, " {1,}", " "), '"([,.]+)', r'\1"')
    return strip_ws(rr(x, f"(\\p{{Nd}}){nb}(\\p{{Nd}})", r"\1.\2"))


def ws_tokens(x):
    return f"list_filter(string_split_regex({x}, '[\\s\\pZ]+'), lambda w: w <> '')"


def detokenize(tokens):
    text = f"(' ' || array_to_string({tokens}, ' ') || ' ')"
    text = f"replace({text}, ' @-@ ', '-')"
    for name, char in [("bar", "|"), ("lt", "<"), ("gt", ">"), ("bra", "["), ("ket", "]"), ("quot", '"'), ("apos", "'"),
                       ("#91", "["), ("#93", "]"), ("#124", "|"), ("amp", "&")]:
        text = f"replace({text}, {lit('&' + name + ';')}, {lit(char)})"
    cjk = (r"[\x{1100}-\x{11FF}\x{2E80}-\x{A4CF}\x{A840}-\x{A87F}\x{AC00}-\x{D7AF}\x{F900}-\x{FAFF}"
           r"\x{FE30}-\x{FE4F}\x{FF65}-\x{FFDC}\x{20000}-\x{2FFFF}]")
    kind = (f"CASE WHEN regexp_matches(tk, '^{cjk}') THEN 'K' "
            "WHEN regexp_matches(tk, '^[\\p{Sc}(\\[{¿¡]+$') THEN 'R' "
            "WHEN regexp_matches(tk, '^[,.?!:;\\\\%}\\])]+$') THEN 'L' "
            "WHEN j > 1 AND regexp_matches(tk, '^''\\pL') THEN 'C' "
            "WHEN regexp_matches(tk, '^[''\"„“`]+$') THEN 'Q' ELSE 'N' END")
    kinds = f"list_transform(tt, lambda tk, j: {kind})"
    qidx = "list_filter(range(1, len(tt) + 1), lambda j: kd[j] = 'Q')"
    key = "CASE WHEN regexp_matches(tt[j], '^[„“”]+$') THEN '\"' ELSE tt[j] END"
    cnt = f"coalesce(acc.cnts[list_position(acc.keys, {key})], 0)"
    bump = (f"CASE WHEN list_position(acc.keys, {key}) IS NULL THEN list_append(acc.cnts, {cnt} + 1) "
            f"ELSE list_transform(acc.cnts, lambda cv, ci: CASE WHEN ci = list_position(acc.keys, {key}) "
            f"THEN cv + 1 ELSE cv END) END")
    keys = (f"CASE WHEN list_position(acc.keys, {key}) IS NULL THEN list_append(acc.keys, {key}) "
            f"ELSE acc.keys END")
    poss = "(tt[j] = '''' AND j > 1 AND suffix(tt[j - 1], 's'))"
    step = (f"CASE WHEN {cnt} % 2 = 0 AND {poss} THEN {{'keys': acc.keys, 'cnts': acc.cnts, 'd': list_append(acc.d, 2)}} "
            f"WHEN {cnt} % 2 = 0 THEN {{'keys': {keys}, 'cnts': {bump}, 'd': list_append(acc.d, 0)}} "
            f"ELSE {{'keys': {keys}, 'cnts': {bump}, 'd': list_append(acc.d, 1)}} END")
    init = "{'keys': []::VARCHAR[], 'cnts': []::INTEGER[], 'd': []::INTEGER[]}"
    dec = f"list_reduce({qidx}, lambda acc, j: {step}, {init}).d"
    qd = "dd[list_position(qx, {i})]"
    opens = f"(kd[{{i}}] = 'R' OR (kd[{{i}}] = 'Q' AND {qd} = 0))"
    left = (f"(kd[{{i}}] IN ('L', 'C') OR (kd[{{i}}] = 'Q' AND {qd} <> 0) OR (kd[{{i}}] = 'K' AND {{i}} > 1 "
            f"AND regexp_matches(tt[{{i}} - 1], '{cjk.replace('{', '{{').replace('}', '}}')}$')))")
    piece = (f"CASE WHEN j > 1 AND NOT {left.format(i='j')} AND NOT {opens.format(i='j - 1')} "
             f"THEN ' ' || tk ELSE tk END")
    joined = f"array_to_string(list_transform(tt, lambda tk, j: {piece}), '')"
    body = let(kinds, "kd", let(qidx, "qx", let(dec, "dd", joined)))
    out = let(ws_tokens(text), "tt", body)
    return strip_ws(rr(out, " {2,}", " "))


def fix_tokenized(x):
    return detokenize(ws_tokens(x))


def normalize_text(x):
    return fix_tokenized(moses_punct_normalize(special_map(x)))


def moses_tokenize(x):
    """D22 as SQL: separate symbols, dots, commas and apostrophes, split sentence-final periods, escape."""
    t = rr(rr(strip_ws(x), r"[\s\pZ]+", " "), r"[\x00-\x1f]", "")
    t = rr(rr(t, r"([^\pL\pN\s.'`,\-])", r" \1 "), r"(\.\.+)", r" \1 ")
    t = rr(rr(rr(t, r"([^\pN]),", r"\1 , "), r",([^\pN])", r" , \1"), r"(\pN),$", r"\1 ,")
    t = rr(rr(t, r"([^\pL])'([^\pL])", r"\1 ' \2"), r"([^\pL\pN])'(\pL)", r"\1 ' \2")
    t = rr(rr(rr(t, r"(\pL)'([^\pL])", r"\1 ' \2"), r"(\pL)'(\pL)", r"\1 '\2"), r"(\pN)'(s)", r"\1 '\2")
    abbreviations = ("Adj Adm Adv Asst Bart Bldg Brig Bros Capt Cmdr Col Comdr Con Corp Cpl DR Dr Drs Ens Gen Gov Hon Hr Hosp Insp Lt MM MR MRS "
                     "MS Maj Messrs Mlle Mme Mr Mrs Ms Msgr Op Ord Pfc Ph Prof Pvt Rep Reps Res Rev Rt Sen Sens Sfc Sgt Sr St Supt Surg v vs i.e "
                     "rev e.g Nos Nr").split()
    nxt = "coalesce(mw[mi + 1], '')"
    keep = (f"(contains(pre, '.') AND regexp_matches(pre, '\\pL')) OR regexp_matches(pre, '^[A-Z]$') OR pre IN ({', '.join(map(lit, abbreviations))}) "
            f"OR regexp_matches({nxt}, '^\\p{{Ll}}') OR (pre IN ('No', 'Art', 'pp') AND regexp_matches({nxt}, '^[0-9]'))")
    one = let("CASE WHEN suffix(wd, '.') AND length(wd) > 1 THEN left(wd, length(wd) - 1) ELSE '' END", "pre",
              f"CASE WHEN pre = '' OR regexp_matches(wd, '^\\.+$') OR {keep} THEN wd ELSE pre || ' .' END")
    words = f"list_filter(string_split({t}, ' '), lambda w: w <> '')"
    t = let(words, "mw", f"array_to_string(list_transform(mw, lambda wd, mi: {one}), ' ')")
    t = rr(t, r"\.' ?$", " . ' ")
    for char, name in [("&", "amp"), ("|", "#124"), ("<", "lt"), (">", "gt"), ("'", "apos"), ('"', "quot"), ("[", "#91"), ("]", "#93")]:
        t = f"replace({t}, {lit(char)}, {lit('&' + name + ';')})"
    return f"list_filter(string_split({t}, ' '), lambda w: w <> '')"
