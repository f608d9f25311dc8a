"""HTML 5 character references as a column expression.

A text is cut at its references; each is looked up in maps that Spark folds to constants once per plan.
The tables are the standard library's (``html.entities.html5`` and the numeric exceptions of ``html``): a
name with its semicolon, else the longest beginning of it that is a name without one.
"""

from __future__ import annotations

import html
import json
from collections import defaultdict
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A reference: a number, or a name of up to 32 characters, as browsers read them.
REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32}+;?)"
# Names that need no semicolon are short.
_BARE = {name: value for name, value in html5.items() if not name.endswith(";")}
_LONGEST = max(map(len, _BARE))


def _map(table: dict, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(table)), kind)


def _by_first(table: dict[str, str]) -> dict[str, dict[str, str]]:
    """Maps of a few names each, by the first character: a map lookup reads its keys one by one."""
    out: dict = defaultdict(dict)
    for name, value in table.items():
        out[name[0]][name] = value
    return out


def _numeric(ref: Column) -> Column:
    """The character of ``&#...`` (decimal or hexadecimal)."""
    digits = F.regexp_extract(ref, "([0-9a-fA-F]+);?$", 1)
    bare = F.regexp_replace(digits, "^0+", "")
    hexa = F.regexp_like(ref, F.lit("^&#[xX]"))
    # Numbers of more digits are no characters.
    n = F.when(F.length(bare) > 8, F.lit(0x110000)).otherwise(F.coalesce(F.when(hexa, F.conv(bare, 16, 10)).otherwise(bare).try_cast("long"), F.lit(0)))
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    special = F.try_element_at(_map({str(k): v for k, v in html._invalid_charrefs.items()} | {str(k): "" for k in html._invalid_codepoints if k not in html._invalid_charrefs},
                                    "map<string,string>"), n.cast("string"))
    return F.when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("�")).otherwise(F.coalesce(special, char))


def _named(ref: Column) -> Column:
    """The characters of ``&name``, of the longest beginning that is a name, or the text itself."""
    name = F.substring(ref, F.lit(2), F.length(ref))
    of_name = lambda table, n: F.try_element_at(F.try_element_at(_map(_by_first(table), "map<string,map<string,string>>"), F.substring(n, 1, 1)), n)
    ways = [of_name(html5, name)]
    for k in range(_LONGEST, 1, -1):
        ways.append(F.when(F.length(name) > k, F.concat(of_name(_BARE, F.substring(name, 1, k)), F.substring(name, F.lit(k + 1), F.length(name)))))
    return F.coalesce(*ways, ref)


def unescape(t: Column) -> Column:
    """``t`` with its references as characters."""
    refs = F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0))
    made = F.transform(refs, lambda r: F.when(F.startswith(r, F.lit("&#")), _numeric(r)).otherwise(_named(r)))
    between = F.split(t, REFERENCE, -1)
    return F.array_join(F.zip_with(between, F.concat(made, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
