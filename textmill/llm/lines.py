"""Line dedup with a log-template tree, in DataFrame operations only.

Lines are parsed by a tree of fixed depth: the first level is the token count, the next DEPTH levels
are the leading tokens (tokens with a digit count as the wildcard ``<*>``, except in rows of figures).  A leaf generalises its
lines: its template has, at each position, the token that more than half of its distinct lines hold,
or the wildcard; a line of at least DEPTH + TAIL tokens joins the template if at least SIMILAR of its
tokens behind the leading ones agree.  Any other line is a template of its own (digits generalised).
Templates that occur in at least ``min_docs`` different texts are dropped from all documents.

With ``several`` a leaf also has a template for each set of frequent (position, token) pairs, those that
lines of at least ``min_docs`` texts hold: a line's own set, and its set without any one pair, if at
least SIMILAR of the tokens behind the leading ones remain.  So templates of equal share don't hide each
other, and prose that fills a leaf hides none.

Only hashes of lines are shuffled, counted map-side first; tokens are read again only for one line of
each kind in leaves that could reach ``min_docs`` by generalising.  Whole copies of a text count once.

Defined results: a null text stays null with no lines; an empty text has one blank line; lines without
a token (blank) are never dropped; repeated rows are treated alike; rows with a null id are documents
like any other; an empty table gives an empty table; all columns of the input pass through, and
``n_lines`` and ``n_dropped`` replace columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import fresh
from textmill.llm.store import saved

DEPTH = 3
TAIL = 3
SIMILAR = 0.7
MIN_DOCS = 10
#: Literal tokens of a line that is a copied passage if it stands in two texts.
PASSAGE = 20
WILDCARD = "<*>"


def tokens(line: Column) -> Column:
    """The white-space separated tokens of a line.  Unless more than half of them have a digit (a row
    of figures is no template), those that have one are the wildcard."""
    parts = F.filter(F.split(line, r"[ \t\x0B\f\r]+", -1), lambda t: t != "")
    figures = F.size(F.filter(parts, lambda t: t.rlike("[0-9]")))
    return F.when(line.rlike("[0-9]") & (2 * figures <= F.size(parts)), F.transform(
        parts, lambda t: F.when(t.rlike("[0-9]"), F.lit(WILDCARD)).otherwise(t))).otherwise(parts)


def _parsed(docs: DataFrame) -> DataFrame:
    """(doc, text_key, line_no, parts, n, leaf, template) of all non-blank lines of (doc, text_key, t)."""
    lines = docs.select("doc", "text_key", F.posexplode(F.split("t", "\n", -1)).alias("line_no", "line"))
    lines = lines.select("doc", "text_key", "line_no", tokens(F.col("line")).alias("parts"))
    return lines.withColumn("n", F.size("parts")).where("n > 0").select(
        "*", F.xxhash64("n", F.slice("parts", 1, DEPTH)).alias("leaf"), F.xxhash64("n", "parts").alias("template"))


def _agreeing(places: DataFrame, by_line: DataFrame, seen: DataFrame, min_docs: int) -> DataFrame:
    """(template): lines whose frequent (position, token) pairs stand together in ``min_docs`` texts."""
    counted = places.join(by_line.select("template", "n", "texts"), "template")
    frequent = counted.groupBy("leaf", "at", "token").agg(F.sum("texts").alias("held")).where(F.col("held") >= min_docs).select("leaf", "at", "token")
    # A set of pairs goes by the exclusive or of their hashes, so leaving one out is one step: linear in the line.
    pair = F.xxhash64("at", "token")
    own = counted.join(frequent, ["leaf", "at", "token"]).groupBy("leaf", "template", "n").agg(
        F.bit_xor(pair).alias("all"), F.collect_list(pair).alias("each"))
    need = SIMILAR * (F.col("n") - DEPTH)
    less = F.when(F.size("each") - 1 >= need, F.transform("each", lambda h: F.col("all").bitwiseXOR(h)))
    sets = own.where(F.size("each") >= need).select("leaf", "template", F.explode(
        F.concat(F.array("all"), F.coalesce(less, F.array().cast("array<bigint>")))).alias("set"))
    sets = saved(sets, "sets-of-pairs")
    texts = seen.select("template", "text_key").join(sets, "template").select("leaf", "set", "text_key").distinct()
    held = texts.groupBy("leaf", "set").agg(F.count("*").alias("texts")).where(F.col("texts") >= min_docs).select("leaf", "set")
    return sets.join(held, ["leaf", "set"], "left_semi").select("template")


def recurring(docs: DataFrame, parsed: DataFrame, min_docs: int, several: bool = False) -> DataFrame:
    """(template): the line templates to drop."""
    seen = parsed.select("template", "leaf", "n", "text_key").distinct()
    by_line = saved(seen.groupBy("template", "leaf", "n").agg(F.count("*").alias("texts")), "templates")
    often = by_line.where(F.col("texts") >= min_docs).select("template")
    # Leaves that hold several lines, and enough of them together.
    open_ = by_line.where(F.col("n") >= DEPTH + TAIL).groupBy("leaf").agg(F.sum("texts").alias("texts"), F.count("*").alias("kinds")).where(
        (F.col("texts") >= min_docs) & (F.col("kinds") > 1)).select("leaf")
    # One line of each kind there is read again from its text.
    chosen = parsed.where(F.col("n") >= DEPTH + TAIL).groupBy("leaf", "template").agg(
        F.min(F.struct("doc", "text_key", "line_no")).alias("at")).join(open_, "leaf", "left_semi").select("at.*", "leaf", "template")
    chosen = chosen.groupBy("doc", "text_key").agg(F.collect_list(F.struct("line_no", "leaf", "template")).alias("chosen"))
    lines = docs.join(chosen.hint("shuffle_hash"), ["doc", "text_key"]).select(F.split("t", "\n", -1).alias("lines"), "chosen")
    kinds = lines.select("lines", F.explode("chosen").alias("at")).select(
        "at.leaf", "at.template", tokens(F.get("lines", F.col("at.line_no"))).alias("parts")).dropDuplicates(["leaf", "template"])
    kinds = saved(kinds, "kinds")
    places = kinds.select("leaf", "template", F.posexplode("parts").alias("at", "token")).where(F.col("at") >= DEPTH)
    total = kinds.groupBy("leaf").agg(F.count("*").alias("kinds"))
    common = places.groupBy("leaf", "at", "token").agg(F.count("*").alias("held")).join(total, "leaf").where(
        F.col("held") * 2 > F.col("kinds")).select("leaf", "at", "token")
    joined = places.join(common, ["leaf", "at", "token"]).groupBy("leaf", "template").agg(F.count("*").alias("agree"))
    joined = joined.join(by_line.select("template", "n"), "template").where(
        F.col("agree") >= SIMILAR * (F.col("n") - DEPTH)).select("leaf", "template")
    texts = seen.select("template", "text_key").join(joined, "template").select("leaf", "text_key").distinct()
    general = texts.groupBy("leaf").agg(F.count("*").alias("texts")).where(F.col("texts") >= min_docs).select("leaf")
    gone = often.unionByName(joined.join(general, "leaf", "left_semi").select("template"))
    return (gone.unionByName(_agreeing(places, by_line, seen, min_docs)) if several else gone).distinct()


def drop_copied_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with lines of at least PASSAGE literal tokens cut out of all texts but one (that of the
    smallest hash) if they stand in several texts, and ``n_lines`` and ``n_dropped``."""
    docs = _keyed(df, id_col, text_col)
    literal = F.size(F.filter("parts", lambda t: t != WILDCARD))
    parsed = saved(_parsed(docs).where(literal >= PASSAGE).select("doc", "text_key", "line_no", "template"), "passages")
    held = parsed.groupBy("template").agg(F.min("text_key").alias("first"), F.max("text_key").alias("last")).where("first < last")
    return _cut(df, id_col, text_col, parsed.join(held, "template").where("text_key <> first"))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.xxhash64(F.col(id_col), F.lit(1)).alias("doc"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("t"))


def drop_recurring_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                         several: bool = False) -> DataFrame:
    """``df`` with the recurring lines cut out of its texts, and ``n_lines`` and ``n_dropped``."""
    docs = _keyed(df, id_col, text_col)
    parsed = saved(_parsed(docs).select("doc", "text_key", "line_no", "n", "leaf", "template"), "lines")
    return _cut(df, id_col, text_col, parsed.join(recurring(docs, parsed, min_docs, several), "template", "left_semi"))


def _cut(df: DataFrame, id_col: str, text_col: str, lines: DataFrame) -> DataFrame:
    """``df`` without the ``lines`` (doc, text_key, line_no), and ``n_lines`` and ``n_dropped``."""
    doc, text_key = F.xxhash64(F.col(id_col), F.lit(1)), F.xxhash64(F.col(text_col))
    d, k, g, parts = (fresh(df, c) for c in ("doc", "text_key", "gone", "lines"))
    gone = lines.groupBy(F.col("doc").alias(d), F.col("text_key").alias(k)).agg(F.collect_set("line_no").alias(g))
    marked = df.withColumns({d: doc, k: text_key}).join(gone, [d, k], "left").withColumn(parts, F.split(F.col(text_col), "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(g))
    text = F.when(F.col(g).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    kept = [c for c in df.columns if c.lower() not in ("n_lines", "n_dropped")]
    return marked.select(
        *(text.alias(c) if c == text_col else F.col(c) for c in kept),
        F.greatest(F.coalesce(F.size(parts), F.lit(0)), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.coalesce(F.size(g), F.lit(0)), F.lit(0)).cast("long").alias("n_dropped"))
