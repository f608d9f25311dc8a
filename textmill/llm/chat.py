"""Chat formatting with Spark expressions only.

Turn structs are collected per conversation, sorted, and adjacent turns of one role are merged with
an array aggregation into blocks, which are concatenated:

    <|im_start|>role<|im_body|>text<|im_sep|>text<|im_end|>\\n

``<|im_sep|>`` stands between the turns that were merged, so that a reader finds each turn again.
Inside roles and texts every ``<|`` is written ``<\\|`` (and a backslash run after ``<`` grows by
one before ``|``), so no control string of the template can occur there, and the change can be undone.

Defined results: a null role or text is empty; turns are ordered by turn number (nulls first), then
role, then text, so ties and repeated rows have one result; rows with a null conversation id form
one conversation; an empty table gives an empty table; other columns are not read.  One conversation
is one output row, so its turns meet in one task (partial lists are collected before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.segment import prefix_sums

START, BODY, SEP, END = "<|im_start|>", "<|im_body|>", "<|im_sep|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    """Write ``<``, n backslashes, ``|`` with n + 1 backslashes."""
    return F.regexp_replace(text, r"<(\\*+)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, blocks): per conversation the array of (role, texts) of its merged turns."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    turns = df.select(F.col(conv_col).alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("turns"))
    t, size = F.col("turns"), F.size("turns")
    # Where a block begins: the first turn, and every turn whose role differs from the one before.
    begins = F.filter(F.sequence(F.lit(1), size), lambda i: (i == 1) | (F.get(t, i - 1)["role"] != F.get(t, F.greatest(i - 2, F.lit(0)))["role"]))
    # Block k runs from its begin to the next one's.
    blocks = F.zip_with(F.col("begins"), F.concat(F.slice(F.col("begins"), 2, F.size("begins")), F.array(size + 1)),
                        lambda a, b: F.struct(F.get(t, a - 1)["role"].alias("role"),
                                              F.transform(F.slice(t, a, b - a), lambda x: x["text"]).alias("texts")))
    return turns.withColumn("begins", begins).select("conv_id", F.filter(blocks, lambda b: b["role"].isNotNull()).alias("blocks"))


def format_chat(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", loss_role: str = ASSISTANT) -> DataFrame:
    """(conv_id, formatted, loss): one row per conversation.

    ``loss`` has the spans of the texts of ``loss_role`` (without role headers, separators and end
    marks): start and end in code points of ``formatted``, byte_start and byte_end in its UTF-8
    bytes, ends exclusive.
    """
    conv = conversations(df, conv_col, turn_col, role_col, text_col)
    pieces = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(_piece(F.concat(F.lit(START), escape(b["role"]), F.lit(BODY)), False)),
        F.flatten(F.transform(b["texts"], lambda x, i: F.when(
            i == 0, F.array(_piece(escape(x), b["role"] == loss_role))).otherwise(
            F.array(_piece(F.lit(SEP), False), _piece(escape(x), b["role"] == loss_role))))),
        F.array(_piece(F.lit(END), False)))))
    conv = conv.select("conv_id", pieces.alias("pieces"))
    return conv.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
                       _spans(F.col("pieces")).alias("loss"))


def _piece(text: Column, loss) -> Column:
    return F.struct(text.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))


def _spans(pieces: Column) -> Column:
    """The ranges of the pieces under the loss, in code points and in UTF-8 bytes."""
    ends = prefix_sums(F.transform(pieces, lambda p: F.length(p["text"])))
    byte_ends = prefix_sums(F.transform(pieces, lambda p: F.octet_length(p["text"])))
    spans = F.zip_with(pieces, F.arrays_zip(ends.alias("e"), byte_ends.alias("b")), lambda p, at: F.struct(
        p["loss"].alias("loss"), (at["e"] - F.length(p["text"])).alias("start"), at["e"].alias("end"),
        (at["b"] - F.octet_length(p["text"])).alias("byte_start"), at["b"].alias("byte_end")))
    return F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(
        *(s[c].cast("int").alias(c) for c in ("start", "end", "byte_start", "byte_end"))))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped: array of (role, text)."""
    blocks = F.filter(F.split(formatted, _literal(START), -1), lambda b: b != "")
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substring_index(F.substring_index(b, BODY, -1), END, 1), _literal(SEP), -1),
        lambda x: F.struct(unescape(F.substring_index(b, BODY, 1)).alias("role"), unescape(x).alias("text")))))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    data = F.encode(formatted, "UTF-8")
    return F.array_join(F.transform(loss, lambda s: unescape(F.decode(
        F.substring(data, s["byte_start"] + 1, s["byte_end"] - s["byte_start"]), "UTF-8"))), "")


def _literal(mark: str) -> str:
    return mark.replace("|", r"\|")
