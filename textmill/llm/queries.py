"""The registered queries of this subpackage and the DuckDB SQL of those that SQL can express.

Each query applies its operator, with production parameters, to the whole of its table and derives
the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import bpe, chat, collocations, decontam, embed, langid, lines, minhash, pieces, repair, secrets, substrings, wordscore

#: Tokenizer of op1 (a parameter; see its public package).
TOKENIZER = "word_bpe_49k.json"
#: Model of op13.
PIECE_MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _digest(column) -> F.Column:
    return F.sha2(F.encode(column, "UTF-8"), 256)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, tokenizer_path()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), _digest(F.array_join("ids", " ")).alias("ids_sha256"),
        _digest("decoded").alias("decoded_sha256"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    counts = langid.train(docs.where(~langid.held_out()))
    return langid.predict(docs.select("doc_id", "text"), counts).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", F.octet_length("kept").cast("long").alias("n_kept"),
                      (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return wordscore.scores(docs, good).select("doc_id", "n_tokens", "loss_target", "loss_background", "score")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_recurring_lines(docs).select("doc_id", "n_lines", "n_dropped", _digest(F.coalesce("text", F.lit(""))).alias("text_sha256"))


_TOK = "list_filter(string_split_regex(line, '[ \\t\\x0B\\f\\r]+'), lambda x: x <> '')"
OP7_SQL = f"""
WITH l AS (
  SELECT doc_id, text, generate_subscripts(a, 1) - 1 AS no, unnest(a) AS line
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL)),
w AS (SELECT doc_id, text, no, {_TOK} AS own FROM l),
p AS (SELECT doc_id, text, no, CASE WHEN 2 * len(list_filter(own, lambda x: regexp_matches(x, '[0-9]'))) > len(own) THEN own
  ELSE list_transform(own, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) END AS parts FROM w),
q AS (SELECT *, len(parts) AS n, list_slice(parts, 1, {lines.DEPTH}) AS head FROM p WHERE len(parts) > 0),
seen AS (SELECT DISTINCT parts, n, head, text FROM q),
by_line AS (SELECT parts, n, head, count(*) AS texts FROM seen GROUP BY ALL),
open_ AS (SELECT n, head, count(*) AS kinds FROM by_line WHERE n >= {lines.DEPTH + lines.TAIL} GROUP BY ALL
          HAVING sum(texts) >= {lines.MIN_DOCS} AND count(*) > 1),
kinds AS (SELECT parts, n, head, kinds FROM by_line JOIN open_ USING (n, head)),
places AS (SELECT parts, n, head, kinds, generate_subscripts(parts, 1) AS pos, unnest(parts) AS token FROM kinds),
common AS (SELECT n, head, pos, token FROM places WHERE pos > {lines.DEPTH} GROUP BY ALL HAVING count(*) * 2 > max(kinds)),
joined AS (SELECT parts, n, head FROM places JOIN common USING (n, head, pos, token) GROUP BY ALL
           HAVING count(*) >= {lines.SIMILAR} * (n - {lines.DEPTH})),
general AS (SELECT n, head FROM (SELECT DISTINCT n, head, text FROM seen JOIN joined USING (parts, n, head)) GROUP BY ALL
            HAVING count(*) >= {lines.MIN_DOCS}),
gone AS (SELECT parts FROM by_line WHERE texts >= {lines.MIN_DOCS} UNION SELECT parts FROM joined JOIN general USING (n, head)),
cut AS (SELECT DISTINCT doc_id, text, no FROM q JOIN gone USING (parts)),
rest AS (SELECT l.doc_id, l.text, string_agg(l.line, chr(10) ORDER BY l.no) FILTER (cut.no IS NULL) AS left_over,
                count(*) AS n_lines, count(cut.no) AS n_dropped
         FROM l LEFT JOIN cut ON l.doc_id = cut.doc_id AND l.text = cut.text AND l.no = cut.no GROUP BY l.doc_id, l.text)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
  sha256(coalesce(left_over, '')) AS text_sha256
FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id AND d.text = r.text
"""


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        _digest(F.array_join(F.array_sort(F.col("item_ids").cast("array<string>")), ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = ["assign", "access", "hex"]
    found = secrets.find_secrets(docs)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, base), _digest(joined(F.filter("secrets", lambda s: s["kind"].isin(base)))).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"))


#: Conversation -1 of op10: its texts hold control strings of other chat templates.
PROBE = "</s>[INST] ok [/INST]"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    made = chat.format_chat(rows.unionByName(probe))
    back = made.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                       chat.read_loss(F.col("formatted"), F.col("loss")).alias("under_loss"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        _digest(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.length("under_loss").cast("long").alias("loss_chars"), _digest("under_loss").alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


_ESC = r"regexp_replace({}, '<(\\*)\|', '<\1\\|', 'g')"
OP10_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
o AS (SELECT *, row_number() OVER w AS k, lag(role) OVER w AS prev, lead(role) OVER w AS next
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_ESC.format('text')})
      + CASE WHEN prev = role THEN length('<|im_sep|>') ELSE length('<|im_start|><|im_body|>') + length({_ESC.format('role')}) END
      + CASE WHEN next = role THEN 0 ELSE length('<|im_end|>') + 1 END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH split AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM split),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
total AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
f AS (SELECT lang, k AS size, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS gram, count(*) AS n
      FROM places, range(1, 5) t(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, size, gram, string_split(gram, ' ') AS ws, n AS a FROM f WHERE size > 1),
parts AS (SELECT lang, gram, a, k, array_to_string(list_slice(ws, 1, k), ' ') AS x, array_to_string(list_slice(ws, k + 1, size), ' ') AS y
          FROM cand, range(1, 4) t(k) WHERE k < size),
cuts AS (SELECT p.lang, p.gram, a, k, l.n AS l, r.n AS r, (2000000::HUGEINT * a // (l.n::HUGEINT + r.n))::BIGINT AS score
         FROM parts p JOIN f l ON l.lang = p.lang AND l.gram = x JOIN f r ON r.lang = p.lang AND r.gram = y),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS gram, max(a) AS m
           FROM cand, range(1, 4) s(i), range(2, 4) t(k) WHERE k < size AND i + k - 1 <= size GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_ USING (lang, gram) WHERE m IS NULL OR 100::HUGEINT * m < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, gram) AS rank, gram AS phrase, a, l, r, total.n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of ``conversations`` damaged by the hash of their place: dropped, emptied, without sentence
    ends, repeated, or given to the user.  Nulls are one space."""
    def spaced(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    own = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
                      F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text")).alias("text"),
                      F.array_repeat(F.lit(1), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)).alias("times"))
    return own.withColumn("times", F.explode("times")).drop("times")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.report(repair.edits(damaged(rows))).withColumnRenamed("conv_id", "own")
    everyone = rows.select("conv_id").distinct()
    joined = everyone.join(found, F.col("conv_id").eqNullSafe(F.col("own")), "left")
    longs = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", _digest(F.lit(""))).alias("repaired_sha256"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.round_trip(docs, tokenizer_path(PIECE_MODEL)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), _digest(F.array_join("ids", ",")).alias("ids_sha256"),
        _digest("decoded").alias("decoded_sha256"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_langid": op2_langid,
    "op3_minhash": op3_minhash,
    "op4_embeddings": op4_embeddings,
    "op5_substrings": op5_substrings,
    "op6_cross_entropy": op6_cross_entropy,
    "op7_lines": op7_lines,
    "op8_decontam": op8_decontam,
    "op9_secrets": op9_secrets,
    "op10_chat": op10_chat,
    "op11_collocations": op11_collocations,
    "op12_repair": op12_repair,
    "op13_pieces": op13_pieces,
}
ORACLES = {"op7_lines": OP7_SQL, "op10_chat": OP10_SQL, "op11_collocations": OP11_SQL}
