"""The opN queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm import langid
from voxlake.llm.chat import format_conversations, read_conversations
from voxlake.llm.common import scratch_path
from voxlake.llm.decontaminate import contamination
from voxlake.llm.html import main_text
from voxlake.llm.image_copies import image_copies, rendered
from voxlake.llm.line_dedup import dedup_lines
from voxlake.llm.near_dup import near_duplicates
from voxlake.llm.packing import pack_documents
from voxlake.llm.quality import quality_scores, train
from voxlake.llm.token_output import read_back, write_tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=85)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), window=3)


def hashed_id(modulus: int):
    """crc32 of the id as text, modulo: which rows may be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % modulus


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = langid.train(docs.filter(hashed_id(4) != 2))
    return langid.identify(docs.select("doc_id", "text"), models, reject=False).select("doc_id", (hashed_id(4) == 2).alias("held_out"), "lang_pred", "score", "bits", "rejected")


def op2_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_copies(rendered(table(spark, sf_dir, "embeddings")))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return read_conversations(format_conversations(turns), ordered=True)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    return train(docs, table(spark, sf_dir, "labels"), allowed=hashed_id(3) != 1)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scores(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", (hashed_id(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=2)
    return read_back(spark, path)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2, window=4096)


QUERIES = {
    "op2_image_copies": op2_image_copies,
    "op3_chat_format": op3_chat_format,
    "op7_token_output": op7_token_output,
    "op9_html_text": op9_html_text,
    "op10_packing": op10_packing,
    "op1_language_id": op1_language_id,
    "op8_quality": op8_quality,
    "op4_near_dup": op4_near_dup,
    "op5_decontaminate": op5_decontaminate,
    "op6_line_dedup": op6_line_dedup,
}

ORACLE = {
    "op3_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(14 + length(role) + len(regexp_extract_all(role, '\\|###|</turn>|:')) + length(text) + len(regexp_extract_all(text, '\\|###|</turn>'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op4_near_dup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, both_ways.y FROM r JOIN both_ways ON r.c = both_ways.x),
comp AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op5_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS need, array_to_string(list_slice(ws, s, s + least(10, len(ws)) - 1), ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM b WHERE len(ws) > 0)),
needs AS (SELECT DISTINCT need FROM bw),
dw AS (
  SELECT doc_id, need, s, array_to_string(list_slice(ws, s, s + need - 1), ' ') AS win
  FROM (SELECT doc_id, ws, need, unnest(range(1, len(ws) - need + 2)) AS s FROM d, needs WHERE len(ws) >= need)),
m AS (SELECT DISTINCT doc_id, item_id, s, dw.need AS need FROM dw JOIN bw ON dw.win = bw.win AND dw.need = bw.need),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + need)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op6_line_dedup": r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (
  SELECT doc_id, i, ls[i] AS a, ls[i + 1] AS b, ls[i + 2] AS c
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM d WHERE len(ls) >= 3)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS rn FROM w WHERE trim(a) <> '' OR trim(b) <> '' OR trim(c) <> '')
  WHERE rn > 1),
cut AS (SELECT DISTINCT doc_id, i + k AS p FROM later, (VALUES (0), (1), (2)) AS t(k)),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text FROM lines WHERE NOT EXISTS (SELECT 1 FROM cut WHERE cut.doc_id = lines.doc_id AND cut.p = lines.p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM cut GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
}
