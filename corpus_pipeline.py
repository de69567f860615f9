"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.

1. quality: documents that the additive model rejects (score below 0.5) go.
2. line_dedup: later occurrences of repeated three-line windows are cut out of the texts, n_chars follows; a document
   of which nothing is left goes.
3. near_dup: of each group of near-duplicates the document with the least id stays.
4. decontaminate: documents with a hit by a benchmark window of ten words go.
5. packing: what is left is packed into windows of 4096 tokens.

The classifier's and the tokenizer's steps have no SQL form, so ORACLE_SQL is None; the tests hold the stages against a
plain version on a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import materialise_at, scratch_mark, scratch_path, sweep
from voxlake.llm.decontaminate import contamination
from voxlake.llm.line_dedup import dedup_lines
from voxlake.llm.near_dup import drop_near_duplicates
from voxlake.llm.packing import pack_documents
from voxlake.llm.quality import quality_scores
from voxlake.llm.queries import quality_model, table, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality_scores(docs, quality_model(spark, docs, sf_dir))
    return scored.filter(F.col("score") >= 0.5).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = dedup_lines(docs, window=3)
    emptied = (F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.filter(~emptied).withColumn("n_chars", chars).select(*docs.columns)


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, threshold=85)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination(docs, table(spark, sf_dir, "benchmark"), window=10).filter("NOT contaminated").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=2, window=4096)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dup", near_dup), ("decontaminate", decontaminate), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed documents. A stage's scratch tables and its input go as soon as its output is written."""
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage_{name}")
        docs = materialise_at(out, path)
        sweep(spark, mark, keep=path)
    return STAGES[-1][1](spark, docs, sf_dir)
