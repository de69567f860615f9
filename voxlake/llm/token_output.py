"""Token-ID output: Parquet list columns made for selective reads.

Files hold, in ascending id order, one row for each document: doc_id, n_tokens, and the list column ids. Small metadata
columns are stored apart from the lists, so offsets and lengths are read without any ids; row groups have a fixed size,
pages carry the column index that Spark's writer adds, ids are dictionary-encoded and doc_id and n_tokens delta-encoded.

`read_tokens` reads the tokens of a range of documents, or the metadata alone: row groups and pages whose ids lie outside
are skipped by their statistics.

Defined results: null text is empty (its ids are the end id alone); null ids come first; rows with equal ids are
ordered by a hash of their text, and rows equal in both are interchangeable; an empty table gives an empty output; the
ids of a very long text are one list; other columns are not written.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.llm.common import bounded_batches, materialise, small_side
from voxlake.llm.tokens import encoder

#: Text bytes that go to one output file at least, however many cores there are.
FILE_BYTES = 24 << 20


def token_rows(docs: DataFrame, vocabulary: str, *, end_id: int | None, text_col: str = "text", slots: int = 1 << 20) -> DataFrame:
    """docs with ids and n_tokens in place of the text; order and partitions stay."""
    bounded_batches(docs.sparkSession, 256)
    keep = [c for c in docs.columns if c not in (text_col, "ids", "n_tokens")]
    source = docs.select(*keep, F.col(text_col).alias("text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["n_tokens long", "ids array<int>"])
    tail = [] if end_id is None else [end_id]

    def encoded(batches):
        encode = encoder(vocabulary, slots)
        for batch in batches:
            ids = encode(batch.column(len(keep)).to_pylist())
            flat = np.concatenate([x for own in ids for x in (own, np.array(tail, np.int32))] or [np.zeros(0, np.int32)])
            sizes = np.array([len(x) + len(tail) for x in ids], np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(sizes), lists], names=[*keep, "n_tokens", "ids"])

    return source.mapInArrow(encoded, schema)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, *, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", row_group_bytes: int = 8 << 20, page_rows: int = 2_000, file_bytes: int = 512 << 20, slots: int = 1 << 20) -> None:
    """Write docs' ids to `path` in ascending id order, one range of ids for each file.

    A file holds about `file_bytes` of text, less where that would leave cores without work.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    busy = max(FILE_BYTES, size // (4 * docs.sparkSession.sparkContext.defaultParallelism))
    files = max(1, math.ceil(size / min(file_bytes, busy)))
    tie = F.xxhash64(text_col)
    ranged = docs.select(id_col, text_col).repartitionByRange(files, F.col(id_col), tie).sortWithinPartitions(F.col(id_col), tie)
    rows = token_rows(ranged, vocabulary, end_id=end_id, text_col=text_col, slots=slots).withColumnRenamed(id_col, "doc_id").withColumn("file", F.spark_partition_id())
    rows.write.options(**{
        "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": row_group_bytes, "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false", "parquet.enable.dictionary#n_tokens": "false",
    }).parquet(path)


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, start, file) from the metadata columns alone."""
    rows = spark.read.parquet(path).select("doc_id", "n_tokens", "file").withColumn("row", F.col("_metadata.row_index"))
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    # one row for each file, that is for each hundreds of megabytes
    before = sums.select("file", F.coalesce(F.sum("total").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("n_tokens").over(W.partitionBy("file").orderBy("row").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("inside", inside).join(small_side(materialise(before, "before")), "file").select("doc_id", "n_tokens", (F.col("before") + F.col("inside")).alias("start"), "file", "row")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, *, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The given columns of documents first to last (both included; None: open)."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    return (rows if last is None else rows.filter(F.col("doc_id") <= last)).select(*columns)


def checksum(values: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(values, "<u4").tobytes())


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(file, row, n_ids, ids_crc32) from the list column."""
    rows = spark.read.parquet(path).select("file", F.col("_metadata.row_index").alias("row"), "ids")

    def summed(batches):
        for batch in batches:
            lists = batch.column(2)
            flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            crc = [checksum(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], names=["file", "row", "n_ids", "ids_crc32"])

    return rows.mapInArrow(summed, "file int, row long, n_ids long, ids_crc32 long")


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    found = read_checksums(spark, path)
    return read_offsets(spark, path).join(found, ["file", "row"]).select("doc_id", "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")
