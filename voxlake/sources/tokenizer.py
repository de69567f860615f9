"""Unknown tokens of texts under a vocabulary file of the tokenizers library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def token_counts(df: DataFrame, text: str, vocabulary: str, unknown: str = "[UNK]") -> DataFrame:
    """df with n_tokens and n_unknown."""
    schema = df.schema.simpleString()[len("struct<") : -1]
    columns = df.columns

    def work(batches):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        bad = tokenizer.token_to_id(unknown)
        for pdf in batches:
            ids = [e.ids for e in tokenizer.encode_batch([t or "" for t in pdf[text]], add_special_tokens=False)]
            pdf["n_tokens"] = [len(x) for x in ids]
            pdf["n_unknown"] = [x.count(bad) if bad is not None else 0 for x in ids]
            yield pdf

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema) if schema else ""
    return df.mapInPandas(work, f"{types}, n_tokens long, n_unknown long")


def token_gate(counted: DataFrame) -> DataFrame:
    """One row: tokens, unknown, median, p95 (by position) and max length, and ok (nothing unknown). Lengths are counted
    by value first, so that no list of all lengths is made."""
    from pyspark.sql import Window as W

    by_length = counted.groupBy("n_tokens").agg(F.count("*").alias("n"), F.sum("n_unknown").alias("unknown"))
    upto = F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("n_tokens"))
    total = F.sum("n").over(W.partitionBy(F.lit(0)))
    rows = by_length.withColumn("upto", upto).withColumn("total", total)
    at = lambda p: F.min(F.when(F.col("upto") > p, F.col("n_tokens")))  # noqa: E731  value at a 0-based position
    return rows.agg(F.sum(F.col("n_tokens") * F.col("n")).alias("tokens"), F.sum("unknown").alias("unknown"), at(F.floor(F.col("total") / 2)).alias("median"), at(F.floor(F.col("total") * 0.95)).alias("p95"), F.max("n_tokens").alias("longest")).withColumn("ok", F.col("unknown") == 0)
