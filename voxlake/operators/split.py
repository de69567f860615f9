"""Reproducible splits and samples. Orders come from hashes of ids, so a split is the same on any number of machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.functions.text import interleave, with_full_stop, words


def seeded(id_col: Column, seed: int) -> Column:
    return F.xxhash64(id_col, F.lit(seed))


def train_eval_split(df: DataFrame, group: list[str], id_col: str, *, eval_size: int, seed: int = 0, order: Column | None = None) -> DataFrame:
    """df with is_eval: of each group the first min(eval_size, n // 10) rows by a seeded hash."""
    order = seeded(F.col(id_col), seed) if order is None else order
    n = F.count("*").over(W.partitionBy(*group))
    rank = F.row_number().over(W.partitionBy(*group).orderBy(order, id_col))
    return df.withColumn("is_eval", rank <= F.least(F.lit(eval_size), F.floor(n / 10)))


def first_per_group(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")


def thirds(df: DataFrame, value: Column, tie: list[str], keys: list[str] | None = None) -> DataFrame:
    """df with third (0, 1, 2): sizes t, t and the rest, with t = max(1, n // 3)."""
    keys = keys or []
    every = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    t = F.greatest(F.lit(1), F.floor(F.count("*").over(every) / 3))
    rank = F.row_number().over(every.orderBy(value, *tie))
    return df.withColumn("third", F.when(rank <= t, 0).when(rank <= 2 * t, 1).otherwise(2))


def balanced_sample(df: DataFrame, value: Column, id_col: str, *, per_third: int, limit: int, seed: int = 0, keys: list[str] | None = None) -> DataFrame:
    """Rows from each third by a seeded hash, then a seeded order over all of them, cut to `limit`."""
    drawn = first_per_group(thirds(df, value, [id_col], keys).withColumn("_h", seeded(F.col(id_col), seed)), [*(keys or []), "third"], ["_h", id_col], per_third)
    return drawn.orderBy(seeded(F.col(id_col), seed + 1), id_col).limit(limit).drop("_h")


def neighbour_pairs(df: DataFrame, group: list[str], order: list, columns: list[str]) -> DataFrame:
    """Rows 0 and 1, 2 and 3, ... of each group side by side: group, pair, columns as a_* and b_*."""
    w = W.partitionBy(*group).orderBy(*order)
    rows = df.withColumn("_k", F.row_number().over(w) - 1).withColumn("pair", F.floor(F.col("_k") / 2))
    even, odd = (F.col("_k") % 2 == 0), (F.col("_k") % 2 == 1)
    pick = [F.max(F.when(even, F.col(c))).alias(f"a_{c}") for c in columns] + [F.max(F.when(odd, F.col(c))).alias(f"b_{c}") for c in columns]
    return rows.groupBy(*group, "pair").agg(F.count("*").alias("_n"), *pick).filter("_n = 2").drop("_n")


def mixed_sentences(df: DataFrame, id_col: str, text: str, *, least: int = 5, most: int = 10, limit: int | None = None, seed: int = 0, order: Column | None = None) -> DataFrame:
    """Nonsense sentences for listening tests: pairs of sentences with equally many words, interleaved word by word."""
    order = seeded(F.col(id_col), seed) if order is None else order
    rows = df.select(F.col(id_col).alias("id"), words(F.col(text)).alias("ws"), order.alias("_o")).withColumn("n_words", F.size("ws")).filter(F.col("n_words").between(least, most))
    w = W.partitionBy("n_words").orderBy("_o", "id")
    rows = rows.withColumn("k", F.row_number().over(w) - 1)
    a = rows.filter("k % 2 = 0").select("n_words", F.col("k").alias("k0"), F.col("id").alias("a_id"), F.col("ws").alias("a"))
    b = rows.filter("k % 2 = 1").select("n_words", (F.col("k") - 1).alias("k0"), F.col("id").alias("b_id"), F.col("ws").alias("b"))
    out = a.join(b, ["n_words", "k0"]).select("n_words", "a_id", "b_id", with_full_stop(F.concat_ws(" ", interleave(F.col("a"), F.col("b")))).alias("sentence"))
    return out.orderBy(F.xxhash64("n_words", F.lit(seed)), "a_id").limit(limit) if limit else out


def conditioning_clip(clips: DataFrame, speaker: str, clip: str, seed: int = 0, order: Column | None = None) -> DataFrame:
    """Each clip with another clip of its speaker, drawn by a seeded order: the next one in a ring; null if it is alone."""
    w = W.partitionBy(speaker).orderBy(seeded(F.col(clip), seed) if order is None else order, clip)
    first = F.first(clip).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    other = F.coalesce(F.lead(clip).over(w), first)
    return clips.withColumn("conditioning", F.when(other != F.col(clip), other))


def ordered_distinct(df: DataFrame, value: str, seq: str) -> DataFrame:
    """Distinct values in the order in which they were first seen."""
    return df.groupBy(value).agg(F.min(seq).alias("first_seen")).orderBy("first_seen", value)


def longest_per_group(df: DataFrame, group: list[str], text: str, seq: str) -> DataFrame:
    """The row with the longest text of each group, the first of equals."""
    order = F.struct(-F.coalesce(F.char_length(text), F.lit(-1)), F.col(seq))
    return df.groupBy(*group).agg(F.min_by(F.struct(*[c for c in df.columns if c not in group]), order).alias("_first")).select(*group, "_first.*").select(*df.columns)
