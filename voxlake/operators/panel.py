"""Listening panels: responses joined to the answer key, ratings pooled and by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.functions.numbers import digits_only
from voxlake.functions.text import strip, word_accuracy


def clean_responses(raw: DataFrame) -> DataFrame:
    """Responses with a rater; a missing group is sighted; ratings are integers or null. `seq` is the order of reading."""
    text = lambda c: strip(F.coalesce(F.col(c), F.lit("")))
    return raw.filter(text("rater") != "").select(
        "seq", text("rater").alias("rater"), strip(F.coalesce(F.col("group"), F.lit("sighted"))).alias("group"), "part", text("item").alias("item"),
        digits_only(text("intelligibility")).alias("intelligibility"), digits_only(text("naturalness")).alias("naturalness"), text("transcript").alias("transcript"),
    )


def pooled(rows: DataFrame, group: str, *columns: Column) -> DataFrame:
    """columns (aggregates, aliased) for each group, and for all rows under the name all."""
    out = rows.groupingSets([[F.col(group)], []], F.col(group)).agg(F.grouping(group).alias("_whole"), *columns)
    return out.withColumn(group, F.when(F.col("_whole") == 1, F.lit("all")).otherwise(F.col(group))).drop("_whole")


def rating_block(value: Column, scale: int = 5) -> list[Column]:
    """n, mean, per cent of the scale, population sd."""
    return [F.count(value).alias("n"), F.avg(value).alias("mean"), (100 * F.avg(value) / scale).alias("percent"), F.stddev_pop(value).alias("sd")]


def ratings(responses: DataFrame, field: str) -> DataFrame:
    return pooled(responses.filter((F.col("part") == "MOS") & F.col(field).isNotNull()), "group", *rating_block(F.col(field)))


def scored_transcripts(responses: DataFrame, key: DataFrame) -> DataFrame:
    """Transcribed items with accuracy; the key (part, item, sinhala) has one row for each item of a panel."""
    refs = key.filter("part = 'SUS'").select(F.col("item").cast("string").alias("item"), "sinhala")
    heard = responses.filter((F.col("part") == "SUS") & (F.col("transcript") != ""))
    return heard.join(refs, "item").withColumn("accuracy", word_accuracy(F.col("sinhala"), F.col("transcript")))


def rater_groups(responses: DataFrame) -> DataFrame:
    """(group, raters): raters by the group that they gave last."""
    last = responses.groupBy("rater").agg(F.max_by("group", "seq").alias("group"))
    return last.groupBy("group").agg(F.count("*").alias("raters"))


def disagreement(rows: DataFrame, item: str, value: str, *, over: int = 2, top: int = 5) -> DataFrame:
    """Items with more than `over` ratings and the largest population sd."""
    return rows.groupBy(item).agg(F.count(value).alias("n"), F.stddev_pop(value).alias("sd")).filter(F.col("n") > over).orderBy(F.desc("sd"), item).limit(top)


def least_intelligible(rows: DataFrame, item: str, value: str, *, top: int = 5) -> DataFrame:
    return rows.groupBy(item).agg(F.avg(value).alias("mean")).orderBy("mean", item).limit(top)


def manifest_durations(kept: DataFrame, manifest: DataFrame, key: str = "clip_id", seq: str = "seq") -> DataFrame:
    """Kept clips with their duration from the manifest; of rows of one clip the last by `seq` counts. Clips that the manifest
    does not have go."""
    last = manifest.groupBy(key).agg(F.max_by("duration", seq).alias("duration"))
    return kept.join(last, key)
