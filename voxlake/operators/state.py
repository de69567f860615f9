"""Resumable work as tables: what is done, what is cached, what an earlier output brings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.functions.numbers import expected_chunks


def episode_state(plan: DataFrame, markers: DataFrame, manifests: DataFrame, cached: DataFrame, key: str = "episode", chunk: float = 300.0) -> DataFrame:
    """plan (key, length) with status: done (marked), backfill (a manifest and enough cached chunks: mark it), redo."""
    n = cached.groupBy(key).agg(F.count("*").alias("n_cached"))
    out = plan.join(markers.select(key).distinct().withColumn("marked", F.lit(True)), key, "left").join(manifests.select(key).distinct().withColumn("written", F.lit(True)), key, "left").join(n, key, "left")
    enough = F.coalesce("n_cached", F.lit(0)) >= expected_chunks(F.coalesce(F.col("length").try_cast("double"), F.lit(0.0)), chunk)
    status = F.when(F.col("marked"), "done").when(F.col("written") & enough, "backfill").otherwise("redo")
    return out.select(*plan.columns, F.coalesce("n_cached", F.lit(0)).alias("n_cached"), status.alias("status"))


def episode_counts(episodes: DataFrame, failed_chunks: DataFrame, key: str = "episode") -> DataFrame:
    """One row: complete and partial episodes (one of whose chunks failed)."""
    failed = failed_chunks.select(key).distinct().withColumn("_failed", F.lit(True))
    marked = episodes.select(key).distinct().join(failed, key, "left")
    return marked.agg(F.count_if(F.col("_failed").isNull()).alias("complete"), F.count_if("_failed").alias("partial"))


def open_work(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is not done yet."""
    return plan.join(done.select(*keys).distinct(), keys, "left_anti")


def fill_cache(chunks: DataFrame, cache: DataFrame, keys: list[str], call: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Cached replies, and fresh ones from `call` for chunks without a valid one. A reply that is not JSON counts as missing;
    of several replies to one chunk (a task that was run again writes its own) the least one counts."""
    valid = cache.filter(F.try_parse_json("reply").isNotNull()).groupBy(*keys).agg(F.min("reply").alias("reply"))
    hit = chunks.join(valid, keys)
    miss = chunks.join(valid, keys, "left_anti")
    return hit.unionByName(call(miss).select(*hit.columns))


def plan_estimate(units: DataFrame, done: DataFrame, keys: list[str], chunk: float = 300.0) -> DataFrame:
    """One row: total, skipped, hours and requests of what is left. Lengths that are no numbers count as nought."""
    length = F.coalesce(F.col("length").try_cast("double"), F.lit(0.0))
    marked = units.join(done.select(*keys).distinct().withColumn("_done", F.lit(True)), keys, "left")
    left = F.col("_done").isNull()
    return marked.agg(
        F.count("*").alias("total"), F.count_if(~left).alias("skipped"), F.coalesce(F.sum(F.when(left, length)), F.lit(0.0)).alias("seconds"),
        F.coalesce(F.sum(F.when(left, expected_chunks(length, chunk))), F.lit(0)).alias("requests"),
    ).select("total", "skipped", (F.col("seconds") / 3600).alias("hours"), "requests")


def adopt(found: DataFrame, present: DataFrame, key: str = "episode", keep: str = "first") -> DataFrame:
    """One directory for each episode found in earlier outputs (the first or the last by path), without those present."""
    pick = F.min_by if keep == "first" else F.max_by
    one = found.groupBy(key).agg(pick(F.struct(*[c for c in found.columns if c != key]), "path").alias("_one")).select(key, "_one.*").select(*found.columns)
    return one.join(present.select(key).distinct(), key, "left_anti")


def directories_with(files: DataFrame, pattern: str) -> DataFrame:
    """(dir, n): directories that directly hold a file of a pattern, at any depth."""
    return files.filter(F.col("path").rlike(pattern)).groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("dir")).agg(F.count("*").alias("n"))


def union_manifests(frames: list[DataFrame]) -> DataFrame:
    """All manifests by column name; missing columns are null, then quality is hifi and snapped True."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    for column, default in (("quality", "hifi"), ("snapped", "True")):
        if column in out.columns:
            out = out.withColumn(column, F.coalesce(F.col(column), F.lit(default)))
    return out


def manifest_summary(clips: DataFrame) -> DataFrame:
    """One row: clips, hours, hours by quality, unsnapped."""
    d = F.col("duration").try_cast("double")
    return clips.agg(
        F.count("*").alias("clips"), (F.sum(d) / 3600).alias("hours"), (F.sum(F.when(F.col("quality") == "hifi", d)) / 3600).alias("hifi_hours"),
        (F.sum(F.when(F.col("quality") == "lofi", d)) / 3600).alias("lofi_hours"), F.count_if(F.col("snapped") != "True").alias("unsnapped"),
    )
