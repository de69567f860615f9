"""Grouped statistics and per-clip signal metrics."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def stat_columns(name: str, value: Column) -> list[Column]:
    """n, mean, median, population sd, min and max of a metric; nulls are skipped."""
    return [F.count(value).alias(f"{name}_n"), F.avg(value).alias(f"{name}_mean"), F.median(value).alias(f"{name}_median"), F.stddev_pop(value).alias(f"{name}_std"), F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max")]


def stat_block(value: Column, places: int = 4) -> Column:
    """The same as one struct, rounded; null without any value."""
    parts = [F.count(value).alias("n")] + [F.round(c, places).alias(n) for n, c in (("mean", F.avg(value)), ("median", F.median(value)), ("std", F.stddev_pop(value)), ("min", F.min(value)), ("max", F.max(value)))]
    return F.when(F.count(value) > 0, F.struct(*parts))


def hours_by(clips: DataFrame, speaker: str, seconds: str) -> DataFrame:
    """(speaker, clips, hours, median, longest) of clip lengths in seconds."""
    return clips.groupBy(speaker).agg(F.count("*").alias("clips"), (F.sum(seconds) / 3600).alias("hours"), F.median(seconds).alias("median"), F.max(seconds).alias("longest"))


def summarise(rows: DataFrame, group: str, metrics: list[str], optional: list[str] | None = None, places: int = 4) -> DataFrame:
    """Statistics overall (name all) and for each group, with the failure rate over all rows. Optional metrics are left out
    when no row has a value, which takes a pass over the rows where some are named."""
    present = [c for c in (optional or []) if c in rows.columns]
    if present:
        seen = rows.agg(*[F.bool_or(F.col(c).isNotNull()).alias(c) for c in present]).first()
        present = [c for c in present if seen[c]]
    blocks = [stat_block(F.col(c), places).alias(c) for c in [*[m for m in metrics if m in rows.columns], *present]]
    failed = F.sum(F.coalesce(F.col("failed").cast("int"), F.lit(0))) / F.greatest(F.count("*"), F.lit(1))
    out = rows.groupingSets([[F.col(group)], []], F.col(group)).agg(F.grouping(group).alias("whole"), F.count("*").alias("clips"), failed.alias("failure_rate"), *blocks)
    return out.withColumn("name", F.when(F.col("whole") == 1, F.lit("all")).otherwise(F.col(group))).drop(group)


def upper_median(n: Column) -> Column:
    return F.floor(n / 2)


def p95_of_n(n: Column) -> Column:
    return F.floor(n * 0.95)


def p95_of_last(n: Column) -> Column:
    return F.floor((n - 1) * 0.95)


def percentiles(df: DataFrame, keys: list[str], value: str, positions: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(keys, one column for each position): the value at a 0-based position, which is a function of the number n of values,
    of a group's sorted values; nulls are skipped. Values are counted first, so a group costs its distinct values."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    group = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    rows = counts.withColumn("_upto", F.sum("_c").over(group.orderBy("_v").rowsBetween(W.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(group))
    return rows.groupBy(*keys).agg(*[F.min(F.when(F.col("_upto") > at(F.col("_n")), F.col("_v"))).alias(name) for name, at in positions.items()])


def cer_gap(rows: DataFrame, real: str, synthetic: str) -> Column:
    """What a row's synthetic speech costs in character error rate over the real one; null if one is missing."""
    return rows[synthetic] - rows[real]


def training_plan(*, rows: Column, batch: int, accumulate: int, epochs: int, seconds_per_step: Column, session_hours: float) -> list[Column]:
    """steps_per_epoch, hours for all epochs, and the sessions of `session_hours` that they need (at least one)."""
    steps = steps_per_epoch(rows, batch, accumulate)
    hours = steps * epochs * seconds_per_step / 3600
    return [steps.alias("steps_per_epoch"), hours.alias("total_hours"), F.greatest(F.lit(1), F.ceil(hours / session_hours)).alias("sessions")]


def steps_per_epoch(rows: Column, batch: int, accumulate: int = 1) -> Column:
    return F.greatest(F.lit(1), F.floor(rows / (batch * accumulate)))


# ---- signals: grouped NumPy code, for there is no SQL form ----


def dtw_path(a: np.ndarray, b: np.ndarray) -> tuple[float, list[tuple[int, int]]]:
    """Cost and path of the cheapest alignment of two sequences of vectors (Euclidean, steps 1-1, 1-0 and 0-1)."""
    cost = np.sqrt(np.maximum(((a[:, None, :] - b[None, :, :]) ** 2).sum(2), 0))
    n, m = cost.shape
    total = np.full((n + 1, m + 1), np.inf)
    total[0, 0] = 0
    for s in range(2, n + m + 1):  # anti-diagonals
        i = np.arange(max(1, s - m), min(n, s - 1) + 1)
        j = s - i
        total[i, j] = cost[i - 1, j - 1] + np.minimum(np.minimum(total[i - 1, j], total[i, j - 1]), total[i - 1, j - 1])
    path, i, j = [], n, m
    while i and j:
        path.append((i - 1, j - 1))
        options = ((total[i - 1, j - 1], i - 1, j - 1), (total[i - 1, j], i - 1, j), (total[i, j - 1], i, j - 1))
        _, i, j = min(options, key=lambda x: x[0])
    return float(total[n, m]), path[::-1]


def mel_bank(rate: int, size: int = 1024, bands: int = 80) -> np.ndarray:
    """Triangular filters, evenly spaced on the mel scale, each of unit area."""
    to_mel, to_hz = (lambda f: 2595 * np.log10(1 + f / 700)), (lambda m: 700 * (10 ** (m / 2595) - 1))
    edges = to_hz(np.linspace(0, to_mel(rate / 2), bands + 2))
    f = np.fft.rfftfreq(size, 1 / rate)
    up, down = (f - edges[:-2, None]) / np.diff(edges)[:-1, None], (edges[2:, None] - f) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def _frames(y: np.ndarray, size: int, hop: int) -> np.ndarray:
    y = np.pad(y, size // 2)
    n = 1 + (len(y) - size) // hop
    return y[np.arange(size)[None, :] + hop * np.arange(n)[:, None]]


def mel_power(y: np.ndarray, rate: int, size: int = 1024, hop: int = 256) -> np.ndarray:
    window = np.hanning(size + 1)[:-1]
    return (np.abs(np.fft.rfft(_frames(y, size, hop) * window)) ** 2) @ mel_bank(rate, size).T


def mel_cepstral_distortion(ref: np.ndarray, syn: np.ndarray, rate: int, coefficients: int = 13, hop: int = 256) -> float | None:
    """Aligned distance of natural-log mel cepstra without c0, with one floor for both signals; None for very short ones.
    The filter bank is this module's own, so values compare with each other and not with those of other programs."""
    if min(len(ref), len(syn)) < 4 * hop:
        return None
    a, b = mel_power(ref, rate, hop=hop), mel_power(syn, rate, hop=hop)
    floor = max(a.max(), b.max()) * 1e-8 or 1e-30
    n = a.shape[1]
    basis = np.cos(np.pi * np.arange(coefficients)[:, None] * (np.arange(n) + 0.5) / n) * np.sqrt(2 / n)
    x, y = ((np.log(np.maximum(m, floor)) @ basis.T)[:, 1:] for m in (a, b))
    _, path = dtw_path(x, y)
    i, j = np.array(path).T
    return float(10 / np.log(10) * np.sqrt(2) * np.sqrt(((x[i] - y[j]) ** 2).sum(1)).mean())


def pitch(y: np.ndarray, rate: int, low: float = 80.0, high: float = 500.0, hop: int = 256) -> np.ndarray:
    """Pitch of each frame by autocorrelation (a plain stand-in for a probabilistic tracker), nan where unvoiced."""
    size = int(2 ** np.ceil(np.log2(3 * rate / low)))
    frames = _frames(y, size, hop) * np.hanning(size)
    spectrum = np.fft.rfft(frames, 2 * size)
    auto = np.fft.irfft(np.abs(spectrum) ** 2)[:, :size]
    first, last = int(rate / high), int(rate / low) + 1
    part = auto[:, first:last]
    best = part.argmax(1) + first
    rows = np.arange(len(auto))
    left, mid, right = auto[rows, best - 1], auto[rows, best], auto[rows, np.minimum(best + 1, size - 1)]
    bend = left - 2 * mid + right
    shift = np.where(np.abs(bend) > 1e-12, 0.5 * (left - right) / np.where(bend == 0, 1, bend), 0)
    voiced = (auto[:, 0] > 1e-9) & (mid > 0.3 * auto[:, 0])
    return np.where(voiced, rate / (best + np.clip(shift, -1, 1)), np.nan)


def pitch_errors(a: np.ndarray, b: np.ndarray) -> tuple[float | None, float | None]:
    """(RMSE in cents, correlation of the logs) of two aligned pitch tracks over frames voiced in both."""
    both = ~np.isnan(a) & ~np.isnan(b)
    a, b = a[both], b[both]
    if len(a) < 10:
        return None, None
    rmse = float(np.sqrt(np.mean((1200 * np.log2(b / a)) ** 2)))
    return rmse, float(np.corrcoef(np.log(a), np.log(b))[0, 1]) if a.std() > 1e-6 and b.std() > 1e-6 else None


def clip_metrics(pairs: DataFrame, rate: int) -> DataFrame:
    """pairs (clip_id, ref and syn as array<float>) with mcd_db, f0_rmse_cents, f0_corr, voiced_frames and duration_ratio."""

    def work(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for name, r, s in zip(pdf["clip_id"], pdf["ref"], pdf["syn"], strict=True):
                r, s = (np.asarray(x if x is not None else [], np.float64) for x in (r, s))
                mcd = mel_cepstral_distortion(r, s, rate)
                rmse = corr = None
                voiced = 0
                if mcd is not None:
                    p, q = pitch(r, rate), pitch(s, rate)
                    n = min(len(p), len(q))
                    voiced = int((~np.isnan(p[:n]) & ~np.isnan(q[:n])).sum())
                    rmse, corr = pitch_errors(p[:n], q[:n])
                out.append((name, mcd, rmse, corr, voiced, len(s) / rate / max(len(r) / rate, 1e-6)))
            yield pd.DataFrame(out, columns=["clip_id", "mcd_db", "f0_rmse_cents", "f0_corr", "voiced_frames", "duration_ratio"])

    return pairs.select("clip_id", "ref", "syn").mapInPandas(work, "clip_id string, mcd_db double, f0_rmse_cents double, f0_corr double, voiced_frames long, duration_ratio double")


def dtw_distances(pairs: DataFrame, key: str, left: str, right: str, width: int) -> DataFrame:
    """(key, dtw): alignment cost of two arrays, read as sequences of vectors of `width` numbers."""

    def work(batches):
        import pandas as pd

        for pdf in batches:
            cost = [dtw_path(np.asarray(a, float).reshape(-1, width), np.asarray(b, float).reshape(-1, width))[0] for a, b in zip(pdf["a"], pdf["b"], strict=True)]
            yield pd.DataFrame({key: pdf[key], "dtw": cost})

    return pairs.select(key, F.col(left).alias("a"), F.col(right).alias("b")).mapInPandas(work, f"{key} long, dtw double")


def calibration(signals: DataFrame, rate: int) -> DataFrame:
    """(pair, mcd_db) for named pairs of signals (columns pair, ref, syn): landmarks that scores are read against."""
    return clip_metrics(signals.withColumnRenamed("pair", "clip_id"), rate).select(F.col("clip_id").alias("pair"), "mcd_db")


def first_rates(clips: DataFrame, seq: str, rate: str = "sample_rate", first: int = 200) -> DataFrame:
    """(rate, n): sample rates of the first rows only."""
    return clips.orderBy(seq).limit(first).groupBy(rate).agg(F.count("*").alias("n"))


def speaker_overview(scores: DataFrame, hours: DataFrame, sources: DataFrame, speaker: str = "speaker") -> DataFrame:
    """Each scored speaker with hours of audio and text source, null where unknown."""
    return scores.join(hours, speaker, "left").join(sources, speaker, "left")


def slim_tensors(tensors: DataFrame, kept: str, prefix: str, half: str = "float32") -> DataFrame:
    """A checkpoint's tensor list (name, dtype, n) without what `kept` (a pattern) does not match: the name without its
    prefix, the stored type when floats are halved, bytes before and after. The tensors themselves are not touched."""
    width = F.when(F.col("dtype") == "float64", 8).when(F.col("dtype").isin("float32", "int32"), 4).when(F.col("dtype").isin("float16", "bfloat16", "int16"), 2).when(F.col("dtype") == "int64", 8).otherwise(1)
    keep = F.col("name").rlike(kept)
    after = F.when(~keep, 0).when(F.col("dtype") == half, 2).otherwise(width)
    return tensors.select(F.when(keep, F.regexp_replace("name", f"^{prefix}", "")).alias("name"), "dtype", keep.alias("kept"), (F.col("n") * width).alias("bytes_before"), (F.col("n") * after).alias("bytes_after"))
