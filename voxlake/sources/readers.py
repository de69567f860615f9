"""Readers: manifests, raw pipe text, JSON documents, logs, rater files, audio headers and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.functions.text import path_stem


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The combined manifest if there is one, else all per-episode manifests; strings throughout, byte order mark stripped,
    columns that a file lacks are null; missing quality is hifi and missing snapped True."""
    combined = f"{root.rstrip('/')}/all_manifests.csv"
    paths = [combined] if _exists(spark, combined) else f"{root.rstrip('/')}/*/manifest.csv"
    df = _csv(spark, paths)
    for column, default in (("quality", "hifi"), ("snapped", "True")):
        df = df.withColumn(column, F.coalesce(F.col(column), F.lit(default)) if column in df.columns else F.lit(default))
    return df


def _csv(spark: SparkSession, paths) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(paths)


def read_manifests(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Several manifests by column name; those that can't be read are skipped. None if none can."""
    out = None
    for p in sorted(paths):
        try:
            df = _csv(spark, p)
        except Exception as e:  # a missing or broken file must not stop the others
            if "PATH_NOT_FOUND" not in str(e) and "Malformed" not in str(e):
                raise
            continue
        if not df.columns:
            continue
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_pipe_rows(spark: SparkSession, path: str, least: int = 4) -> DataFrame:
    """(clip_id, roman, script, speaker) of headerless pipe text without quoting; lines of fewer fields go."""
    cells = spark.read.text(path).select(F.split("value", r"\|", -1).alias("c")).filter(F.size("c") >= least)
    return cells.select(*[F.trim(F.get("c", F.lit(i))).alias(n) for i, n in enumerate(("clip_id", "roman", "script", "speaker"))])


def read_lines(spark: SparkSession, path: str, key: str = "file") -> DataFrame:
    """(file, line_no, line) of whole text files, in their order."""
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.col("_metadata.file_path").alias(key), F.regexp_replace("value", "^﻿", "").alias("value"))
    lines = whole.select(key, F.posexplode(F.split("value", r"\r\n|\r|\n", -1)).alias("line_no", "line"))
    return lines.select(key, F.col("line_no").cast("long").alias("line_no"), "line")


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path, "log_id")


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """(file, document): the text of each JSON file at any depth, null where it is invalid; no rows for a missing path."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "file string, document string")
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("file"), F.when(F.try_parse_json("value").isNotNull(), F.col("value")).alias("document"))


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_chunk_cache(spark: SparkSession, path: str) -> DataFrame:
    """(episode, chunk, reply) of cached replies, episode/chunk_NNN.json; files that hold no JSON are left out, so they are
    fetched again (and can be found by `broken_chunks`)."""
    docs = read_json_document(spark, path).filter("document IS NOT NULL")
    return docs.select(*_chunk_name(), F.col("document").alias("reply"))


def broken_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(episode, chunk, file) of cached files that hold no JSON, for deletion."""
    return read_json_document(spark, path).filter("document IS NULL").select(*_chunk_name(), "file")


def _chunk_name():
    name = r"([^/]+)/(?:[^/]*_)?chunk_(\d+)[^/]*$"
    return F.url_decode(F.regexp_extract("file", name, 1)).alias("episode"), F.regexp_extract("file", name, 2).cast("int").alias("chunk")


def read_responses(spark: SparkSession, paths) -> DataFrame:
    """Rater files as strings with seq, which follows file name and row."""
    df = _csv(spark, paths).select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_row"))
    from pyspark.sql import Window as W

    return df.withColumn("seq", F.row_number().over(W.partitionBy("file").orderBy("_row"))).withColumn("seq", F.struct("file", "seq")).drop("_row")


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of files at any depth; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def default_audio(files: DataFrame, extensions=("mp3", "wav", "flac", "ogg", "m4a")) -> DataFrame:
    """The first file by extension, then by path."""
    rank = F.array_position(F.array(*[F.lit(x) for x in extensions]), F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)))
    return files.withColumn("rank", rank).filter("rank > 0").orderBy("rank", "path").limit(1).drop("rank")


#: Bytes of a file that its header is looked for in.
HEAD = 4096


def wav_headers(spark: SparkSession, root: str) -> DataFrame:
    """(path, clip_id, frames, rate, seconds) of wav files from their first bytes; seconds is null for what can't be read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(root)

    def probe(batches):
        import struct

        import pandas as pd

        for pdf in batches:
            rows = []
            for path, length, head in zip(pdf["path"], pdf["length"], pdf["head"], strict=True):
                frames = rate = None
                try:
                    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
                        raise ValueError
                    at, width = 12, None
                    while at + 8 <= len(head):
                        kind, n = struct.unpack("<4sI", head[at : at + 8])
                        if kind == b"fmt ":
                            _, channels, rate, _, width, _ = struct.unpack("<HHIIHH", head[at + 8 : at + 24])
                        elif kind == b"data" and width:
                            frames = min(n, length - at - 8) // width
                            break
                        at += 8 + n + n % 2
                except (ValueError, struct.error):
                    rate = None
                rows.append((path, frames if rate else None, rate if frames is not None else None))
            yield pd.DataFrame(rows, columns=["path", "frames", "rate"])

    probed = files.select("path", "length", F.expr(f"substring(content, 1, {HEAD})").alias("head")).mapInPandas(probe, "path string, frames long, rate long")
    return probed.withColumn("clip_id", path_stem(F.col("path"))).withColumn("seconds", F.try_divide(F.col("frames"), F.col("rate")))


def read_audio(spark: SparkSession, root: str, pattern: str = "*.wav") -> DataFrame:
    """(path, samples array<float>, rate): PCM wav files as mono samples between -1 and 1."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)

    def decode(batches):
        import io
        import wave

        import numpy as np
        import pandas as pd

        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with wave.open(io.BytesIO(content)) as w:
                        width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
                        raw = w.readframes(w.getnframes())
                    if width == 3:
                        x = np.frombuffer(raw, np.uint8).reshape(-1, 3)
                        x = ((x[:, 0].astype(np.int32) << 8) | (x[:, 1].astype(np.int32) << 16) | (x[:, 2].astype(np.int32) << 24)) / 2**31
                    else:
                        x = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128 if width == 1 else np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]) / 2.0 ** (8 * width - 1)
                    rows.append((path, x.reshape(-1, channels).mean(1).astype(np.float32), rate))
                except (wave.Error, EOFError, KeyError, ValueError):
                    rows.append((path, None, None))
            yield pd.DataFrame(rows, columns=["path", "samples", "rate"])

    return files.select("path", "content").mapInPandas(decode, "path string, samples array<float>, rate long")


def cut_audio(audio: DataFrame, offset: float = 0.0, duration: float | None = None) -> DataFrame:
    """(path, samples, rate) cut to `duration` seconds from `offset` on."""
    first = F.floor(F.lit(offset) * F.col("rate")).cast("int")
    size = F.size("samples") if duration is None else F.floor(F.lit(duration) * F.col("rate")).cast("int")
    return audio.withColumn("samples", F.slice("samples", first + 1, F.greatest(size, F.lit(0))))


def cached_audio(spark: SparkSession, root: str, cache: str, *, offset: float = 0.0, duration: float | None = None) -> DataFrame:
    """Decoded audio, kept as Parquet by file, offset and duration: what the cache lacks is decoded and added, so new files
    are found, and other cuts of a file do not meet. A cut that is decoded twice at once counts once."""
    kept = F.lit(-1.0 if duration is None else float(duration))
    own = (F.col("offset") == F.lit(float(offset))) & (F.col("duration") == kept)
    files = list_files(spark, root, "*.wav").select("path")
    there = spark.read.parquet(cache).filter(own) if _exists(spark, f"{cache.rstrip('/')}/_SUCCESS") else None
    missing = files if there is None else files.join(there.select("path"), "path", "left_anti")
    if not missing.isEmpty():
        fresh = cut_audio(read_audio(spark, root).join(missing, "path", "left_semi"), offset, duration)
        fresh.withColumn("offset", F.lit(float(offset))).withColumn("duration", kept).write.mode("append").parquet(cache)
    rows = spark.read.parquet(cache).filter(own).join(files, "path", "left_semi")
    return rows.select("path", "samples", "rate").dropDuplicates(["path"])
