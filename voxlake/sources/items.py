"""Source items behind narrow interfaces: search, metadata, downloads, archives, keys, quota probes and checks before a run.

What touches the network or secrets is a callable that the caller hands in; its answers become DataFrames."""

from __future__ import annotations

import os
import shutil
import tarfile
from collections.abc import Callable, Iterable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METADATA = "metadata struct<identifier:string,licenseurl:string>, files array<struct<name:string,source:string,size:string,length:string>>"


def planned_items(spark: SparkSession, configured: Iterable[str], search: Callable[[str, int], list[str]], query: str, rows: int) -> DataFrame:
    """(identifier, seq): configured ids first, then those found, each once and in order."""
    ids = [*configured, *(search(query, rows) if query else [])]
    frame = spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "identifier string, seq int")
    return frame.groupBy("identifier").agg(F.min("seq").alias("seq")).orderBy("seq")


def item_files(documents: DataFrame) -> DataFrame:
    """(identifier, licence, name, source, size, length, seq) of items' metadata documents (identifier, document); an item
    without files or with broken JSON has no rows."""
    parsed = documents.withColumn("m", F.from_json("document", METADATA))
    rows = parsed.select("identifier", F.col("m.metadata.licenseurl").alias("licence"), F.posexplode("m.files").alias("seq", "f"))
    return rows.select("identifier", "licence", "f.name", "f.source", "f.size", "f.length", "seq")


def work_units(files: DataFrame) -> DataFrame:
    """(identifier, name, length): what is to be built; lengths that are no numbers are null."""
    return files.select("identifier", "name", F.col("length").try_cast("double").alias("length"))


def download(read: Callable[[], Iterable[bytes]], target: Path) -> Path:
    """The blocks of `read` in a file, which appears only when it is whole; a file that is there and not empty stays."""
    if target.is_file() and target.stat().st_size:
        return target
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    try:
        with part.open("wb") as f:
            for block in read():
                f.write(block)
        os.replace(part, target)
    finally:
        part.unlink(missing_ok=True)
    return target


def unpack(archive: Path, target: Path) -> Path:
    """A tar archive's files below `target`; names that lead outside are refused."""
    with tarfile.open(archive) as t:
        t.extractall(target, filter="data")
    return target


def publish(rows: Iterable[tuple[str, str]]) -> int:
    """Link (or else copy) source files to their targets; those that exist are left. Returns how many were made."""
    made = 0
    for source, target in rows:
        if os.path.exists(target):
            continue
        os.makedirs(os.path.dirname(target), exist_ok=True)
        try:
            os.link(source, target)
        except OSError:
            shutil.copyfile(source, target)
        made += 1
    return made


def api_keys(environment: Mapping[str, str], names: Iterable[str], files: Iterable[Path] = ()) -> list[str]:
    """Keys from variables (comma-separated) and files (one a line, # begins a comment), each once and in order."""
    found = [k for n in names for k in environment.get(n, "").split(",")]
    for f in files:
        if f.is_file():
            found += [line.split("#")[0] for line in f.read_text(encoding="utf-8-sig").splitlines()]
    return list(dict.fromkeys(k.strip() for k in found if k.strip()))


def quota_probe(spark: SparkSession, keys: list[str], models: list[str], ask: Callable[[str, str], str | None]) -> DataFrame:
    """(key, model, ok, delay, daily) for each pair; `ask` returns None if a call went through, else the error's JSON."""
    from voxlake.functions.numbers import is_daily_quota, retry_delay

    rows = [(i, m, ask(k, m)) for i, k in enumerate(keys) for m in models]
    frame = spark.createDataFrame(rows, "key int, model string, error string")
    return frame.select("key", "model", F.col("error").isNull().alias("ok"), retry_delay(F.col("error")).alias("delay"), is_daily_quota(F.col("error")).alias("daily"))


def preflight(checks: Mapping[str, Callable[[], object]]) -> list[tuple[str, bool, str]]:
    """(name, ok, detail) of each check; an exception is a failure and does not stop the others."""
    out = []
    for name, check in checks.items():
        try:
            got = check()
            out.append((name, got is not False, "" if isinstance(got, bool) or got is None else str(got)))
        except Exception as e:  # whatever a check finds is its answer
            out.append((name, False, f"{type(e).__name__}: {e}"))
    return out


def disk_guard(path: str, least_gb: float) -> bool:
    return shutil.disk_usage(path).free >= least_gb * 1e9


def curves_svg(points: Iterable[tuple[str, float, float]], width: int = 800, height: int = 400) -> str:
    """Loss curves (series, step, value) as an SVG picture, one line for each series; nan is left out."""
    by_series: dict[str, list] = {}
    for series, step, value in points:
        if value is not None and value == value:
            by_series.setdefault(series, []).append((float(step), float(value)))
    every = [p for own in by_series.values() for p in own] or [(0.0, 0.0)]
    (x0, x1), (y0, y1) = ((min(p[k] for p in every), max(p[k] for p in every)) for k in (0, 1))
    place = lambda p: f"{(p[0] - x0) / ((x1 - x0) or 1) * width:.1f},{height - (p[1] - y0) / ((y1 - y0) or 1) * height:.1f}"
    lines = "".join(f'<polyline class="{s}" fill="none" stroke="{c}" points="{" ".join(place(p) for p in sorted(own))}"/>' for (s, own), c in zip(sorted(by_series.items()), ("#1f77b4", "#d62728", "#2ca02c", "#9467bd") * len(by_series), strict=False))
    return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {width} {height}">{lines}</svg>'
