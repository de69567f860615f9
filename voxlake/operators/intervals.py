"""Speech intervals: chunking, ownership, merging, trimming, padding and checks.

Every function works per key (an episode, or episode and chunk), takes its order from columns and keeps all keys apart, so
the work spreads over the keys. Where a row depends on decisions taken before it, sorted rows are streamed through a fold
whose state is the last row or two, so a key of any length needs no more memory than a short one (snap holds one key's).
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voxlake import reach_workers
from voxlake.functions.numbers import exact_round

MIN_CLIP, MAX_CLIP, MERGE_GAP, PAD = 3.0, 30.0, 0.6, 0.1


def _streamed(rows: DataFrame, keys: list[str], order: list[str], fold: Callable[[Iterator[tuple]], Iterator[tuple]], added: str) -> DataFrame:
    """Keys and `added` columns: `fold` gets the rest of each key's rows, sorted, and yields rows of the added columns."""
    reach_workers(rows.sparkSession)
    kept = rows.select(*keys).schema
    schema = StructType([*kept.fields, *StructType.fromDDL(added).fields])
    types, n = to_arrow_schema(schema), len(keys)

    def run(batches):
        each = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out = []
        for key, own in groupby(each, key=lambda r: r[:n]):
            for r in fold(x[n:] for x in own):
                out.append(key + r)
                if len(out) == 8192:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=types)
                    out = []
        columns = zip(*out, strict=True) if out else [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, types, strict=True)], schema=types)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def chunk_regions(regions: DataFrame, keys: list[str], *, start: str = "start", end: str = "end", target: float = 300.0) -> DataFrame:
    """(keys, chunk, c0, c1, n_regions): a new chunk begins where a region's end would lie over `target` from the chunk's
    start. Regions without start or end are left out."""

    def fold(rows):
        chunk, c0, c1, n = 0, None, None, 0
        for s, e in rows:
            if c0 is not None and e - c0 > target:
                yield chunk, c0, c1, n
                chunk, c0, n = chunk + 1, None, 0
            c0, c1, n = (s if c0 is None else c0), e, n + 1
        if n:
            yield chunk, c0, c1, n

    rows = regions.select(*keys, F.col(start).cast("double").alias("_s"), F.col(end).cast("double").alias("_e")).filter("_s IS NOT NULL AND _e IS NOT NULL")
    return _streamed(rows, keys, ["_s", "_e"], fold, "chunk int, c0 double, c1 double, n_regions long")


def regions_in_chunks(chunks: DataFrame, regions: DataFrame, keys: list[str], *, start: str = "start", end: str = "end") -> DataFrame:
    """Regions that overlap each chunk (ends excluded): an equi-join on the keys with the range as the rest."""
    c, r = chunks.alias("c"), regions.alias("r")
    on = [F.col(f"c.{k}") == F.col(f"r.{k}") for k in keys] + [F.col(f"r.{end}") > F.col("c.c0"), F.col(f"r.{start}") < F.col("c.c1")]
    condition = on[0]
    for x in on[1:]:
        condition = condition & x
    return c.join(r, condition).select(*[F.col(f"c.{k}").alias(k) for k in keys], "c.chunk", "c.c0", "c.c1", F.col(f"r.{start}").alias(start), F.col(f"r.{end}").alias(end))


def valid_items(replies: DataFrame, keys: list[str], reply: str, c0: Column, c1: Column) -> DataFrame:
    """Proposed sentences of a reply: each item on its own must have numeric times, text and a positive length; times are
    moved by the chunk's start and clamped into it. NaN times are rejected."""
    from voxlake.functions.numbers import json_list
    from voxlake.functions.text import strip

    item = F.from_json("item", "start_sec string, end_sec string, text string")
    rows = replies.select(*keys, c0.cast("double").alias("c0"), c1.cast("double").alias("c1"), F.posexplode(json_list(F.col(reply))).alias("seq", "item"))
    number = lambda c: F.when(~F.isnan(c.try_cast("double")), c.try_cast("double"))
    rows = rows.withColumn("i", item).select(*keys, "c0", "c1", "seq", (number(F.col("i.start_sec")) + F.col("c0")).alias("s"), (number(F.col("i.end_sec")) + F.col("c0")).alias("e"), strip(F.col("i.text")).alias("text"))
    rows = rows.filter((F.col("text") != "") & (F.col("e") > F.col("s")))
    clamped = rows.select(*keys, "c0", "c1", "seq", F.greatest("s", "c0").alias("start"), F.least("e", "c1").alias("end"), "text")
    return clamped.filter(F.col("end") > F.col("start"))


def snap(sentences: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Sentences (keys, start, end, text) with the span of the regions (keys, start, end) that each one wins.

    Regions go by time. A region is won by the sentence from the current one on that it overlaps most (the first of equals);
    that one is current from then on. A region without overlap is left out. A sentence without a region keeps its own span
    and gets snapped = false. Rows without start or end are left out. Returns keys, start, end, text, snapped, n_regions.
    """
    def own(rows):
        said, found = [], []
        for kind, a, b, text in rows:
            (found if kind else said).append((a, b, text))
        starts, ends, current = [s[0] for s in said], [s[1] for s in said], 0
        won: list[list] = [[] for _ in said]
        for a, b, _ in found:
            reach = bisect.bisect_right(starts, b, lo=current)
            shared = [min(b, ends[i]) - max(a, starts[i]) for i in range(current, reach)]
            if shared and max(shared) > 0:
                current += shared.index(max(shared))
                won[current].append((a, b))
        for (s, e, text), w in zip(said, won, strict=True):
            yield w[0][0] if w else s, w[-1][1] if w else e, text, bool(w), len(w)

    kinds = [rows.select(*keys, F.lit(k).alias("_kind"), F.col("start").cast("double").alias("_s"), F.col("end").cast("double").alias("_e"), text.alias("_t")) for k, rows, text in ((0, sentences, F.col("text")), (1, regions, F.lit(None).cast("string")))]
    rows = kinds[0].unionByName(kinds[1]).filter("_s IS NOT NULL AND _e IS NOT NULL")
    return _streamed(rows, keys, ["_kind", "_s", "_e", "_t"], own, "`start` double, `end` double, text string, snapped boolean, n_regions long")


def merge_short(sentences: DataFrame, keys: list[str], *, least: float = MIN_CLIP, most: float = MAX_CLIP, gap: float = MERGE_GAP) -> DataFrame:
    """Neighbours joined while one of them is short, the result fits and the pause is small. The left side of every test is
    the merged row so far. Returns keys, seq, start, end, text, snapped."""

    def fold(rows):
        seq, last = 0, None
        for s, e, t, ok in rows:
            if last is not None:
                a, b, text, fine = last
                if (b - a < least or e - s < least) and e - a <= most and 0 <= s - b <= gap:
                    both = False if fine is False or ok is False else None if fine is None or ok is None else True
                    last = a, e, None if text is None or t is None else f"{text} {t}".strip(" "), both
                    continue
                yield (seq, *last)
                seq += 1
            last = s, e, t, ok
        if last is not None:
            yield (seq, *last)

    rows = sentences.select(*keys, F.col("start").cast("double").alias("_s"), F.col("end").cast("double").alias("_e"), F.col("text").alias("_t"), F.col("snapped").alias("_ok")).filter("_s IS NOT NULL AND _e IS NOT NULL")
    return _streamed(rows, keys, ["_s", "_e", "_t", "_ok"], fold, "seq int, `start` double, `end` double, text string, snapped boolean")


def trim_overlap(spans: DataFrame, keys: list[str], *, start: str = "start", end: str = "end", tie: list[str] | None = None) -> DataFrame:
    """spans with `end` moved to the next start where it lies beyond, and trimmed (was it). Starts never change, so a
    window is exact."""
    w = W.partitionBy(*keys).orderBy(start, end, *(tie or []))
    following = F.lead(start).over(w)
    return spans.withColumn("trimmed", F.coalesce(F.col(end) > following, F.lit(False))).withColumn(end, F.least(F.col(end), following))


def dedupe_spans(spans: DataFrame, keys: list[str], *, start: str = "start", end: str = "end", tie: list[str] | None = None, places: int = 2) -> DataFrame:
    """The first of the spans whose rounded start and end are equal."""
    nearest = exact_round(places)
    w = W.partitionBy(*keys, "_rs", "_re").orderBy(start, end, *(tie or []))
    rows = spans.withColumn("_rs", nearest(F.col(start).cast("double"))).withColumn("_re", nearest(F.col(end).cast("double")))
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_rs", "_re")


def in_band(start: Column, end: Column, least: float = MIN_CLIP, most: float = MAX_CLIP) -> Column:
    return (end - start).between(least, most)


def pad_clips(spans: DataFrame, keys: list[str], total: Column, *, pad: float = PAD, least: float = MIN_CLIP, tie: list[str] | None = None) -> DataFrame:
    """Trimmed, ordered spans with clip_index (before drops), and a, b: the span padded up to its neighbours and the file's
    end. Spans that come out shorter than `least` go. Input must not overlap (see trim_overlap) and must be in the length
    band already, so that only the file's end can make a span too short; for other input there is pad_clips_fold."""
    w = W.partitionBy(*keys).orderBy("start", "end", *(tie or []))
    rows = spans.withColumn("clip_index", F.row_number().over(w) - 1).withColumn("b", F.least(total, F.coalesce(F.lead("start").over(w), total), F.col("end") + pad))
    rows = rows.withColumn("a", F.greatest(F.lit(0.0), F.coalesce(F.lag("b").over(w), F.lit(0.0)), F.col("start") - pad))
    return rows.filter(F.col("b") - F.col("a") >= least)


def pad_clips_fold(spans: DataFrame, keys: list[str], total: str, *, id_col: str, pad: float = PAD, least: float = MIN_CLIP) -> DataFrame:
    """The same for spans of any length: a span that is dropped takes nothing from the next one's room. Returns keys, id_col,
    clip_index, a, b. `total` names a column that is the same for all rows of a key."""

    def fold(rows):
        last, held = 0.0, None
        for i, x in enumerate(chain(rows, [None])):
            if held is not None:
                s, e, name, whole = held
                a, b = max(0.0, last, s - pad), min(whole, whole if x is None else x[0], e + pad)
                if b - a >= least:
                    last = b
                    yield name, i - 1, a, b
            held = x

    rows = spans.select(*keys, F.col("start").cast("double").alias("_s"), F.col("end").cast("double").alias("_e"), F.col(id_col).alias("_id"), F.col(total).cast("double").alias("_total")).filter("_s IS NOT NULL AND _e IS NOT NULL AND _total IS NOT NULL")
    return _streamed(rows, keys, ["_s", "_e", "_id"], fold, f"`{id_col}` {spans.schema[id_col].dataType.simpleString()}, clip_index int, a double, b double")


def overlap_violations(spans: DataFrame, keys: list[str], *, start: str = "start", end: str = "end", tie: list[str] | None = None, tolerance: float = 0.001) -> DataFrame:
    """Rows that begin before the previous one ends, by more than the tolerance."""
    w = W.partitionBy(*keys).orderBy(start, end, *(tie or []))
    return spans.withColumn("previous_end", F.lag(end).over(w)).filter(F.col(start) < F.col("previous_end") - tolerance)


def coverage(clips: DataFrame, sources: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_clips, minutes, coverage): clip minutes as a share of the source's, in per cent."""
    per = clips.groupBy(*keys).agg(F.count("*").alias("n_clips"), (F.sum(F.col("end") - F.col("start")) / 60).alias("minutes"), F.count_if(~F.col("snapped")).alias("unsnapped"))
    return sources.join(per, keys, "left").select(
        *keys, F.coalesce("n_clips", F.lit(0)).alias("n_clips"), F.coalesce("minutes", F.lit(0.0)).alias("minutes"), F.coalesce("unsnapped", F.lit(0)).alias("unsnapped"),
        (100 * F.try_divide(F.coalesce("minutes", F.lit(0.0)), F.col("source_seconds") / 60)).alias("coverage"),
    )
