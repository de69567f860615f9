"""Folds and windows against plain sequential models on random data."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from voxlake.operators import intervals as I


def regions(seed: int, keys: int, n: int, gap=(0.05, 3.0), size=(0.2, 9.0)):
    rng, out = random.Random(seed), []
    for k in range(keys):
        t = 0.0
        for _ in range(rng.randint(0, n)):
            t = round(t + rng.uniform(*gap), 3)
            e = round(t + rng.uniform(*size), 3)
            out.append((f"ep{k}", t, e))
            t = e
    return out


def by_key(rows):
    out: dict = {}
    for r in rows:
        out.setdefault(r[0], []).append(tuple(r[1:]))
    return out


def test_chunks_follow_the_running_start(spark):
    rows = regions(1, 40, 60)
    got = I.chunk_regions(spark.createDataFrame(rows, "ep string, start double, end double"), ["ep"], target=30.0).orderBy("ep", "chunk").collect()
    want = []
    for ep, spans in sorted(by_key(rows).items()):
        chunks, now = [], None
        for a, b in sorted(spans):
            if now is None or b - now[0] > 30.0:
                now = [a, b, 1]
                chunks.append(now)
            else:
                now[1], now[2] = b, now[2] + 1
        want += [(ep, i, *c) for i, c in enumerate(chunks)]
    assert [tuple(r) for r in got] == want


def snapped(said, found):
    owner, current = [[] for _ in said], 0
    for a, b in found:
        best, most = None, 0.0
        for i in range(current, len(said)):
            if said[i][0] > b:
                break
            shared = min(b, said[i][1]) - max(a, said[i][0])
            if shared > most:
                best, most = i, shared
        if best is not None:
            owner[best].append((a, b))
            current = best
    return [(w[0][0], w[-1][1], t, True, len(w)) if w else (s, e, t, False, 0) for (s, e, t), w in zip(said, owner, strict=True)]


def test_each_region_is_won_by_one_sentence(spark):
    rng = random.Random(2)
    found = regions(3, 30, 25)
    said = [(k, round(max(0.0, a + rng.uniform(-2, 2)), 3), round(b + rng.uniform(0.1, 2), 3), f"t{i}") for i, (k, a, b) in enumerate(found) if rng.random() < 0.6]
    said += [("alone", 1.0, 2.0, "x")]
    got = I.snap(spark.createDataFrame(said, "ep string, start double, end double, text string"), spark.createDataFrame(found, "ep string, start double, end double"), ["ep"]).collect()
    regions_of = by_key(found)
    want = [(k, *r) for k, rows in by_key(said).items() for r in snapped(sorted(rows), sorted(regions_of.get(k, [])))]
    assert sorted(map(tuple, got)) == sorted(want)


def test_short_neighbours_merge_into_the_running_row(spark):
    rows = [(k, a, b, f"w{i}", i % 5 != 0) for i, (k, a, b) in enumerate(regions(5, 40, 40, gap=(0.0, 1.2)))]
    got = I.merge_short(spark.createDataFrame(rows, "ep string, start double, end double, text string, snapped boolean"), ["ep"], least=3.0, most=12.0, gap=0.6)
    want = []
    for k, spans in by_key(rows).items():
        out: list = []
        for a, b, t, ok in sorted(spans):
            if out:
                p = out[-1]
                if (p[1] - p[0] < 3.0 or b - a < 3.0) and b - p[0] <= 12.0 and 0 <= a - p[1] <= 0.6:
                    p[1], p[2], p[3] = b, f"{p[2]} {t}".strip(), p[3] and ok
                    continue
            out.append([a, b, t, ok])
        want += [(k, i, *o) for i, o in enumerate(out)]
    assert sorted(map(tuple, got.select("ep", "seq", "start", "end", "text", "snapped").collect())) == sorted(want)


def test_trim_pad_and_check(spark):
    rng = random.Random(7)
    rows = [(f"ep{i % 12}", s := round(rng.uniform(0, 60), 2), round(s + rng.uniform(0.5, 9), 2), i) for i in range(300)]
    df = spark.createDataFrame(rows, "ep string, start double, end double, id long")
    trimmed = I.trim_overlap(df, ["ep"], tie=["id"])
    assert I.overlap_violations(trimmed, ["ep"], tie=["id"]).count() == 0
    spans = {}
    for r in trimmed.collect():
        spans.setdefault(r.ep, []).append((r.start, r.end, r.id))

    def padded(least: float) -> dict:
        want = {}
        for own in spans.values():
            own = sorted(x for x in own if x[1] - x[0] >= least)
            previous = 0.0
            for i, (s, e, name) in enumerate(own):
                a = max(0.0, previous, s - I.PAD)
                b = min(58.0, own[i + 1][0] if i + 1 < len(own) else 58.0, e + I.PAD)
                if b - a >= I.MIN_CLIP:
                    want[name] = (i, pytest.approx(a), pytest.approx(b))
                    previous = b
        return want

    banded = trimmed.filter(I.in_band(F.col("start"), F.col("end")))
    assert {r.id: (r.clip_index, r.a, r.b) for r in I.pad_clips(banded, ["ep"], F.lit(58.0), tie=["id"]).collect()} == padded(I.MIN_CLIP)
    folded = I.pad_clips_fold(trimmed.withColumn("total", F.lit(58.0)), ["ep"], "total", id_col="id").collect()
    assert {r.id: (r.clip_index, r.a, r.b) for r in folded} == padded(-1.0)


def test_first_of_equal_rounded_spans(spark):
    df = spark.createDataFrame([("a", 1.001, 2.0, 0), ("a", 1.002, 2.001, 1), ("a", 1.02, 2.0, 2), ("b", 1.001, 2.0, 3)], "ep string, start double, end double, id long")
    assert sorted(r.id for r in I.dedupe_spans(df, ["ep"], tie=["id"]).collect()) == [0, 2, 3]


def test_items_are_checked_one_by_one(spark):
    replies = [
        (0, '[{"start_sec": 1, "end_sec": 2, "text": " a "}, {"start_sec": "x", "end_sec": 2, "text": "b"}, 5, {"start_sec": 3, "end_sec": 3, "text": "c"}, {"start_sec": 4, "end_sec": 99, "text": "d"}, {"start_sec": "NaN", "end_sec": 5, "text": "e"}]'),
        (1, 'Here: [{"start_sec": 0, "end_sec": 1, "text": "f"}] bye'), (2, ""), (3, '{"start_sec": 0}'), (4, '[{"start_sec": 0, "end'), (5, None), (6, '[{"start_sec": 1, "end_sec": 2, "text": "  "}]'),
    ]
    df = spark.createDataFrame(replies, "id int, reply string")
    got = I.valid_items(df, ["id"], "reply", F.lit(10.0), F.lit(40.0)).orderBy("id", "seq").collect()
    assert [(r.id, r.start, r.end, r.text) for r in got] == [(0, 11.0, 12.0, "a"), (0, 14.0, 40.0, "d"), (1, 10.0, 11.0, "f")]
    assert I.valid_items(df.limit(0), ["id"], "reply", F.lit(0.0), F.lit(1.0)).count() == 0
