from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.operators import boundary as B
from voxlake.operators import gates as G
from voxlake.operators import metrics as M
from voxlake.operators import panel as R
from voxlake.operators import state as X


def test_resume(spark):
    plan = spark.createDataFrame([("a", "600"), ("b", "600"), ("c", "600"), ("d", "oops")], "episode string, length string")
    key = lambda *v: spark.createDataFrame([(x,) for x in v], "episode string")
    got = {r.episode: r.status for r in X.episode_state(plan, key("a"), key("b", "c"), key("b", "b", "c")).collect()}
    assert got == {"a": "done", "b": "backfill", "c": "redo", "d": "redo"}
    estimate = X.plan_estimate(plan, key("a"), ["episode"]).first()
    assert (estimate.total, estimate.skipped, round(estimate.hours, 4), estimate.requests) == (4, 1, 0.3333, 5)


def test_cache_is_filled_only_where_it_misses(spark):
    chunks = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2)], "episode string, chunk int")
    cache = spark.createDataFrame([("a", 0, "[1]"), ("a", 1, "{broken")], "episode string, chunk int, reply string")
    got = X.fill_cache(chunks, cache, ["episode", "chunk"], lambda miss: miss.withColumn("reply", F.lit("[2]")))
    assert sorted((r.chunk, r.reply) for r in got.collect()) == [(0, "[1]"), (1, "[2]"), (2, "[2]")]


def test_adopt_and_directories(spark):
    found = spark.createDataFrame([("e", "/x/e"), ("e", "/a/e"), ("f", "/a/f")], "episode string, path string")
    present = spark.createDataFrame([("f",)], "episode string")
    assert [tuple(r) for r in X.adopt(found, present).collect()] == [("e", "/a/e")]
    assert [r.path for r in X.adopt(found, present, keep="last").collect()] == ["/x/e"]
    files = spark.createDataFrame([("/a/b/x.wav",), ("/a/b/y.wav",), ("/a/c/z.txt",)], "path string")
    assert [tuple(r) for r in X.directories_with(files, r"\.wav$").collect()] == [("/a/b", 2)]


def test_union_of_manifests(spark):
    a, b = spark.createDataFrame([("1", "lofi")], "id string, quality string"), spark.createDataFrame([("2", "False")], "id string, snapped string")
    got = sorted((r.id, r.quality, r.snapped) for r in X.union_manifests([a, b]).collect())
    assert got == [("1", "lofi", "True"), ("2", "hifi", "False")]


def runs(spark, values: dict):
    return spark.createDataFrame([(m, float(v)) for m, vs in values.items() for v in vs], "metric string, value double")


def test_gates(spark):
    base = runs(spark, {"mcd_db": [60, 62], "f0_corr": [0.40], "secs": [0.70], "duration_ratio": [0.99], "rtf": [0.5]})
    worse = runs(spark, {"mcd_db": [62.5], "f0_corr": [0.37], "secs": [0.72], "duration_ratio": [0.95], "rtf": [9.0]})
    got = {r.metric: r.ok for r in G.compare(base, worse, G.gate_table(spark)).collect()}
    assert got == {"mcd_db": False, "f0_corr": False, "secs": True, "duration_ratio": False, "rtf": None}
    row = G.overall(G.compare(base, worse, G.gate_table(spark))).first()
    assert (row.compared, row.failed, row.passed, row.identical) == (4, 3, False, False)
    same = G.overall(G.compare(base, base, G.gate_table(spark))).first()
    assert same.passed and same.identical
    none = G.overall(G.compare(base, runs(spark, {"x": [1]}), G.gate_table(spark))).first()
    assert none.passed and not none.identical and none.compared == 0


def test_findings(spark):
    speakers = spark.createDataFrame([("d", 4.69, "roman", 0.55), ("h", 2.11, "script", 0.25)], "speaker string, hours double, text_source string, f0_corr double")
    run = spark.createDataFrame([("improving", 5250, 2.27, 8.5, "process_exit", 1.42, 879, 40)], "verdict string, best_step long, wall_h double, budget_h double, reason string, sec_per_step double, steps_per_epoch long, epoch_total long")
    scores = spark.createDataFrame([(0.025, 0.968)], "failure_rate double, duration_ratio double")
    got = [(r.severity, r.title.split(":")[0]) for r in G.findings(speakers=speakers, run=run, metrics=scores).collect()]
    assert got == [
        ("do first", "Training used a small part of its time budget"), ("do first", "The run stopped before it converged"), ("do first", "The epochs asked for need more than one session"),
        ("investigate", "Some text came from transliterated script"), ("investigate", "Speakers differ in prosody"), ("consider", "Speaker data is imbalanced"),
    ]
    assert G.findings() is None
    empty = G.findings(speakers=speakers.limit(0), run=run.limit(0), metrics=scores.limit(0))
    assert empty.count() == 0


def test_statistics(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("a", None, None), ("b", 3.0, False), ("b", 5.0, False)], "speaker string, mcd_db double, failed boolean").withColumn("utmos", F.lit(None).cast("double"))
    got = {r.name: r for r in M.summarise(df, "speaker", ["mcd_db"], ["utmos"]).collect()}
    assert got["all"].clips == 4 and got["all"].failure_rate == 0.25 and "utmos" not in got["all"].asDict()
    assert got["a"].mcd_db.std == 0.0 and got["b"].mcd_db["mean"] == 4.0 and got["a"].failure_rate == 0.5


def test_positions(spark):
    df = spark.range(1, 41).selectExpr("id AS x")
    row = M.percentiles(df, [], "x", {"m": M.upper_median, "p": M.p95_of_n, "q": M.p95_of_last}).first()
    values = list(range(1, 41))
    assert tuple(row) == (values[20], values[int(0.95 * 40)], values[int(0.95 * 39)])
    rows = [("a", v) for v in (3, 1, 1, 2, None)] + [("b", 7)]
    got = {r.k: r.m for r in M.percentiles(spark.createDataFrame(rows, "k string, v int"), ["k"], "v", {"m": M.upper_median}).collect()}
    assert got == {"a": 2, "b": 7}


def test_gaps_plans_and_counts(spark):
    rows = spark.createDataFrame([(0.1, 0.4), (0.2, None), (0.3, 0.2)], "real double, synth double")
    assert rows.agg(F.round(F.avg(M.cer_gap(rows, "real", "synth")), 6)).first()[0] == 0.1
    plan = spark.range(1).select(*M.training_plan(rows=F.lit(7032), batch=4, accumulate=2, epochs=40, seconds_per_step=F.lit(1.42), session_hours=8.5)).first()
    assert plan.steps_per_epoch == 879 and round(plan.total_hours, 3) == round(879 * 40 * 1.42 / 3600, 3) and plan.sessions == 2
    episodes, failed = spark.createDataFrame([("e",), ("f",), ("g",), ("e",)], "episode string"), spark.createDataFrame([("f", 3), ("f", 4)], "episode string, chunk int")
    assert tuple(X.episode_counts(episodes, failed).first()) == (2, 1)
    twice = spark.createDataFrame([("e", 1, "[1]"), ("e", 1, "[1]"), ("e", 2, "{")], "episode string, chunk int, reply string")
    chunks = spark.createDataFrame([("e", 1), ("e", 2)], "episode string, chunk int")
    filled = X.fill_cache(chunks, twice, ["episode", "chunk"], lambda miss: miss.withColumn("reply", F.lit("[]")))
    assert sorted((r.chunk, r.reply) for r in filled.collect()) == [(1, "[1]"), (2, "[]")]


def test_alignment_against_plain_dp():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.normal(size=(rng.integers(1, 12), 3)), rng.normal(size=(rng.integers(1, 12), 3))
        d = np.linalg.norm(a[:, None] - b[None], axis=2)
        t = np.full((len(a) + 1, len(b) + 1), np.inf)
        t[0, 0] = 0
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = d[i, j] + min(t[i, j], t[i, j + 1], t[i + 1, j])
        cost, path = M.dtw_path(a, b)
        assert cost == pytest.approx(t[-1, -1]) and sum(d[i, j] for i, j in path) == pytest.approx(cost)


def tone(f: float, n: int = 16000, rate: int = 16000) -> np.ndarray:
    return 0.5 * np.sin(2 * np.pi * f * np.arange(n) / rate)


def test_signal_landmarks():
    a, noise = tone(200), np.random.default_rng(2).normal(0, 0.3, 16000)
    assert M.mel_cepstral_distortion(a, a, 16000) == 0.0
    assert 0 < M.mel_cepstral_distortion(a, tone(225), 16000) < M.mel_cepstral_distortion(a, noise, 16000)
    assert M.mel_cepstral_distortion(a[:500], a, 16000) is None
    rmse, _ = M.pitch_errors(M.pitch(a, 16000), M.pitch(tone(260), 16000))
    assert rmse == pytest.approx(454.2, abs=6)


def test_clip_metrics(spark):
    df = spark.createDataFrame([("x", tone(200).tolist(), tone(200, 8000).tolist()), ("none", None, None)], "clip_id string, ref array<float>, syn array<float>")
    got = {r.clip_id: r for r in M.clip_metrics(df, 16000).collect()}
    assert got["x"].duration_ratio == pytest.approx(0.5) and got["none"].mcd_db is None


def test_panel(spark):
    raw = spark.createDataFrame(
        [(0, " r1 ", "sighted", "MOS", "1", "5", "4", ""), (1, "r2", "visually_impaired", "MOS", "1", "3", "x", ""), (2, "", "sighted", "MOS", "1", "1", "1", ""), (3, "r1", None, "SUS", "7", "", "", "a b c"), (4, "r2", "sighted", "SUS", "8", "", "", "zz"), (5, "r3", "sighted", "MOS", "1", "1", "2", "")],
        "seq int, rater string, `group` string, part string, item string, intelligibility string, naturalness string, transcript string",
    )
    rows = R.clean_responses(raw)
    got = {r.group: (r.n, r["mean"]) for r in R.ratings(rows, "intelligibility").collect()}
    assert got == {"all": (3, 3.0), "sighted": (2, 3.0), "visually_impaired": (1, 3.0)}
    assert {r.group: r.n for r in R.ratings(rows, "naturalness").collect()} == {"all": 2, "sighted": 2}
    key = spark.createDataFrame([("SUS", 7, "a b d"), ("MOS", 1, "x")], "part string, item int, sinhala string")
    heard = R.scored_transcripts(rows, key)
    assert [(r.item, round(r.accuracy, 4)) for r in heard.collect()] == [("7", 0.6667)]
    assert {r.group: r.raters for r in R.rater_groups(rows).collect()} == {"sighted": 3}
    assert [(r.item, r.n) for r in R.disagreement(rows.filter("part = 'MOS'"), "item", "intelligibility").collect()] == [("1", 3)]


def test_failover_walks_keys_and_models():
    calls: list = []

    def call(audio, key, model):
        calls.append((key, model))
        if key == "k1":
            raise B.AccessDenied
        if model == "m1":
            raise B.QuotaExhausted
        return [{"text": "ok"}]

    f = B.Failover(["k1", "k2"], ["m1", "m2"], call)
    assert f.transcribe(b"") == [{"text": "ok"}] and calls == [("k1", "m1"), ("k2", "m1"), ("k2", "m2")] and f.requests == 1
    calls.clear()
    assert f.transcribe(b"") == [{"text": "ok"}] and calls == [("k2", "m2")]

    def spent(audio, key, model):
        raise B.QuotaExhausted

    def denied(audio, key, model):
        raise B.AccessDenied

    f = B.Failover(["k"], ["m"], spent)
    assert f.transcribe(b"") is None and f.stop == "quota"
    f = B.Failover(["k"], ["m"], denied)
    assert f.transcribe(b"") is None and f.stop == "denied"
    now = [0.0]
    f = B.Failover(["k"], ["m"], spent, deadline=100.0, poll=40.0, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert f.transcribe(b"") is None and f.stop == "session" and f.waits == 2


def test_paced_waits():
    waits: list = []
    answers = iter([B.Busy(30.0), B.Busy(), [1]])

    def call():
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    assert B.paced(call, sleep=waits.append) == [1] and waits == [30.0, 30.0]


def test_regions_of_a_signal(spark):
    signal = np.concatenate([np.zeros(8000), tone(200, 8000), np.zeros(8000), tone(300, 800), np.zeros(4000)])
    assert B.EnergyDetector()(signal, 16000) == [(0.5, 1.0)]
    df = spark.createDataFrame([("e", signal.tolist(), 16000), ("f", None, 16000)], "episode string, samples array<float>, rate long")
    assert [tuple(r) for r in B.detect_regions(df, B.EnergyDetector()).collect()] == [("e", 0.5, 1.0)]
    assert len(B.resample(signal, 16000, 8000)) == len(signal) // 2


def test_every_vector_is_a_clip(spark, tmp_path):
    from voxlake.plans.catalogue import QUERIES

    spark.createDataFrame([(i, i % 3, [i / 10, 0.0]) for i in range(6)], "vec_id long, label int, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r.clip_id: r.cents for r in QUERIES["clip_signals"](spark, str(tmp_path)).collect()}
    assert set(got) == {str(i) for i in range(6)} and all(x > 0 for x in got.values())
