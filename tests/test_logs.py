"""Training logs: published expectations of curves, verdicts and divergence."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from voxlake.operators import logs as L

LOG = """ > Training: effective batch 64
 > EPOCH: 0/40
   --> TIME: 2024-05-01 10:00:00 -- STEP: 350/879 -- GLOBAL_STEP: 350
     | > loss_mel_ce: 3.493067979812622  (3.7744)
 > EVALUATION
     | > avg_loss_mel_ce:\x1b[92m 3.189875941527517 \x1b[0m(-0.1)
 > BEST MODEL : run/best_model_880.pth
 > EPOCH: 1/40
   --> TIME: 2024-05-01 12:01:00 -- STEP: 321/879 -- GLOBAL_STEP: 1200
     | > loss_mel_ce: 3.3386614322662354  (3.4)
     | > loss_mel_ce: nan  (nan)
   12%| 3.2it/s loss_mel_ce: 1
 > EVALUATION
     | > avg_loss_mel_ce: 3.020407877470318 (-0.1)
 > BEST MODEL : run/best_model_1760.pth"""


@pytest.fixture(scope="module")
def lines(spark):
    return L.lines_of(spark.createDataFrame([("a", LOG), ("b", "   | > avg_loss_mel_ce: 2.9 (0)"), ("c", "")], "log_id string, text string")).cache()


def test_curves(lines):
    got = [(r.log_id, r.series, r.step, r.value) for r in L.curve_points(lines).orderBy("log_id", "line_no").collect()]
    assert got == [
        ("a", "train", 350, 3.493067979812622), ("a", "eval", 350, 3.189875941527517), ("a", "best", 880, None), ("a", "train", 1200, 3.3386614322662354),
        ("a", "eval", 1200, 3.020407877470318), ("a", "best", 1760, None), ("b", "train", 0, 2.9),
    ]


def test_summary(lines):
    rows = {r.log_id: r for r in L.run_summary(lines).collect()}
    a = rows["a"]
    assert (round(a.wall_h, 4), a.last_step, a.epoch_reached, a.epoch_total, a.steps_per_epoch, a.effective_batch) == (2.0167, 1200, 1, 41, 879, 64)
    assert a.sec_per_step == pytest.approx(7260 / 850) and rows["c"].wall_h is None


def test_shown_lines_skip_progress_bars(lines):
    shown = [r.line for r in L.worth_showing(lines, limit=2).filter("log_id = 'a'").orderBy("line_no").collect()]
    assert shown == ["| > avg_loss_mel_ce: 3.020407877470318 (-0.1)", "> BEST MODEL : run/best_model_1760.pth"]


@pytest.mark.parametrize(
    ("values", "lost"), [(["nan"] * 3, True), ("4.1 nan 3.9 3.8 3.7 3.6".split(), False), ("3.7 nan nan".split(), False), ("4.1 3.9 3.8 nan nan nan".split(), True), (["inf", "-inf", "nan"], True), (["nan"], False), ([], False)]
)
def test_divergence(spark, values, lost):
    df = spark.createDataFrame([(values,)], "v array<string>")
    assert df.select(L.diverged(F.col("v")).alias("x")).first().x is lost
    text = "\n".join(f"loss_mel_ce: {v}" for v in values)
    got = L.divergence(L.lines_of(spark.createDataFrame([("x", text)], "log_id string, text string"))).collect()
    assert [r.diverged for r in got] == ([lost] if values else [])


@pytest.mark.parametrize(
    ("curve", "label"), [([3.0, 2.0], "too-short"), ([3.0, 2.5, 2.0], "improving"), ([3.0, 2.0, 2.1, 2.2], "overfitting"), ([3.0, 2.0, 2.005, 2.01], "plateau"), ([3.0, 2.0, 2.5], "plateau"), ([float("nan"), 3.0, 2.0], "too-short")]
)
def test_verdicts(spark, curve, label):
    df = spark.createDataFrame([("x", i, v) for i, v in enumerate(curve)], "log_id string, i int, v double")
    assert L.verdicts(df, ["log_id"], "i", "v").first().verdict == label


def test_synthetic_overfit(spark):
    text = []
    for step in range(50, 2450, 50):
        text.append(f"--> STEP: {step}/600 -- GLOBAL_STEP: {step}\n | > loss_mel_ce: {4 - step / 1000:.4f} (0)")
        if step % 400 == 0:
            text.append(f" > EVALUATION\n | > avg_loss_mel_ce: {3 - min(step, 1200) / 1000 + max(0, step - 1200) / 2000:.4f} (0)")
            text += [f" > BEST MODEL : best_model_{step}.pth"] if step <= 1200 else []
    points = L.curve_points(L.lines_of(spark.createDataFrame([("x", "\n".join(text))], "log_id string, text string"))).cache()
    counts = {r.series: r["count"] for r in points.groupBy("series").count().collect()}
    assert counts == {"train": 48, "eval": 6, "best": 3}
    assert [r.step for r in points.filter("series = 'best'").orderBy("line_no").collect()] == [400, 800, 1200]
    assert L.verdicts(points.filter("series = 'eval'"), ["log_id"], "line_no", "value").first().verdict == "overfitting"


def test_rolling_mean(spark):
    df = spark.createDataFrame([("x", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 10])], "k string, i int, v double")
    means = lambda w: [round(r.smooth, 4) for r in L.rolling_mean(df, ["k"], "i", "v", w).orderBy("i").collect()]
    assert means(1) == [1, 2, 3, 4, 10] and means(3) == [1.5, 2, 3, 5.6667, 7] and means(2) == means(3)


def test_checkpoints(spark):
    files = [("r1", "/a/checkpoint_900.pth"), ("r1", "/a/checkpoint_1000.pth"), ("r2", "/b/checkpoint_5000.pth"), ("r2", "/b/best_model_40.pth"), ("r2", "/b/best_model.pth"), ("r3", "/c/notes.txt")]
    got = {r.run: r.path for r in L.best_checkpoints(spark.createDataFrame(files, "run string, path string")).collect()}
    assert got == {"r1": "/a/checkpoint_1000.pth", "r2": "/b/best_model.pth"}
