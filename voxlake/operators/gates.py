"""Regression gates between two runs, and findings that carry their evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Metric, higher is better, tolerance, kind of tolerance.
GATES = [("mcd_db", False, 0.02, "rel"), ("f0_rmse_cents", False, 0.03, "rel"), ("f0_corr", True, 0.02, "abs"), ("secs", True, 0.01, "abs"), ("utmos", True, 0.05, "abs"), ("failure_rate", False, 0.01, "abs")]
#: How much farther from 1 the duration ratio may move.
RATIO_TOLERANCE = 0.02
SEVERITIES = ["do first", "investigate", "consider"]


def averaged(runs: DataFrame) -> DataFrame:
    """(metric, value): the mean over the seeds of one side; nulls are skipped."""
    return runs.groupBy("metric").agg(F.avg("value").alias("value"))


def gate_table(spark, gates=GATES) -> DataFrame:
    return spark.createDataFrame(gates, "metric string, higher_better boolean, tolerance double, kind string")


def compare(baseline: DataFrame, candidate: DataFrame, gates: DataFrame) -> DataFrame:
    """(metric, baseline, candidate, delta, allowed, worse_by, ok): ok is null where nothing gates the metric. The gates are
    a handful of rows, whatever the runs' size."""
    both = averaged(baseline).withColumnRenamed("value", "baseline").join(averaged(candidate).withColumnRenamed("value", "candidate"), "metric")
    both = both.filter("baseline IS NOT NULL AND candidate IS NOT NULL").join(F.broadcast(gates), "metric", "left")
    delta = F.col("candidate") - F.col("baseline")
    closer = F.abs(1 - F.col("candidate")) - F.abs(1 - F.col("baseline"))
    is_ratio = F.col("metric") == "duration_ratio"
    worse = F.when(is_ratio, closer).when(F.col("higher_better"), -delta).when(~F.col("higher_better"), delta)
    allowed = F.when(is_ratio, F.lit(RATIO_TOLERANCE)).when(F.col("kind") == "rel", F.col("tolerance") * F.abs("baseline")).otherwise(F.col("tolerance"))
    return both.select("metric", "baseline", "candidate", delta.alias("delta"), allowed.alias("allowed"), worse.alias("worse_by"), (worse <= allowed).alias("ok"))


def overall(compared: DataFrame) -> DataFrame:
    """One row: compared, failed, passed, identical (all gated deltas are nought; needs at least one)."""
    gated = F.col("ok").isNotNull()
    return compared.agg(
        F.count_if(gated).alias("compared"), F.count_if(~F.coalesce("ok", F.lit(True))).alias("failed"),
        F.coalesce(F.bool_and(F.coalesce("ok", F.lit(True))), F.lit(True)).alias("passed"),
        (F.coalesce(F.bool_and(F.when(gated, F.abs("delta") <= 1e-12)), F.lit(False)) & (F.count_if(gated) > 0)).alias("identical"),
    )


def _finding(df: DataFrame, condition, severity: str, title, evidence) -> DataFrame:
    return df.filter(F.coalesce(condition, F.lit(False))).select(F.lit(SEVERITIES.index(severity)).alias("rank"), F.lit(severity).alias("severity"), title.alias("title"), evidence.alias("evidence"))


def findings(*, speakers: DataFrame | None = None, run: DataFrame | None = None, metrics: DataFrame | None = None, session_hours: float = 9.0) -> DataFrame | None:
    """(seq, severity, title, evidence) ordered by severity. What is missing gives no finding.

    speakers: speaker, hours, text_source, f0_corr (one row for each). run: one row with verdict, best_step, wall_h, budget_h,
    reason, sec_per_step, steps_per_epoch, epoch_total. metrics: one row with failure_rate, duration_ratio.
    """
    out: list[DataFrame] = []
    number = lambda c, n=2: F.format_string(f"%.{n}f", F.col(c))
    if speakers is not None:
        each = F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "speaker", F.coalesce("text_source", F.lit("?"))))), ", ")
        text = speakers.agg(F.count_if(F.col("text_source") == "script").alias("n"), each.alias("e"))
        out.append(_finding(text, F.col("n") > 0, "investigate", F.lit("Some text came from transliterated script"), F.col("e")))
        hours = speakers.filter("hours IS NOT NULL").agg(F.count("*").alias("n"), F.min("hours").alias("lo"), F.max("hours").alias("hi"), F.min_by("speaker", F.struct("hours", "speaker")).alias("who"))
        out.append(_finding(hours, (F.col("n") > 1) & (F.col("hi") > 2 * F.col("lo")), "consider", F.concat(F.lit("Speaker data is imbalanced: least for "), F.col("who")), F.concat(number("lo"), F.lit(" h against "), number("hi"), F.lit(" h"))))
    if run is not None:
        out.append(_finding(run, (F.col("wall_h") < 0.6 * F.col("budget_h")) & (F.coalesce("reason", F.lit("")) != "epochs_done"), "do first", F.lit("Training used a small part of its time budget"), F.concat(number("wall_h"), F.lit(" of "), number("budget_h"), F.lit(" h, stopped by "), F.coalesce("reason", F.lit("unknown")))))
        for verdict, severity, title in (("improving", "do first", "The run stopped before it converged"), ("overfitting", "do first", "Evaluation loss rose again: the last checkpoint is not the best"), ("plateau", "consider", "Evaluation loss is flat")):
            out.append(_finding(run, F.col("verdict") == verdict, severity, F.lit(title), F.concat(F.lit("best at step "), F.coalesce(F.col("best_step").cast("string"), F.lit("?")))))
        need = F.col("sec_per_step") * F.col("steps_per_epoch") * F.col("epoch_total") / 3600
        out.append(_finding(run.withColumn("need", need), F.col("need") > session_hours, "do first", F.lit("The epochs asked for need more than one session"), F.concat(number("need", 1), F.lit(" h"))))
    if metrics is not None:
        out.append(_finding(metrics, F.col("failure_rate") > 0.03, "investigate", F.lit("Many generations failed"), F.concat(F.format_string("%.1f", 100 * F.col("failure_rate")), F.lit(" %"))))
        out.append(_finding(metrics, F.abs(1 - F.col("duration_ratio")) > 0.05, "investigate", F.lit("Generated audio is systematically shorter or longer"), F.concat(F.lit("ratio "), number("duration_ratio", 3))))
    if speakers is not None:
        spread = speakers.filter("f0_corr IS NOT NULL").agg(F.count("*").alias("n"), F.min("f0_corr").alias("lo"), F.max("f0_corr").alias("hi"), F.min_by("speaker", "f0_corr").alias("worst"), F.max_by("speaker", "f0_corr").alias("top"))
        out.append(_finding(spread, (F.col("n") > 1) & (F.col("hi") - F.col("lo") > 0.15), "investigate", F.concat(F.lit("Speakers differ in prosody: "), F.col("worst"), F.lit(" and "), F.col("top")), F.concat(number("lo", 3), F.lit(" against "), number("hi", 3))))
    if not out:
        return None
    union = out[0].withColumn("seq", F.lit(0))
    for k, df in enumerate(out[1:], 1):
        union = union.union(df.withColumn("seq", F.lit(k)))
    return union.orderBy("rank", "seq").select("seq", "severity", "title", "evidence")
