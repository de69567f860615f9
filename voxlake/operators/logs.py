"""Training logs: lines with carried state, loss curves, verdicts. Lines come as (log_id, line_no, line); state is held by
windows over a log's lines, so many logs are read at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxlake.functions.numbers import is_finite
from voxlake.functions.text import strip, strip_ansi

# ---- Fixed values: what the trainer prints. ----
LOSS = r"loss_mel_ce:\s*(\S+)"
TRAIN_LOSS = r">\s*loss_mel_ce:\s*(\S+)"
AVERAGE_LOSS = r">\s*avg_loss_mel_ce:\s*(\S+)"
STEP = r"GLOBAL_STEP:\s*(\d+)"
BEST = r"BEST MODEL\s*:.*?best_model_(\d+)\.pth"
TIME = r"TIME:\s*(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
EPOCH = r"EPOCH:\s*(\d+)/(\d+)"
PER_EPOCH = r"STEP:\s*\d+/(\d+)"
EFFECTIVE_BATCH = r"effective batch\s+(\d+)"
WORTH_SHOWING = r"loss_mel_ce|EPOCH|EVAL|BEST|STEP:"
PROGRESS = r"it/s|iB/s"
# -------------------------------------------------


def lines_of(logs: DataFrame, text: str = "text") -> DataFrame:
    """(log_id, line_no, line) of whole log texts."""
    return logs.select("log_id", F.posexplode(F.split(text, r"\r\n|\r|\n", -1)).alias("line_no", "line"))


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """The first match of a group, or null."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def carried(lines: DataFrame) -> DataFrame:
    """lines with the step and the evaluation flag that hold at each. A step marker sets the step and clears the flag; an
    evaluation heading sets the flag, an epoch heading clears it; on one line the step comes first."""
    w = W.partitionBy("log_id").orderBy("line_no")
    line = strip_ansi(F.col("line"))
    out = lines.withColumn("line", line)
    step = found(F.col("line"), STEP).cast("long")
    flag = F.when(F.col("line").contains("EVALUATION"), True).when(F.col("line").contains("EPOCH:"), False).when(step.isNotNull(), False)
    return out.withColumn("step", F.coalesce(F.last(step, ignorenulls=True).over(w), F.lit(0))).withColumn("in_eval", F.coalesce(F.last(flag, ignorenulls=True).over(w), F.lit(False)))


def curve_points(lines: DataFrame) -> DataFrame:
    """(log_id, line_no, series, step, value): series train, eval or best (step of a best model, no value)."""
    rows = carried(lines)
    c = F.col("line")
    best, average, train = found(c, BEST).cast("long"), found(c, AVERAGE_LOSS), found(c, TRAIN_LOSS)
    kind = F.when(best.isNotNull(), "best").when(average.isNotNull(), F.when(F.col("in_eval"), "eval").otherwise("train")).when(train.isNotNull(), "train")
    value = F.coalesce(average, train)
    out = rows.select("log_id", "line_no", kind.alias("series"), F.coalesce(best, F.col("step")).alias("step"), F.when(best.isNull(), value).alias("raw")).filter("series IS NOT NULL")
    return out.filter((F.col("series") == "best") | is_finite(F.col("raw"))).select("log_id", "line_no", "series", "step", F.col("raw").try_cast("double").alias("value"))


def loss_values(lines: DataFrame) -> DataFrame:
    """(log_id, line_no, k, value) of every loss as written."""
    return lines.select("log_id", "line_no", F.posexplode(F.regexp_extract_all(strip_ansi(F.col("line")), F.lit(LOSS), F.lit(1))).alias("k", "value"))


def diverged(values: Column, need: int = 3) -> Column:
    """An array of values as written ends in `need` values that are not finite."""
    tail = F.when(F.size(values) >= need, F.slice(values, -need, need)).otherwise(F.array().cast("array<string>"))
    return (F.size(values) >= need) & F.forall(tail, lambda v: ~is_finite(v))


def divergence(lines: DataFrame, need: int = 3) -> DataFrame:
    """(log_id, diverged) from the last `need` losses of each log: at most that many leave any task."""
    w = W.partitionBy("log_id").orderBy(F.desc("line_no"), F.desc("k"))
    tail = loss_values(lines).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= need)
    return tail.groupBy("log_id").agg(((F.count("*") == need) & F.bool_and(~is_finite(F.col("value")))).alias("diverged"))


def worth_showing(lines: DataFrame, limit: int | None = None) -> DataFrame:
    rows = lines.withColumn("line", strip(strip_ansi(F.col("line")))).filter(F.col("line").rlike(WORTH_SHOWING) & ~F.col("line").rlike(PROGRESS))
    if limit is None:
        return rows
    w = W.partitionBy("log_id").orderBy(F.desc("line_no"))
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit).drop("_rn")


def verdicts(evals: DataFrame, keys: list[str], order: str, value: str, *, patience: int = 2, rise: float = 0.01) -> DataFrame:
    """(keys, points, best, last, after, verdict) of each evaluation curve: too-short, improving, overfitting or plateau."""
    w = W.partitionBy(*keys).orderBy(order)
    rows = evals.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value))).withColumn("_i", F.row_number().over(w) - 1)
    at = F.min(F.struct(F.col(value).alias("v"), F.col("_i").alias("i")))
    out = rows.groupBy(*keys).agg(F.count("*").alias("points"), at.alias("b"), F.max_by(value, "_i").alias("last"))
    out = out.select(*keys, "points", F.col("b.v").alias("best"), "last", (F.col("points") - 1 - F.col("b.i")).alias("after"))
    label = F.when(F.col("points") < 3, "too-short").when(F.col("after") == 0, "improving").when((F.col("after") >= patience) & (F.col("last") > F.col("best") * (1 + rise)), "overfitting").otherwise("plateau")
    return out.withColumn("verdict", label)


def rolling_mean(rows: DataFrame, keys: list[str], order: str, value: str, window: int, alias: str = "smooth") -> DataFrame:
    """Centred mean that shrinks at the edges; half is window // 2, so an even window spans one row more."""
    if window <= 1:
        return rows.withColumn(alias, F.col(value))
    half = window // 2
    return rows.withColumn(alias, F.avg(value).over(W.partitionBy(*keys).orderBy(order).rowsBetween(-half, half)))


def run_summary(lines: DataFrame) -> DataFrame:
    """One row for each log: wall_h, sec_per_step, last_step, epoch_reached, epoch_total, steps_per_epoch, effective_batch."""
    rows = lines.withColumn("line", strip_ansi(F.col("line")))
    c = F.col("line")
    stamp = F.try_to_timestamp(found(c, TIME), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    base = rows.select("log_id", "line_no", stamp.alias("stamp"), found(c, EPOCH, 1).cast("int").alias("e1"), found(c, EPOCH, 2).cast("int").alias("e2"), found(c, PER_EPOCH).cast("int").alias("per"), found(c, EFFECTIVE_BATCH).cast("int").alias("batch"))
    last = lambda v: F.max_by(v, F.when(F.col(v).isNotNull(), F.col("line_no")))
    first = lambda v: F.min_by(v, F.when(F.col(v).isNotNull(), F.col("line_no")))
    per = base.groupBy("log_id").agg(
        F.count("stamp").alias("stamps"), (F.unix_micros(last("stamp").cast("timestamp")) - F.unix_micros(first("stamp").cast("timestamp"))).alias("us"),
        last("e1").alias("epoch_reached"), (last("e2") + 1).alias("epoch_total"), F.max("per").alias("steps_per_epoch"), first("batch").alias("effective_batch"),
    )
    steps = curve_points(lines).filter("series = 'train'").groupBy("log_id").agg(F.min_by("step", "line_no").alias("first_step"), F.max_by("step", "line_no").alias("last_step"))
    seconds = F.when(F.col("stamps") >= 2, F.col("us") / 1e6)
    return per.join(steps, "log_id", "left").select(
        "log_id", (seconds / 3600).alias("wall_h"), F.when(F.col("last_step") > F.col("first_step"), seconds / (F.col("last_step") - F.col("first_step"))).alias("sec_per_step"),
        F.coalesce("last_step", F.lit(0)).alias("last_step"), "epoch_reached", "epoch_total", "steps_per_epoch", "effective_batch",
    )


def best_checkpoints(files: DataFrame, run: str = "run", path: str = "path") -> DataFrame:
    """(run, path): best_model if there is one, else the checkpoint with the highest number."""
    step = F.regexp_extract(path, r"checkpoint_(\d+)\.pth$", 1).try_cast("long")
    is_best = F.col(path).rlike(r"best_model(_\d+)?\.pth$")
    best_step = F.coalesce(F.regexp_extract(path, r"best_model_(\d+)\.pth$", 1).try_cast("long"), F.when(is_best, F.lit(2**62)))
    rows = files.filter(is_best | step.isNotNull())
    return rows.groupBy(run).agg(F.max(F.struct(is_best.alias("is_best"), F.coalesce(best_step, step).alias("step"), F.col(path).alias("path"))).alias("b")).select(run, "b.path")
