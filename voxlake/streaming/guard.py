"""A guard over a growing training log, as a stream: it keeps the last losses of each log and tells when all are lost."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from voxlake.functions.numbers import FINITE
from voxlake.functions.text import strip_ansi
from voxlake.operators.logs import LOSS


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    """(log_id, line) of lines appended as files to a folder; one folder level names the log."""
    lines = spark.readStream.format("text").option("recursiveFileLookup", True).load(path)
    return lines.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("log_id"), F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def diverging(lines: DataFrame, need: int = 3, order: str | None = None) -> DataFrame:
    """(log_id, seen, diverged): after each batch, whether the last `need` losses of a log are all not finite.

    lines: log_id, line and, if `order` is given, a column that orders the lines of one batch.
    """
    losses = lines.select("log_id", *([F.col(order).alias("o")] if order else [F.lit(0).alias("o")]), F.explode(F.regexp_extract_all(strip_ansi(F.col("line")), F.lit(LOSS), F.lit(1))).alias("value"))

    def step(key, batches: Iterator, state: GroupState):
        import re

        import pandas as pd

        tail, seen = (list(state.get[0]), state.get[1]) if state.exists else ([], 0)
        for pdf in batches:
            values = pdf.sort_values("o", kind="stable")["value"].tolist()
            seen += len(values)
            tail = (tail + values)[-need:]
        state.update((tail, seen))
        lost = len(tail) == need and not any(re.match(FINITE, v) for v in tail)
        yield pd.DataFrame({"log_id": [key[0]], "seen": [seen], "diverged": [lost]})

    return losses.groupBy("log_id").applyInPandasWithState(step, "log_id string, seen long, diverged boolean", "tail array<string>, seen long", "update", GroupStateTimeout.NoTimeout)


def event_rates(events: DataFrame, *, ts: str = "ts", late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts by event time window with a watermark, for dashboards over a stream of events (also valid on a batch)."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, late).groupBy(F.window(ts, width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
