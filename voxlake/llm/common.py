"""Shared pieces: scratch tables in the cluster's shared folder, Arrow batch size, text buffers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake import reach_workers

_own: list[str] = []
#: Folders of scratch tables that were written by this process and still stand.
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset and all runs in one process (tests), a temporary one of our own."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="voxlake-"))
        atexit.register(shutil.rmtree, _own[0], True)
    return "file://" + _own[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    _written.append(f"{shared_dir(spark)}/voxlake-{uuid.uuid4().hex}")
    return f"{_written[-1]}/{name}"


def scratch_mark() -> int:
    return len(_written)


def sweep(spark: SparkSession, since: int = 0, keep: str | None = None) -> None:
    """Delete the scratch tables written since a mark, all by default, but for the one at `keep`. Results that were not
    written yet and read these tables can no longer be computed."""
    gone = [f for f in _written[since:] if keep is None or not keep.startswith(f)]
    _written[since:] = [f for f in _written[since:] if f not in gone]
    for f in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df to a table in the shared folder and read it back: lineage ends there, and a lost executor costs only
    what it was computing."""
    return materialise_at(df, scratch_path(df.sparkSession, name), **options)


def materialise_at(df: DataFrame, path: str, **options: str) -> DataFrame:
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame) -> DataFrame:
    """df dealt to a sixteenth of the shuffle partitions, or one for each core, so that a short table of an aggregate over
    many partitions isn't written as so many files. Rows should be the same however often they are computed."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16))


def settled(df: DataFrame, name: str, mark: int) -> DataFrame:
    """Write df as an operator's result and delete the scratch tables written since the mark."""
    path = scratch_path(df.sparkSession, name)
    out = materialise_at(df, path)
    sweep(df.sparkSession, mark, keep=path)
    return out


#: A table of at most so many rows is sent to all executors; beyond it, both sides of a join are shuffled.
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, rows: int | None = None, limit: int | None = None) -> DataFrame:
    """df, to be broadcast if a count shows that it is small. df should be a written table of short rows."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= (BROADCAST_ROWS if limit is None else limit) else df


#: Bytes of an Arrow batch: one batch holds at most so many, or one row.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Lower (never raise) the rows and bytes of an Arrow batch, so that a batch of long texts stays small.

    Spark reads these settings when a plan runs, which is after an operator has returned it, so they stay set in the session.
    """
    reach_workers(spark)
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if not 0 < int(spark.conf.get(key).rstrip("b")) <= most:
            spark.conf.set(key, most)


def row_key(id_col: str, text_col: str):
    """Tells rows of a repeated id apart; rows equal in both are interchangeable."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(offsets: np.ndarray, limit: int = 1 << 18):
    """Consecutive row ranges (a, b) of at most `limit` bytes each, or of one row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b
