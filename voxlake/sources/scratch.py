"""Folders for tables that a query writes and reads back, where the driver and all executors see them."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir; where that is unset and all runs in one process, in a temporary one of our own."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="voxlake-core-"))
            atexit.register(shutil.rmtree, _own[0], True)
        shared = "file://" + _own[0]
    return f"{shared.rstrip('/')}/voxlake-{uuid.uuid4().hex}/{name}"
