"""voxlake: speech-corpus construction, curation and scoring as DataFrame transformations."""

from __future__ import annotations

import os
from pathlib import Path


def reach_workers(spark) -> None:
    """Python workers that start from now on find this package where the driver found it (on a cluster, ship it)."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")]))
