"""What the library needs of a session."""

from __future__ import annotations

import os
import re
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def workers_find_library(spark: SparkSession) -> SparkSession:
    """Lets Python workers that start beside the driver import this package. On a cluster ship it with --py-files."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, path) if x)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the session names. Only a session in one process gets one of our own where it names none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(shared or f"file://{tempfile.mkdtemp(prefix='tessera-')}")
    return context.getCheckpointDir().rstrip("/")
