from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

DATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    with tempfile.TemporaryDirectory() as folder:
        session = (
            SparkSession.builder.master("local[4]")
            .config("spark.sql.shuffle.partitions", "4")
            .config("spark.driver.memory", "4g")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.checkpoint.dir", f"file://{folder}/checkpoints")
            .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
            .getOrCreate()
        )
        session.sparkContext.setLogLevel("ERROR")
        session.sparkContext.setCheckpointDir(f"file://{folder}/checkpoints")
        yield session
        session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return f"{DATA}/sf0.001"
