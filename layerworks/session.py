"""Session settings the operators are tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Documents are wide rows: few of them make a batch for the parser slot.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def local_session(cores: int | str = "*", memory: str = "8g", name: str = "layerworks") -> SparkSession:
    """Single-machine session for tests and the bench."""
    partitions = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder every executor can reach (``spark.checkpoint.dir``).

    Without that setting only a local session gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _test_folder()
    return f"{root.rstrip('/')}/layerworks/{name}-{uuid.uuid4().hex}"
