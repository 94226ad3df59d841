"""Session helpers: a local session for tests, and shipping the package to workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once for a Spark context.

    Nothing is sent where the workers' PYTHONPATH already has the repository.
    """
    context = spark.sparkContext
    if getattr(context, "_marlstone_shipped", False):
        return
    inherited = (context._jvm.System.getenv("PYTHONPATH") or "").split(os.pathsep)
    if str(ROOT) not in inherited:
        folder = tempfile.mkdtemp(prefix="marlstone-ship-")
        target = f"{folder}/marlstone_package.zip"
        with zipfile.ZipFile(target, "w") as out:
            for path in sorted((ROOT / "marlstone").rglob("*.py")):
                out.write(path, path.relative_to(ROOT))
        context.addPyFile(target)
    context._marlstone_shipped = True
