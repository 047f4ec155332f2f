"""Session pieces that queries share."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, unless their Python finds it as the driver's does (by PYTHONPATH or working folder)."""
    root = Path(__file__).resolve().parent.parent
    known = {Path(p or ".").resolve() for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), "."]}
    application = spark.sparkContext.applicationId
    if root in known or application in _shipped:
        return
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="seamline-")) / "seamline"), "zip", root, "seamline")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, ``spark.checkpoint.dir``; only a local master may leave it unset."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="seamline-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return str(found).rstrip("/")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to tasks that adaptive execution does not merge: few bytes can be much work for Python."""
    return df.repartition(max(200, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)
