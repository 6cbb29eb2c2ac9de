"""Sessions, and shipping this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the tests and the benchmark use."""
    builder = SparkSession.builder.master(master).config("spark.sql.shuffle.partitions", shuffle_partitions)
    builder = builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once an application: Python workers import it from there."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="strandflow-"), "strandflow.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, f"strandflow/{p.relative_to(top)}")
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
