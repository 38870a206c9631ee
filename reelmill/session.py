"""Spark session defaults, and shipping of this package to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build(master: str = "local[*]", app: str = "reelmill", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; values given win."""
    base = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        BATCH: "2000",  # long texts make large batches
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def attach(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package wherever they run, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_reelmill_attached", False):
        return spark
    path = os.path.join(tempfile.mkdtemp(prefix="reelmill-code-"), "reelmill.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, f"reelmill/{p.relative_to(PACKAGE).as_posix()}")
    sc.addPyFile(path)
    sc._reelmill_attached = True
    # Long texts make large batches; where nobody has chosen a size, a smaller one bounds the workers' memory.
    if not spark._jsparkSession.sessionState().conf().contains(BATCH):
        spark.conf.set(BATCH, "2000")
    return spark
