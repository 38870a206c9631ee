"""Intermediate tables that outlive executors: written to the folder that the cluster names, and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a local one is set in local mode, and an error is raised on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        sc = spark.sparkContext
        # The context keeps a sub-folder of its own, on whatever file system it was given.
        folder = sc.getCheckpointDir()
        if not folder:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="reelmill-"))
            folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def stash(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: an executor lost later costs no recomputation of what came before,
    and the planner knows the true size of the table afterwards.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/reelmill-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._stashed_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of stashed tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_stashed_at", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
