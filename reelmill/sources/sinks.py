"""Writers that appear whole or not at all."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def replace_dir(spark: SparkSession, staged: str, target: str) -> None:
    """Put a staged folder in a target's place. The old one is gone only once the new one has its name."""
    fs, new = _fs(spark, staged)
    _, place = _fs(spark, target)
    old = None
    if fs.exists(place):
        _, old = _fs(spark, f"{target}.old-{uuid.uuid4().hex[:8]}")
        fs.rename(place, old)
    if not fs.rename(new, place):
        if old is not None:
            fs.rename(old, place)
        raise OSError(f"{target} could not be put in place")
    if old is not None:
        fs.delete(old, True)


def write_table(df: DataFrame, target: str, fmt: str = "parquet", partition_by: list[str] | None = None, **options: str) -> None:
    """Write to a staging folder beside the target, then rename."""
    staged = f"{target}.staged-{uuid.uuid4().hex[:8]}"
    writer = df.write.format(fmt).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(staged)
    replace_dir(df.sparkSession, staged, target)


def write_csv(df: DataFrame, target: str, columns: list[str], single: bool = True) -> None:
    """A text table of fixed columns in fixed order: missing ones empty, others left out, NULL as empty text."""
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])
    write_table(out.coalesce(1) if single else out, target, "csv", header="true", emptyValue="", nullValue="")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small file on whatever file system, written beside its place and then renamed."""
    fs, place = _fs(spark, path)
    _, staged = _fs(spark, f"{path}.staged-{uuid.uuid4().hex[:8]}")
    fs.mkdirs(place.getParent())
    out = fs.create(staged, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    old = None
    if fs.exists(place):
        _, old = _fs(spark, f"{path}.old-{uuid.uuid4().hex[:8]}")
        fs.rename(place, old)
    if not fs.rename(staged, place):
        if old is not None:
            fs.rename(old, place)
        raise OSError(f"{path} could not be put in place")
    if old is not None:
        fs.delete(old, False)


def write_json(value: dict[str, Any], path: str, spark: SparkSession | None = None) -> None:
    """A small document as readable JSON, replaced at once: on the session's file systems, or without one on this machine."""
    text = json.dumps(value, ensure_ascii=False, indent=2) + "\n"
    if spark is not None:
        write_text(spark, text, path)
        return
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8") as f:
        f.write(text)
    os.replace(f.name, path)


#: What the document beside a downloaded file says, in this order. Fixed values.
SIDECAR = (
    "video_id", "channel_id", "channel_name", "title", "source_url", "item_type", "live_status", "local_status", "discovered_at", "scheduled_start",
    "capture_source", "actual_start", "record_started_at", "record_ended_at", "capture_complete", "duration_sec", "file_size_bytes", "sha256",
)


def sidecars(items: DataFrame, now: Column) -> DataFrame:
    """(video_id, document): the JSON beside each item's file. Fields that a table hasn't are null, completeness is true or false."""
    have = dict(items.dtypes)
    value = lambda c: F.lit(None).cast("string") if c not in have else F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'") if have[c] == "timestamp" else F.col(c)
    fields = [(F.coalesce(F.col(c) != 0, F.lit(False)) if c == "capture_complete" and c in have else F.lit(False) if c == "capture_complete" else value(c)).alias(c) for c in SIDECAR]
    return items.select("video_id", F.to_json(F.struct(*fields, F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("collected_at")), {"ignoreNullFields": "false"}).alias("document"))


def write_sidecars(items: DataFrame, now: Column, target: str) -> None:
    """The documents as a table of one JSON text a row, partitioned by item."""
    write_table(sidecars(items, now), target, "json")


def append_checkpoint(spark: SparkSession, done: DataFrame, manifest: str) -> DataFrame:
    """The manifest of finished clips after new ones: a row of a clip replaces the one it had. Written beside and put in place, so a crash leaves the old one."""
    from .tables import path_exists

    out = done
    if path_exists(spark, manifest):
        old = spark.read.parquet(manifest)
        out = old.join(done.select("clip_id"), "clip_id", "left_anti").unionByName(done, allowMissingColumns=True)
    write_table(out, manifest)
    return spark.read.parquet(manifest)


def write_events(events: DataFrame, target: str) -> None:
    """Events as JSON lines: keyframes parsed, times as numbers, nulls kept."""
    out = events.withColumns({c: F.col(c).try_cast("double") for c in ("start_time_sec", "violation_time_sec", "end_time_sec")}).withColumn(
        "bbox_keyframes", F.from_json(F.coalesce(F.nullif("bbox_keyframes", F.lit("")), F.lit("[]")), "array<struct<time_sec:double,bbox:array<double>>>")
    )
    write_table(out, target, "json", ignoreNullFields="false")


def summary_text(row: dict[str, Any]) -> str:
    return "\n".join(f"{k.replace('_', ' ')}: {json.dumps(v, ensure_ascii=False) if isinstance(v, (dict, list)) else v}" for k, v in row.items())
