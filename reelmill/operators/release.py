"""Freezing a validated set, backups and restores."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.media import copy_files, hashed_files
from ..sources.sinks import replace_dir, write_events, write_table
from ..sources.tables import path_exists
from ..storage import stash
from . import split as splits_


class ReleaseError(ValueError):
    pass


def frozen_paths(clips: DataFrame, splits: DataFrame) -> DataFrame:
    """Clips with their split and their path in the release."""
    return clips.join(splits.select("clip_id", "split"), "clip_id").withColumn("frozen_path", F.concat_ws("/", F.lit("videos"), "split", S.basename("local_path")))


def checksums(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256) of every file below a folder, paths relative to it. Files are read in chunks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    relative = F.regexp_replace("path", "^.*/" + re.escape(root.rstrip("/").rsplit("/", 1)[-1]) + "/", "")
    return hashed_files(files).select(relative.alias("path"), "sha256").filter(~F.col("path").startswith("checksums"))


def freeze(target: str, issues: DataFrame, clips: DataFrame, splits: DataFrame, scenarios: DataFrame, events: DataFrame, sources: DataFrame, media_root: str | None = None) -> dict[str, Any]:
    """Write a release: nothing while there are errors or something is in its place, and all of it or none.

    Tables go to a staging folder, clips partitioned by split; with a ``media_root`` the clips' files are copied to their
    split's folder and compared; a table of checksums is added, then the folder is renamed.
    """
    spark = clips.sparkSession
    if issues.filter("severity = 'ERROR'").limit(1).count():
        raise ReleaseError("the set has errors")
    if path_exists(spark, target):
        raise ReleaseError(f"{target} exists")
    staged = f"{target}.staged"
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(staged)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(fs_path, True)
    try:
        write_table(frozen_paths(clips, splits), f"{staged}/clips", partition_by=["split"])
        write_table(splits, f"{staged}/splits")
        write_table(scenarios, f"{staged}/scenarios")
        write_table(sources.join(clips.select("source_video_id").distinct(), "source_video_id", "left_semi"), f"{staged}/sources")
        write_events(events, f"{staged}/events")
        if media_root is not None:
            files = frozen_paths(clips, splits).select(F.concat_ws("/", F.lit(media_root), "local_path").alias("source"), F.concat_ws("/", F.lit(staged), "frozen_path").alias("target"), F.lit(None).cast("double").alias("size"), "sha256")
            _copy_all(files)
        summary = splits_.summary(clips, splits, scenarios).first().asDict()
        write_table(checksums(spark, staged), f"{staged}/checksums")
        replace_dir(spark, staged, target)
    except Exception:
        fs.delete(fs_path, True)
        raise
    return summary


def verify(spark: SparkSession, root: str) -> DataFrame:
    """Files of a release that are missing, changed or not listed."""
    listed = spark.read.parquet(f"{root}/checksums").alias("a")
    there = checksums(spark, root).alias("b")
    both = listed.join(there, F.col("a.path") == F.col("b.path"), "full_outer")
    return both.select(F.coalesce("a.path", "b.path").alias("path"), F.when(F.col("b.path").isNull(), "missing").when(F.col("a.path").isNull(), "unlisted").when(F.col("a.sha256") != F.col("b.sha256"), "changed").alias("problem")).filter("problem is not null")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _copy_all(plan: DataFrame) -> int:
    """Copy and verify; the number of files, or an error that names the first that failed."""
    done = stash(copy_files(plan), "copies")
    n, bad = done.agg(F.count(F.lit(1)), F.count("error")).first()
    if bad:
        first = done.filter("error is not null").orderBy("target").first()
        raise ReleaseError(f"{bad} files were not copied; {first.source}: {first.error}")
    return n


def _plan(items: DataFrame, source: Column, target: str, name: str) -> DataFrame:
    return items.select(F.concat_ws("/", source, F.lit(name)).alias("source"), F.concat_ws("/", F.lit(target), "channel_id", "video_id", F.lit(name)).alias("target"), F.col("file_size_bytes").alias("size") if name == "source.mp4" else F.lit(None).cast("bigint").alias("size"), F.col("sha256") if name == "source.mp4" else F.lit(None).cast("string").alias("sha256"))


def completed(items: DataFrame) -> DataFrame:
    """Completed items, all of which have safe ids, a size and a hash."""
    done = items.filter("local_status = 'COMPLETED'")
    safe = F.col("channel_id").rlike("^[A-Za-z0-9_-]+$") & F.col("video_id").rlike("^[A-Za-z0-9_-]+$") & F.col("file_size_bytes").isNotNull() & (F.coalesce("sha256", F.lit("")) != "")
    bad = done.filter(~F.coalesce(safe, F.lit(False))).limit(1).collect()
    if bad:
        raise ReleaseError(f"invalid completed item {bad[0].video_id!r}")
    return done


def backup(items: DataFrame, jobs: DataFrame, target: str, project_root: str | None = None) -> dict[str, Any]:
    """Save the catalog and the media of completed items, with the document beside each: all of it or nothing.

    It is refused while jobs run, if something is in the target's place, or if that lies inside the project. Files are copied by the
    tasks, and what arrived is compared with the recorded size and hash.
    """
    spark = items.sparkSession
    if jobs.filter("status = 'RUNNING'").limit(1).count():
        raise ReleaseError("jobs are running")
    if path_exists(spark, target):
        raise ReleaseError(f"{target} exists")
    if project_root is not None and f"{target.rstrip('/')}/".startswith(f"{project_root.rstrip('/')}/"):
        raise ReleaseError("the backup must be outside the project")
    done = completed(items)
    here = F.regexp_replace("local_path", "/[^/]*$", "")
    try:
        n = _copy_all(_plan(done, here, f"{target}/media", "source.mp4").unionByName(_plan(done, here, f"{target}/media", "metadata.json"))) // 2
        write_table(items, f"{target}/items")
        write_table(jobs, f"{target}/jobs")
        size = done.agg(F.coalesce(F.sum("file_size_bytes"), F.lit(0))).first()[0]
        manifest = {"format": 1, "items": n, "bytes": size}
        write_table(spark.createDataFrame([(json.dumps(manifest),)], "value string"), f"{target}/manifest", "text")
    except Exception:
        _delete(spark, target)
        raise
    return manifest


def restore(spark: SparkSession, source: str, existing: DataFrame, media_root: str, project_root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, jobs) of a backup, whose media are copied below a new root, verified, and named in ``local_path``.

    It is refused if the catalog has items or there are media below the root; if anything fails, no copied file is left.
    """
    if not path_exists(spark, f"{source}/manifest") or not path_exists(spark, f"{source}/items"):
        raise ReleaseError(f"{source} is no backup")
    try:
        version = json.loads("".join(r[0] for r in spark.read.text(f"{source}/manifest").limit(100).collect()))["format"]
    except (ValueError, KeyError, TypeError) as e:
        raise ReleaseError("the backup's manifest can't be read") from e
    if version != 1:
        raise ReleaseError(f"unknown format {version!r}")
    if existing.limit(1).count():
        raise ReleaseError("the catalog isn't empty")
    if path_exists(spark, media_root) and spark.read.format("binaryFile").option("recursiveFileLookup", True).load(media_root).select("path").filter("path not like '%/.gitkeep'").limit(1).count():
        raise ReleaseError(f"{media_root} isn't empty")
    if project_root is not None and f"{source.rstrip('/')}/".startswith(f"{project_root.rstrip('/')}/"):
        raise ReleaseError("the backup must be outside the project")
    items = spark.read.parquet(f"{source}/items")
    done = completed(items)
    there = F.concat_ws("/", F.lit(f"{source}/media"), "channel_id", "video_id")
    try:
        _copy_all(_plan(done, there, media_root, "source.mp4").unionByName(_plan(done, there, media_root, "metadata.json")))
    except Exception:
        _delete(spark, media_root)
        raise
    path = F.concat_ws("/", F.lit(media_root), "channel_id", "video_id", F.lit("source.mp4"))
    return items.withColumn("local_path", F.when(F.col("local_status") == "COMPLETED", path).otherwise(F.col("local_path"))), spark.read.parquet(f"{source}/jobs")


def reconcile(jobs: DataFrame, verified: DataFrame, prior: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(manifest, incomplete): the manifest rebuilt from files that exist, are readable and as long as cut, within a second.

    A prior row with another interval or content is an error; what people had assigned in it is carried over.
    """
    files = verified.select(F.col("clip_id").alias("_f"), F.col("duration_sec").alias("_d"), F.col("sha256").alias("_sha"), F.col("readable").alias("_ok"), F.col("path").alias("_path"))
    rows = jobs.join(files, F.col("clip_id") == F.col("_f"), "left")
    good = F.coalesce(F.col("_ok") & (F.abs(F.col("_d") - (F.col("end_sec") - F.col("start_sec"))) <= 1.0), F.lit(False))
    old = prior.select(F.col("clip_id").alias("_o"), F.col("start_sec").alias("_os"), F.col("end_sec").alias("_oe"), F.col("sha256").alias("_osha"), *[F.col(c).alias(f"_o_{c}") for c in ("camera_id", "view_id", "session_id")])
    made = rows.filter(good).join(old, F.col("clip_id") == F.col("_o"), "left")
    clash = made.filter("_o is not null and (_os != start_sec or _oe != end_sec or _osha != _sha)")
    if clash.limit(1).count():
        raise ReleaseError("an interval or a file differs from the manifest")
    manifest = made.select("clip_id", "source_video_id", "start_sec", "end_sec", F.round(F.col("end_sec") - F.col("start_sec"), 3).alias("duration_sec"), F.col("_path").alias("local_path"), F.col("_sha").alias("sha256"), *[F.coalesce(f"_o_{c}", F.lit("")).alias(c) for c in ("camera_id", "view_id", "session_id")])
    return manifest, rows.filter(F.col("_f").isNotNull() & ~good).select("clip_id")
