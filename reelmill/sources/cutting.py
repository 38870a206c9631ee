"""Cut clips by a provider, with a log of markers for finished clips: what is done stays done, however often a run ends early.

A file is named by its clip and its content, and gets its name only when it is whole; then a marker that names it, with
size and hash, is put in place by a rename. So a marker is true of the file it names whichever attempt wrote it: a twin of a
task, or one that runs again, either finds the marker and accepts it or replaces it by one that is as true.

A task takes its jobs in slices of ``SLICE``; the markers of a slice are the lines of one file, named by the slice's ids and put in
place anew when ``FLUSH_SEC`` have passed since the last time, and at the slice's end. So clips that take long have their
marker at once, and short ones don't make a file each; a task that is lost costs what it cut within that time.

Markers are folded into a table now and then (``fold``), so that no folder holds a file for every clip for good.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator
from typing import Any, BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .media import _open
from .tables import path_exists

#: A provider writes the clip of a job (a row as a dict) to an open file. It may ask whether the run was cancelled, and raise Cancelled.
Cutter = Callable[[dict[str, Any], BinaryIO, Callable[[], bool]], None]
#: So many jobs share a file of markers, which is written again after so many seconds.
SLICE, FLUSH_SEC = 200, 1.0
MARKER = "clip_id string, path string, file_size_bytes long, sha256 string"
RESULT = f"{MARKER}, outcome string, error string"


class Cancelled(Exception):
    pass


class _Hashed:
    """What a provider writes to: a file, and the size and hash of what went into it."""

    def __init__(self, out: BinaryIO):
        self.out, self.size, self.sha = out, 0, hashlib.sha256()

    def write(self, chunk: bytes) -> int:
        self.out.write(chunk)
        self.size += len(chunk)
        self.sha.update(chunk)
        return len(chunk)


def _name(clip_id: str) -> str:
    """A file name for any id; ids that aren't plain names go by their hash."""
    plain = clip_id.replace("-", "").replace("_", "").isalnum() and clip_id.isascii() and len(clip_id) <= 100
    return clip_id if plain else "h" + hashlib.sha256(clip_id.encode()).hexdigest()


def _there(where, path: str) -> bool:
    from pyarrow import fs

    return where.get_file_info(path).type == fs.FileType.File


class _Late:
    """A file that is made at the first write, so that a provider that fails before costs none."""

    def __init__(self, where, path: str):
        self.where, self.path, self.out = where, path, None

    def write(self, chunk: bytes) -> int:
        if self.out is None:
            self.out = self.where.open_output_stream(self.path)
        return self.out.write(chunk)

    def close(self) -> None:
        self.write(b"")
        self.out.close()


def _put(where, place: str, write: Callable[[BinaryIO], Any]) -> None:
    """Write a file beside its place and rename it; a staged file that isn't whole is deleted."""
    staged = _Late(where, f"{place}.{uuid.uuid4().hex[:8]}.staged")
    try:
        named = write(staged) or place
        staged.close()
        where.move(staged.path, named)
    except BaseException:
        if staged.out is not None:
            staged.out.close()
            if _there(where, staged.path):
                where.delete_file(staged.path)
        raise


def _marked(logs, place: str) -> dict[str, dict[str, Any]]:
    """What a file of markers says of each clip."""
    if not _there(logs, place):
        return {}
    with logs.open_input_stream(place) as f:
        return {m["clip_id"]: m for m in map(json.loads, f.read().splitlines())}


def _cut_slice(jobs: list[dict[str, Any]], folder: str, log: str, cutter: Cutter, suffix: str) -> list[tuple]:
    """A row as in RESULT for each job, in their order."""
    where, home = _open(folder)
    logs, notes = _open(log)
    ids = sorted({job["clip_id"] for job in jobs})
    place = f"{notes}/markers/{hashlib.sha256(json.dumps(ids).encode()).hexdigest()[:32]}.json"
    known, fresh, flushed = _marked(logs, place), {}, time.monotonic()
    cancelled = lambda: _there(logs, f"{notes}/cancel")

    def flush() -> None:
        # A twin may have added to the file meanwhile: its markers stand but for the clips that this attempt has cut too.
        lines = "\n".join(json.dumps(m) for m in (_marked(logs, place) | fresh).values())
        _put(logs, place, lambda out: out.write(lines.encode()) and None)

    def one(job: dict[str, Any]) -> tuple:
        clip, name = job["clip_id"], _name(job["clip_id"])
        if found := fresh.get(clip) or known.get(clip):
            at, path = _open(found["path"])
            if at.get_file_info(path).size == found["file_size_bytes"]:
                return clip, found["path"], found["file_size_bytes"], found["sha256"], "found", None
        if cancelled():
            return clip, None, None, None, "cancelled", None
        made: dict[str, Any] = {}

        def write(out: BinaryIO) -> str:
            hashed = _Hashed(out)
            cutter(job, hashed, cancelled)
            content = hashed.sha.hexdigest()
            made.update(clip_id=clip, path=f"{folder}/{name}-{content[:12]}{suffix}", file_size_bytes=hashed.size, sha256=content)
            return f"{home}/{name}-{content[:12]}{suffix}"

        try:
            _put(where, f"{home}/{name}", write)
        except Cancelled:
            return clip, None, None, None, "cancelled", None
        except Exception as e:  # whatever a provider raises is this clip's failure, not the run's
            return clip, None, None, None, "failed", f"{type(e).__name__}: {e}"[:2000]
        fresh[clip] = made
        return *made.values(), "cut", None

    where.create_dir(home, recursive=True)
    logs.create_dir(f"{notes}/markers", recursive=True)
    rows, pending = [], 0
    try:
        for job in jobs:
            rows.append(one(job))
            pending += rows[-1][4] == "cut"
            if pending and time.monotonic() - flushed >= FLUSH_SEC:
                flush()
                pending, flushed = 0, time.monotonic()
    finally:  # a task that is told to end still says what it has cut
        if pending:
            flush()
    return rows


def _cut_one(job: dict[str, Any], folder: str, log: str, cutter: Cutter, suffix: str) -> tuple:
    return _cut_slice([job], folder, log, cutter, suffix)[0]


def finished(spark: SparkSession, log: str) -> DataFrame:
    """(clip_id, path, file_size_bytes, sha256) of finished clips: the folded ones and the markers, the markers' word being the later one."""
    empty = spark.createDataFrame([], MARKER)
    base = spark.read.schema(MARKER).parquet(f"{log}/folded") if path_exists(spark, f"{log}/folded") else empty
    marks = spark.read.schema(MARKER).option("pathGlobFilter", "*.json").json(f"{log}/markers") if path_exists(spark, f"{log}/markers") else empty
    both = base.withColumn("_by", F.lit(0)).unionByName(marks.withColumn("_by", F.lit(1))).filter("clip_id is not null")
    return both.groupBy("clip_id").agg(F.max_by(F.struct("path", "file_size_bytes", "sha256"), F.struct("_by", "path")).alias("_m")).select("clip_id", "_m.*")


def cut_clips(jobs: DataFrame, folder: str, log: str, cutter: Cutter, suffix: str = ".mp4") -> DataFrame:
    """(clip_id, path, file_size_bytes, sha256, outcome, error) after cutting each job that the log doesn't have, where the jobs lie.

    Outcomes: ``cut``, ``found`` (another attempt had finished it), ``failed`` and ``cancelled``; the last two leave no file
    and no marker, so the next run takes them up again. The result is lazy like any table: each time it is read, tasks look at the
    markers of their slices first. Defined cases: jobs without an id are left out, of jobs that repeat an id each is looked at in turn; where
    they lie in several slices, both cut it and either's marker counts; an empty table does nothing.
    """
    spark = jobs.sparkSession
    todo = jobs.filter("clip_id is not null").join(finished(spark, log).select("clip_id"), "clip_id", "left_anti").select(*jobs.columns)
    kind = T.StructType.fromDDL(RESULT)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            jobs_ = part.to_dict("records")
            for i in range(0, len(jobs_), SLICE):
                yield pd.DataFrame(_cut_slice(jobs_[i : i + SLICE], folder, log, cutter, suffix), columns=kind.names, dtype=object)

    return todo.mapInPandas(run, kind)


def cancel(spark: SparkSession, log: str) -> None:
    """Ask running tasks to stop: none begins another clip, and providers that ask stop within one."""
    from .sinks import write_text

    write_text(spark, "cancelled\n", f"{log}/cancel")


def resume(spark: SparkSession, log: str) -> None:
    """Take a cancellation back."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{log}/cancel")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)


def fold(spark: SparkSession, log: str) -> None:
    """Add the markers to the table of finished clips, then delete the markers it holds; where a run ends between the two, they count once all the same.

    No clips may be cut meanwhile.
    """
    if not path_exists(spark, f"{log}/markers"):
        return
    marks = spark.read.schema(MARKER).option("pathGlobFilter", "*.json").json(f"{log}/markers").filter("clip_id is not null")
    marks.write.mode("append").parquet(f"{log}/folded")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{log}/markers")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
