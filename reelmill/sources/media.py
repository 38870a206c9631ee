"""Files of any size: hashed and copied in chunks by the tasks, on whatever file system their paths name."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 20


def _open(path: str):
    """(file system, path on it) of a path or URI."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


def file_hash(path: str) -> tuple[int, str]:
    """Size and SHA-256 of a file, a chunk at a time."""
    where, name = _open(path)
    size, sha = 0, hashlib.sha256()
    with where.open_input_stream(name) as f:
        while chunk := f.read(CHUNK):
            size += len(chunk)
            sha.update(chunk)
    return size, sha.hexdigest()


def copy_checked(source: str, target: str, size: int | None, sha256: str | None) -> None:
    """Copy a file under another name, compare what was written with what is wanted, then give it its name."""
    from pyarrow import fs

    (a, name), (b, place) = _open(source), _open(target)
    b.create_dir(place.rsplit("/", 1)[0], recursive=True)
    staged, n, sha = f"{place}.staged", 0, hashlib.sha256()
    try:
        with a.open_input_stream(name) as f, b.open_output_stream(staged) as out:
            while chunk := f.read(CHUNK):
                out.write(chunk)
                n += len(chunk)
                sha.update(chunk)
        # What arrived is read again: a copy counts by what is on the other side.
        if file_hash_on(b, staged) != (n, sha.hexdigest()) or (size is not None and n != size) or (sha256 is not None and sha.hexdigest() != sha256):
            raise ValueError("differs from what is recorded")
        b.move(staged, place)
    finally:
        if b.get_file_info(staged).type != fs.FileType.NotFound:
            b.delete_file(staged)


def file_hash_on(where, name: str) -> tuple[int, str]:
    size, sha = 0, hashlib.sha256()
    with where.open_input_stream(name) as f:
        while chunk := f.read(CHUNK):
            size += len(chunk)
            sha.update(chunk)
    return size, sha.hexdigest()


def _hashes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for path in part["path"]:
            try:
                rows.append((path, *file_hash(path), None))
            except OSError as e:
                rows.append((path, None, None, f"{type(e).__name__}: {e}"[:2000]))
        yield pd.DataFrame(rows, columns=["path", "file_size_bytes", "sha256", "error"]).astype({"file_size_bytes": "Int64"})


def hashed_files(paths: DataFrame) -> DataFrame:
    """(path, file_size_bytes, sha256, error) of files by path: each is read once, in chunks, so its size doesn't matter."""
    return paths.select("path").mapInPandas(_hashes, "path string, file_size_bytes bigint, sha256 string, error string")


def _copies(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for r in part.itertuples():
            try:
                copy_checked(r.source, r.target, None if pd.isna(r.size) else int(r.size), r.sha256 if isinstance(r.sha256, str) else None)
                rows.append((r.source, r.target, None))
            except (OSError, ValueError) as e:
                rows.append((r.source, r.target, f"{type(e).__name__}: {e}"[:2000]))
        yield pd.DataFrame(rows, columns=["source", "target", "error"], dtype=object)


def copy_files(plan: DataFrame) -> DataFrame:
    """(source, target, error) after copying each file of (source, target, size, sha256) and verifying the copy.

    Sizes and hashes that are NULL aren't asked for. The copying happens where the rows lie; a task that runs again copies again.
    """
    named = plan.select("source", "target", F.col("size").cast("double").alias("size"), "sha256")
    return named.mapInPandas(_copies, "source string, target string, error string")
