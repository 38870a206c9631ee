"""The catalog's two tables as a base and deltas on any file system: what a batch writes is in proportion to what it changes."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog
from ..sources.sinks import write_text
from ..sources.tables import path_exists

#: Table to its columns and its key.
TABLES = {"items": (catalog.ITEMS, "video_id"), "jobs": (catalog.JOBS, "id")}
#: A new base is written when the deltas hold more than this share of its rows, or are this many.
COMPACT_SHARE, COMPACT_DELTAS = 0.5, 32
#: Versions whose files stay for those who are still reading them.
KEPT_VERSIONS = 2


class Snapshots:
    """Two tables in versions. A version is a manifest: for each table a base folder, and deltas in the order they came.

    A delta holds the rows that a batch changed, or made go, each whole; of a key the last one counts. Reading takes the
    base's rows whose keys no delta has, and the last of each delta key. Folders are written first, then the manifest is
    put in place at once under the next number, and the highest number is the current version; so a crash anywhere leaves the
    version before, and at worst folders that nobody names; the next write deletes these. The files of the last
    KEPT_VERSIONS versions stay, so a table that was read keeps its files while the next version is written, a compaction included.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, str(root).rstrip("/")

    # ---- manifests ----------------------------------------------------------------------------------------------

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self, folder: str) -> list[str]:
        fs, at = self._fs(folder)
        return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []

    @property
    def version(self) -> int:
        """The number of the current version; 0 before the first write."""
        return max((int(n.removesuffix(".json")) for n in self._names("manifests") if n.removesuffix(".json").isdigit()), default=0)

    def _manifest(self, version: int) -> dict[str, Any]:
        if not version:
            return {"batch": -1} | {t: {"base": None, "rows": 0, "deltas": []} for t in TABLES}
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.root}/manifests/{version}.json").collect()))

    @property
    def last_batch(self) -> int:
        return int(self._manifest(self.version)["batch"])

    # ---- reading ------------------------------------------------------------------------------------------------

    def _table(self, name: str, entry: dict[str, Any]) -> DataFrame:
        schema, key = TABLES[name]
        empty = self.spark.createDataFrame([], schema)
        base = self.spark.read.schema(schema).parquet(f"{self.root}/{entry['base']}") if entry["base"] else empty
        if not entry["deltas"]:
            return base
        parts = [self.spark.read.schema(f"{schema}, _gone boolean").parquet(f"{self.root}/{d['path']}").withColumn("_seq", F.lit(i)) for i, d in enumerate(entry["deltas"])]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        last = rows.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*empty.columns, "_gone"), "_seq").alias("r"))
        # The keys of deltas are few beside the base's, and then they are what the planner broadcasts.
        return base.join(last.select("_k"), F.col(key) == F.col("_k"), "left_anti").unionByName(last.filter("not r._gone").select("r.*").drop("_gone"))

    def read(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The tables of the current version, or of one that is still kept."""
        manifest = self._manifest(self.version if version is None else version)
        items, jobs = (self._table(t, manifest[t]) for t in TABLES)
        return items, jobs

    # ---- writing ------------------------------------------------------------------------------------------------

    def _delta(self, name: str, new: DataFrame, old: DataFrame) -> dict[str, Any]:
        """Write the rows of ``new`` that aren't in ``old`` as they are, and keys that went; returns where and how many. A column that ``new`` hasn't is NULL."""
        key = TABLES[name][1]
        columns = old.columns
        # Of the old side only keys and hashes travel; a row whose hashes are the same is the same. A hash passes over
        # nulls, so where they stand is hashed too.
        empty = [F.isnull(c) for c in columns]
        hashes = F.struct(F.xxhash64(*columns, *empty), F.xxhash64(*empty, *reversed(columns)))
        rows = new.select(*[(F.col(c) if c in new.columns else F.lit(None)).cast(kind).alias(c) for c, kind in old.dtypes]).withColumn("_h", hashes)
        before = old.select(F.col(key).alias("_k"), hashes.alias("_was"))
        both = rows.join(before, F.col(key) == F.col("_k"), "full_outer").filter(~F.col("_h").eqNullSafe(F.col("_was")))
        gone = F.col(key).isNull()
        changed = both.select(*[F.coalesce(F.col(c), F.col("_k")).alias(c) if c == key else F.col(c) for c in columns], gone.alias("_gone"))
        path = f"deltas/{uuid.uuid4().hex}/{name}"
        changed.write.parquet(f"{self.root}/{path}")
        n = self.spark.read.schema(f"{TABLES[name][0]}, _gone boolean").parquet(f"{self.root}/{path}").count()
        return {"path": path, "rows": n}

    def _grown(self, name: str, entry: dict[str, Any], delta: dict[str, Any]) -> dict[str, Any]:
        """A table's entry with one more delta, or with a new base where the deltas have become many."""
        entry = entry | {"deltas": [*entry["deltas"], *([delta] if delta["rows"] else [])]}
        held = sum(d["rows"] for d in entry["deltas"])
        if held <= COMPACT_SHARE * entry["rows"] and len(entry["deltas"]) < COMPACT_DELTAS:
            return entry
        path = f"bases/{uuid.uuid4().hex}/{name}"
        self._table(name, entry).write.parquet(f"{self.root}/{path}")
        return {"base": path, "rows": self.spark.read.schema(TABLES[name][0]).parquet(f"{self.root}/{path}").count(), "deltas": []}

    def write(self, items: DataFrame, jobs: DataFrame, batch: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Make these the current tables; returns them as they were written."""
        version = self.version + 1
        manifest = self._manifest(version - 1)
        deltas = {t: self._delta(t, new, self._table(t, manifest[t])) for t, new in (("items", items), ("jobs", jobs))}
        # What was unique stays so but for the items whose jobs have changed.
        touched = self.spark.read.schema(f"{catalog.JOBS}, _gone boolean").parquet(f"{self.root}/{deltas['jobs']['path']}").select("video_id").distinct()
        grown = {"jobs": manifest["jobs"] | {"deltas": [*manifest["jobs"]["deltas"], deltas["jobs"]]}}
        if deltas["jobs"]["rows"] and catalog.broken_uniqueness(self._table("jobs", grown["jobs"]).join(touched, "video_id", "left_semi")).limit(1).count():
            raise ValueError("an item has two active jobs")
        after = {t: self._grown(t, manifest[t], deltas[t]) for t in TABLES}
        if path_exists(self.spark, f"{self.root}/manifests/{version}.json"):
            raise RuntimeError(f"version {version} was written by somebody else meanwhile")
        write_text(self.spark, json.dumps(after | {"batch": manifest["batch"] if batch is None else batch}), f"{self.root}/manifests/{version}.json")
        self._vacuum(version)
        return self.read(version)

    def _vacuum(self, version: int) -> None:
        """Delete manifests beyond the kept ones, and folders that no kept manifest names."""
        named = set()
        for v in range(max(1, version - KEPT_VERSIONS + 1), version + 1):
            manifest = self._manifest(v)
            for entry in (manifest[t] for t in TABLES):
                named |= {p.rsplit("/", 1)[0] for p in (entry["base"], *(d["path"] for d in entry["deltas"])) if p}
        gone = [f"{folder}/{n}" for folder in ("bases", "deltas") for n in self._names(folder) if f"{folder}/{n}" not in named]
        for path in (*gone, f"manifests/{version - KEPT_VERSIONS}.json"):
            fs, at = self._fs(path)
            fs.delete(at, True)
