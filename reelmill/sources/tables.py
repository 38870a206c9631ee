"""Readers: text tables, media inventories, sidecars, probe documents, id lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from .media import hashed_files

PROBE = "struct<format:struct<duration:string>,streams:array<struct<codec_type:string,codec_name:string,width:int,height:int,avg_frame_rate:string,r_frame_rate:string,nb_frames:string,duration:string>>>"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, on whatever file system, is there."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A text table with a header; a missing file is an empty table. Empty text is NULL."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(text).csv(path)
    return rows.select(*[F.nullif(F.col(f.name), F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema])


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file without blanks, comments and a byte order mark."""
    line = F.trim(F.regexp_replace("value", "^\\x{FEFF}", ""))
    return spark.read.text(path).select(line.alias("reference")).filter((F.col("reference") != "") & ~F.col("reference").startswith("#"))


def media_paths(spark: SparkSession, root: str) -> DataFrame:
    """Paths of media below a folder, contents unread; a missing folder has none."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path").filter(F.col("path").rlike(S.MEDIA_SUFFIX))


def media_files(spark: SparkSession, root: str) -> DataFrame:
    """Media below a folder with size and SHA-256: (path, file_size_bytes, sha256). Files are read in chunks, whatever their size."""
    return hashed_files(media_paths(spark, root)).select("path", "file_size_bytes", "sha256")


def read_sidecars(spark: SparkSession, root: str, fields: list[str], name: str = "metadata.json") -> DataFrame:
    """(path, fields...) of the JSON document beside each media file, as text: ``path`` is the media file's. A broken document has no values."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], ", ".join(["path string", *(f"{f} string" for f in fields)]))
    files = media_paths(spark, root).withColumn("_dir", F.regexp_replace("path", "/[^/]*$", ""))
    docs = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(root, wholetext=True).select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_d"), "value")
    rows = files.join(docs, F.col("_dir") == F.col("_d"))
    return rows.select("path", *[F.get_json_object("value", f"$.{f}").alias(f) for f in fields])


def probed(raw: Column | str) -> Column:
    """struct<duration_sec, fps, width, height, codec, frame_count, reason> of a probe's JSON: its first video stream."""
    doc = F.from_json(F.col(raw) if isinstance(raw, str) else raw, PROBE)
    video = F.get(F.filter(doc["streams"], lambda s: s["codec_type"] == "video"), F.lit(0))
    reason = F.when(doc.isNull() | doc["streams"].isNull(), "unreadable").when(video.isNull(), "no_video_stream")
    return F.struct(
        S.number(F.coalesce(doc["format"]["duration"], video["duration"])).alias("duration_sec"),
        F.when(S.rate(video["avg_frame_rate"]) > 0, S.rate(video["avg_frame_rate"])).otherwise(S.rate(video["r_frame_rate"])).alias("fps"),
        video["width"].alias("width"),
        video["height"].alias("height"),
        video["codec_name"].alias("codec"),
        video["nb_frames"].try_cast("bigint").alias("frame_count"),
        reason.alias("reason"),
    )


def probe_with_fallback(first: str, second: str) -> Column:
    """The first probe, else the second, with which one it was; both are columns of JSON text."""
    a, b = probed(first), probed(second)
    pick = lambda n: F.when(a["reason"].isNull(), a[n]).when(b["reason"].isNull(), b[n]).alias(n)
    source = F.when(a["reason"].isNull(), "probe").when(b["reason"].isNull(), "fallback").otherwise("unavailable").alias("metadata_source")
    return F.struct(*[pick(n) for n in ("duration_sec", "fps", "width", "height", "codec", "frame_count")], source, F.coalesce(a["reason"], F.lit("")).alias("reason"))


def sidecar_overlay(files: DataFrame, sidecars: DataFrame, catalog: DataFrame, fields: list[str]) -> DataFrame:
    """Files with their metadata: what the catalog has wins over the sidecar. Both are keyed by path."""
    side = sidecars.select(F.col("path").alias("_sp"), *[F.col(f).alias(f"_s_{f}") for f in fields])
    cat = catalog.filter("local_path is not null").select(F.col("local_path").alias("_cp"), *[F.col(f).alias(f"_c_{f}") for f in fields])
    rows = files.join(side, F.col("path") == F.col("_sp"), "left").join(cat, F.col("path") == F.col("_cp"), "left")
    return rows.select(*files.columns, *[F.coalesce(f"_c_{f}", f"_s_{f}").alias(f) for f in fields])


def build_inventory(files: DataFrame, probes: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row per file: stable id, probe, hash, metadata. An id that comes up twice is an error."""
    rows = files.join(metadata, "path", "left").join(probes.select("path", probed("probe").alias("p")), "path", "left")
    out = rows.select(S.item_id(F.coalesce("source", F.lit("local")), F.coalesce("source_video_id", S.stem("path")), "path").alias("video_id"), "path", S.basename("path").alias("filename"), "file_size_bytes", "sha256", "source", "source_video_id", "p.*")
    twice = out.groupBy("video_id").count().filter("count > 1")
    if twice.limit(1).count():
        raise ValueError("duplicate item id")
    return out


def download_verdict() -> Column:
    """struct<ok, reason> of a downloaded file (exists, file_size_bytes, probe_reason, duration_sec): a duration has to be positive only if it is known."""
    out = lambda r: F.struct(F.lit(r == "").alias("ok"), F.lit(r).alias("reason"))
    return (
        F.when(~F.coalesce(F.col("exists"), F.lit(False)), out("missing_file"))
        .when(F.coalesce("file_size_bytes", F.lit(0)) <= 0, out("empty_file"))
        .when(F.coalesce("probe_reason", F.lit("")) != "", out("no_video_stream"))
        .when(F.col("duration_sec") <= 0, out("invalid_duration"))
        .otherwise(out(""))
    )


def decode_points(duration: Column | str) -> Column:
    """The times whose frames a decode check looks at: the first, the middle, and a second before the end."""
    d = F.coalesce(S.number(duration), F.lit(0.0))
    return F.array(F.lit(0.0), d / 2, F.greatest(F.lit(0.0), d - 1))


def decode_verdict(frames_ok: Column | str, full_ok: Column | str | None = None) -> Column:
    """struct<ok, errors> of a decode check: all three frames, and the whole file where that was asked for, have to decode."""
    found = F.col(frames_ok) if isinstance(frames_ok, str) else frames_ok
    bad = F.size(F.filter(found, lambda x: ~F.coalesce(x, F.lit(False)))) + F.greatest(F.lit(0), 3 - F.size(found))
    full = F.lit(0) if full_ok is None else F.when(F.coalesce(F.col(full_ok) if isinstance(full_ok, str) else full_ok, F.lit(False)), 0).otherwise(1)
    errors = bad + full
    return F.struct((errors == 0).alias("ok"), errors.cast("int").alias("errors"))


def normalized_items(raw: DataFrame) -> DataFrame:
    """Raw item metadata as discoveries: bad ids go, an unknown status stays ``unknown``, a start counts only for live items."""
    status = F.when(F.col("live_status").isin("is_upcoming", "is_live", "was_live", "not_live"), F.col("live_status")).otherwise("unknown")
    live = status.isin("is_live", "was_live")
    return raw.filter(F.col("id").rlike(S.VIDEO_ID)).select(
        F.col("id").alias("video_id"),
        "channel_id",
        "channel_name",
        "title",
        F.concat(F.lit("https://www.youtube.com/watch?v="), "id").alias("source_url"),
        F.when(status == "not_live", "vod").when(status == "unknown", "unknown").otherwise("live").alias("item_type"),
        status.alias("live_status"),
        F.when(status == "is_upcoming", S.instant("release_timestamp")).alias("scheduled_start"),
        F.when(live, S.instant(F.coalesce("release_timestamp", "timestamp"))).alias("actual_start"),
        F.col("duration").cast("double").alias("duration_sec"),
    )
