"""Per-source registry: totals, modes, baselines, cameras."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .intervals import timeline_counts


def source_totals(clips: DataFrame) -> DataFrame:
    return clips.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("num_clips"),
        F.round(F.sum("duration_sec"), 6).alias("total_duration_sec"),
        F.min("start_sec").alias("first_clip_start_sec"),
        F.max("end_sec").alias("last_clip_end_sec"),
    )


def source_registry(clips: DataFrame, cameras: DataFrame, expected: float = 10.0, tolerance: float = 0.001, unresolved_value: str = "UNRESOLVED") -> DataFrame:
    """A row per source with totals, timeline counts, and the camera of an explicit mapping or the catalog."""
    found = source_totals(clips).join(timeline_counts(clips, expected, tolerance), "source_id", "left").join(cameras, "source_id", "left")
    camera = F.coalesce(F.nullif("mapped_camera", F.lit("")), F.nullif("catalog_camera", F.lit("")), F.lit(unresolved_value))
    return found.withColumn("camera_id", camera).withColumn("camera_status", F.when(S.unresolved("camera_id"), "UNRESOLVED").otherwise("RESOLVED"))


def camera_report(registry: DataFrame) -> DataFrame:
    return registry.filter("camera_status = 'UNRESOLVED'").select("source_id", "num_clips", "camera_id", F.lit("no verified structured camera mapping").alias("evidence"))


def mode_per_source(rows: DataFrame, value: Column, ordinal: str) -> DataFrame:
    """The most frequent value of each source, the first seen of equally frequent ones."""
    counted = rows.groupBy("source_id", value.alias("mode_value")).agg(F.count(F.lit(1)).alias("mode_count"), F.min(ordinal).alias("_seen"))
    best = counted.groupBy("source_id").agg(F.max_by(F.struct("mode_value", "mode_count"), F.struct("mode_count", -F.col("_seen"))).alias("m"))
    return best.select("source_id", F.col("m.mode_value").alias("mode_value"), F.col("m.mode_count").alias("mode_count"))


def modal_anomalies(clips: DataFrame, relative_tolerance: float = 0.02) -> DataFrame:
    """Clips off their source's mode of frame rate or of resolution, where that mode occurs at least twice."""
    rows = clips.filter("source_id != '' and fps > 0 and width > 0 and height > 0")
    fps = mode_per_source(rows, F.round("fps", 3), "ordinal").select("source_id", F.col("mode_value").alias("mode_fps"), F.col("mode_count").alias("fps_count"))
    size = mode_per_source(rows, F.struct("width", "height"), "ordinal").select("source_id", F.col("mode_value").alias("mode_size"), F.col("mode_count").alias("size_count"))
    off_fps = (F.col("fps_count") >= 2) & (F.abs(F.col("fps") - F.col("mode_fps")) > F.greatest(F.lit(0.1), F.col("mode_fps") * relative_tolerance))
    off_size = (F.col("size_count") >= 2) & ((F.col("width") != F.col("mode_size.width")) | (F.col("height") != F.col("mode_size.height")))
    return rows.join(fps, "source_id").join(size, "source_id").select("clip_id", "source_id", off_fps.alias("fps_anomaly"), off_size.alias("resolution_anomaly"))


def baseline_issues(clips: DataFrame, fields: dict[str, float | None]) -> DataFrame:
    """Values that differ from the first non-empty one of their source, by a tolerance for numbers."""
    rows = clips.filter("source_id != ''")
    text = {f: F.nullif(F.col(f).cast("string"), F.lit("")) for f in fields}
    # One row for each source, summed up before the shuffle; the clips of a source are never in one task.
    base = rows.groupBy(F.col("source_id").alias("_s")).agg(*[F.min_by(v, F.when(v.isNotNull(), F.col("ordinal"))).alias(f"_b{i}") for i, v in enumerate(text.values())])
    parts = [F.struct(F.lit(f).alias("field"), v.alias("value"), F.col(f"_b{i}").alias("baseline"), F.lit(fields[f]).cast("double").alias("tolerance")) for i, (f, v) in enumerate(text.items())]
    based = rows.join(base, F.col("source_id") == F.col("_s")).select("clip_id", "source_id", F.explode(F.array(*parts)).alias("f")).select("clip_id", "source_id", "f.*")
    same = F.when(F.col("tolerance").isNull(), F.col("value") == F.col("baseline")).otherwise(F.coalesce(F.abs(S.number("value") - S.number("baseline")) <= F.col("tolerance"), F.lit(False)))
    return based.filter(F.col("value").isNotNull() & ~same).select("clip_id", "source_id", "field", "value", "baseline")


def selected_catalog(catalog: DataFrame, review: DataFrame) -> DataFrame:
    """The raw item of each source: the one eligible in review, none where several are; for sources without an eligible
    review row the one in the catalog, if it is alone there."""
    eligible = review.filter("coalesce(review_reason, '') = '' and coalesce(review_status, '') != 'rejected'").select("video_id").distinct()
    reviewed = catalog.join(eligible, "video_id", "left_semi").groupBy("source_video_id").agg(F.count(F.lit(1)).alias("n"), F.first("video_id").alias("v"))
    every = catalog.groupBy("source_video_id").agg(F.count(F.lit(1)).alias("all_n"), F.min("video_id").alias("all_v"))
    return every.join(reviewed, "source_video_id", "left").select(
        "source_video_id", F.when(F.col("n") == 1, F.col("v")).when(F.col("n").isNull() & (F.col("all_n") == 1), F.col("all_v")).alias("video_id")
    )
