"""One-row summaries, made by a single aggregate each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNREVIEWED = ""


def _counts(column: str, values: tuple[str, ...], prefix: str) -> list:
    return [F.count_if(F.col(column) == v).alias(f"{prefix}_{v.lower()}") for v in values]


def quality_summary(clips: DataFrame, issues: DataFrame) -> DataFrame:
    """Clips by status, hours, and the issues by type as a map."""
    total = clips.agg(F.count(F.lit(1)).alias("clips"), *_counts("status", ("PASS", "WARNING", "FAIL"), "status"), F.round(F.sum("duration_sec") / 3600, 3).alias("total_hours"))
    by_type = issues.groupBy("code").agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "n")))).alias("issue_types"))
    return total.crossJoin(by_type)  # a row each


def metadata_summary(rows: DataFrame, issues: DataFrame) -> DataFrame:
    """Rows by status, what is distinct, unresolved cameras, and counts of the issues that matter, each clip once."""
    of = lambda code: F.count_distinct(F.when(F.col("code") == code, F.coalesce("clip_id", F.lit("")))).alias(code.lower())
    total = rows.agg(
        F.count(F.lit(1)).alias("clips"),
        F.count_distinct("source_id").alias("sources"),
        F.count_distinct("camera_id").alias("cameras"),
        F.round(F.sum("duration_sec"), 6).alias("total_duration_sec"),
        *_counts("metadata_status", ("PASS", "WARNING", "FAIL"), "metadata"),
        F.count_if(F.col("camera_id") == "UNRESOLVED").alias("unresolved_camera_clips"),
        F.count_distinct(F.struct("width", "height")).alias("resolutions"),
        F.count_distinct("codec").alias("codecs"),
    )
    found = issues.agg(*[of(c) for c in ("CHECKSUM_MISMATCH", "METADATA_INVENTORY_MISMATCH", "MISSING_FILE", "ORPHAN_INVENTORY_RECORD", "ORPHAN_CLIP_FILE", "TIMELINE_GAP", "EXCESS_TEMPORAL_OVERLAP")])
    return total.crossJoin(found)  # a row each


def selection_summary(rows: DataFrame) -> DataFrame:
    """Per source, what was selected and its share of all that was."""
    picked = rows.filter("selection_status = 'REVIEW_POOL'")
    total = picked.agg(F.count(F.lit(1)).alias("_all"))
    per = rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("selection_status") == "REVIEW_POOL").alias("selected"))
    return per.crossJoin(F.broadcast(total)).select("source_id", "candidates", "selected", F.round(F.try_divide(100.0 * F.col("selected"), F.col("_all")), 2).alias("percent"))


def analysis_summary(rows: DataFrame) -> DataFrame:
    """How many candidates were reused, newly analysed and failed."""
    return rows.agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(F.col("origin") == "cache").alias("reused"),
        F.count_if((F.col("origin") == "new") & (F.col("signal_status") == "COMPUTED")).alias("analysed"),
        F.count_if(F.col("signal_status") == "FAILED").alias("failed"),
    )
