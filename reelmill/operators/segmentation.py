"""From reviewed items to clip candidates: which items are eligible, their intervals, and what people had decided."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import intervals
from .selection import carry_forward, regenerate

DECISIONS = ("scenario_hint", "status", "note")
CANDIDATES = ("clip_candidate_id", "source_video_id", "start_sec", "end_sec", "duration_sec", *DECISIONS)


class SegmentationError(ValueError):
    pass


def eligible_sources(review: DataFrame, items: DataFrame, validation: DataFrame, strict: bool = False) -> DataFrame:
    """The one item of each source that has no reason against it, wasn't rejected and is valid.

    Two such items of one source are an error. So is, where ``strict``, a review row of an unknown item; otherwise it is
    passed over. An empty source is a source like any other.
    """
    if strict and review.join(items, "video_id", "left_anti").limit(1).count():
        raise SegmentationError("a review row names an unknown item")
    open_ = review.filter("coalesce(review_reason, '') = '' and coalesce(review_status, '') != 'reject'").select("video_id")
    valid = validation.filter("status = 'valid'").select("video_id").distinct()
    found = items.join(open_, "video_id").join(valid, "video_id", "left_semi")
    twice = found.groupBy("source_video_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise SegmentationError(f"several eligible items of source {twice[0][0]!r}")
    return found


def generate(review: DataFrame, items: DataFrame, validation: DataFrame, existing: DataFrame, minimum: float = 30, maximum: float = 180, target: float = 120, overlap: float = 10) -> DataFrame:
    """Candidates of all eligible sources, with the hints, states and notes they had in ``existing`` by id.

    Kept candidates that the policy no longer makes stay while their source is eligible. ``existing`` needs an ``ordinal``;
    of rows with one id the last counts. Ids follow from source and interval.
    """
    sources = eligible_sources(review, items, validation, strict=True).select("source_video_id", "duration_sec")
    cut = intervals.segment(sources, minimum, maximum, target, overlap, id_col="source_video_id")
    fresh = cut.select("clip_candidate_id", "source_video_id", "start_sec", "end_sec", F.col("length_sec").alias("duration_sec"), F.lit("").alias("scenario_hint"), F.lit("pending").alias("status"), F.lit("").alias("note"))
    made = carry_forward(fresh, existing, "clip_candidate_id", list(DECISIONS))
    old = existing.select(*CANDIDATES)
    return regenerate(made, old, sources)


def ordered(candidates: DataFrame) -> DataFrame:
    """In the order of the timelines: by source, then start and end as numbers."""
    return candidates.orderBy("source_video_id", S.number("start_sec"), S.number("end_sec"))


def jobs(candidates: DataFrame, sources: DataFrame, minimum: float, maximum: float) -> DataFrame:
    """Numbered jobs of kept candidates; one of an unknown source, or with an interval that isn't valid, is an error."""
    made = intervals.trim_jobs(candidates).join(sources.select(F.col("source_video_id").alias("_s"), F.col("duration_sec").alias("source_duration_sec"), "local_path"), F.col("source_video_id") == F.col("_s"), "left")
    fits = intervals.valid_interval(F.col("start_sec"), F.col("end_sec"), F.col("source_duration_sec"), minimum, maximum)
    unknown, invalid = made.agg(F.count_if(F.col("_s").isNull()), F.count_if(F.col("_s").isNotNull() & ~F.coalesce(fits, F.lit(False)))).first()
    if unknown:
        raise SegmentationError(f"{unknown} kept candidates of unknown sources")
    if invalid:
        raise SegmentationError(f"{invalid} kept candidates with an invalid interval")
    return made.drop("_s")


def pending(jobs_: DataFrame, verified: DataFrame) -> DataFrame:
    """Jobs whose output isn't there yet, readable and as long as cut, within a second."""
    there = verified.select(F.col("clip_id").alias("_f"), F.col("duration_sec").alias("_d"), F.col("readable").alias("_ok"))
    good = F.col("_ok") & (F.abs(F.col("_d") - (F.col("end_sec") - F.col("start_sec"))) <= 1.0)
    return jobs_.join(there, (F.col("clip_id") == F.col("_f")) & F.coalesce(good, F.lit(False)), "left_anti")
