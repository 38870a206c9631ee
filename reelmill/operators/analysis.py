"""Runs that put the scoring operators together: the candidate table, incremental analysis, and the review pool."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import SELECTION, fingerprint
from ..storage import stash
from . import scoring, selection

INHERITED = ("clip_id", "clip_path", "source_id", "source_video_id", "camera_id", "source_start_sec", "source_end_sec", "duration_sec", "fps", "width", "height", "codec", "sha256", "qc_status", "metadata_status")
SIGNALS = (
    "activity_score", "motion_variation_score", "brightness_score", "visual_variation_score", "foreground_occupancy_score", "persistence_score",
    "small_far_score", "occlusion_score", "boundary_edge_score", "blur_score", "crowded_score", "fast_motion_score", "low_light_score",
)
#: What an analysis has to have left for it to be used again.
REQUIRED = ("visual_signature", "event_likelihood_score", "hardcase_score", "activity_score", "keyframe_timestamps", "keyframe_reasons")
STATE = ("recommended_for_shortlist", "selection_status", "selection_reason", "manual_review_status", "manual_review_label", "manual_review_notes")
REVIEWED = ("manual_review_status", "manual_review_label", "manual_review_notes")


def candidate_table(metadata: DataFrame) -> DataFrame:
    """Canonical metadata as candidates: identity and technical columns, every signal and score empty, nothing computed yet."""
    have = [F.col(c) if c in metadata.columns else F.lit(None).cast("string").alias(c) for c in INHERITED]
    empty = [F.lit(None).cast("double").alias(c) for c in (*SIGNALS, "event_likelihood_score", "hardcase_score", "diversity_score", "candidate_score")]
    text = [F.lit(None).cast("string").alias(c) for c in ("visual_signature", "event_likelihood_level", "hardcase_tags", "keyframe_timestamps", "keyframe_reasons")]
    return metadata.select(
        *have,
        *empty,
        *text,
        F.lit("NOT_COMPUTED").alias("signal_status"),
        F.lit("NOT_COMPUTED_NOT_GROUND_TRUTH").alias("prediction_status"),
        F.lit("Signals are left to the analysis; the metadata infer no score, rank or recommendation.").alias("notes"),
    )


def run_analysis(candidates: DataFrame, cache: DataFrame, analyse: Callable[[DataFrame], DataFrame], settings: dict[str, Any] = SELECTION, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Every candidate with its signals, scores, ranks and where they come from: ``origin`` is cache or new.

    An entry of the cache counts if it was computed from the same content under the same settings and has all
    required fields. The others go through ``analyse``, which returns the same rows with the analysis columns filled and a
    ``signal_status`` of COMPUTED or FAILED. Diversity, scores and ranks are always made anew over all computed rows, since
    they depend on every row. Failed rows keep their place without scores; the state of a selection is reset.
    """
    now = fingerprint(settings)
    names = list(dict.fromkeys([*required, *SIGNALS, "event_likelihood_level", "hardcase_tags"]))
    names = [c for c in names if c in cache.columns]
    plain = candidates.drop(*[c for c in (*names, "signal_status", "analysis_sha256", "analysis_fingerprint", "origin", "candidate_score", "diversity_score", "global_rank", "source_rank") if c in candidates.columns])
    usable = cache.withColumn(required[0], F.when(F.col("signal_status") == "COMPUTED", F.col(required[0])))
    hits, misses = selection.cache_split(plain, usable, now, tuple(names), must=required)
    hits = hits.select(*plain.columns, *[F.col(f"cached.{c}").alias(c) for c in names], F.lit("COMPUTED").alias("signal_status"), F.lit("cache").alias("origin"))
    new = analyse(misses).select(*plain.columns, *names, "signal_status", F.lit("new").alias("origin"))
    # Written once: what was analysed is read several times below, and isn't analysed again.
    rows = stash(hits.unionByName(new).withColumns({"analysis_sha256": F.col("sha256"), "analysis_fingerprint": F.lit(now)}), "analysed")
    done = rows.filter("signal_status = 'COMPUTED'")
    scored = scoring.source_rank(scoring.global_rank(scoring.candidate_scores(done, settings)))
    failed = rows.filter("signal_status != 'COMPUTED'").withColumns({c: F.lit(None).cast("double") for c in ("candidate_score", "diversity_score")})
    out = scored.unionByName(failed, allowMissingColumns=True)
    return selection.reset_selection(out, list(STATE))


def guard_fingerprint(rows: DataFrame, settings: dict[str, Any] = SELECTION) -> None:
    """Raise where computed rows were analysed under other settings."""
    stale = rows.filter((F.col("signal_status") == "COMPUTED") & ~F.col("analysis_fingerprint").eqNullSafe(fingerprint(settings))).count()
    if stale:
        raise selection.SelectionError(f"{stale} candidates have a stale analysis")


def earlier_reviews(*tables: DataFrame) -> DataFrame:
    """Reviews of several runs as one table, later tables after earlier ones: of one clip the last row counts."""
    out = None
    for i, t in enumerate(tables):
        rows = t.select("clip_id", *REVIEWED, F.lit(i).alias("ordinal"))
        out = rows if out is None else out.unionByName(rows)
    return out


def review_pool(rows: DataFrame, reviews: DataFrame, settings: dict[str, Any] = SELECTION) -> tuple[DataFrame, DataFrame]:
    """(pool, redundant): every row with the outcome of the selection and what people had entered before, and the rows left out because a chosen one is like them.

    ``reviews`` is what ``earlier_reviews`` gives. A stale analysis is an error.
    """
    guard_fingerprint(rows, settings)
    chosen = selection.select_pool(rows, settings).withColumns({"manual_review_label": F.lit(""), "manual_review_notes": F.lit("")})
    taken = F.col("selection_status") == "REVIEW_POOL"
    pool = selection.carry_forward(chosen.filter(taken), reviews, "clip_id", list(REVIEWED)).unionByName(chosen.filter(~taken))
    computed = rows.filter("signal_status = 'COMPUTED'").select("clip_id", "source_id", "start_sec", "end_sec", "signature")
    picked = computed.join(chosen.filter(taken).select("clip_id"), "clip_id", "left_semi")
    s = settings
    return pool, scoring.redundant(computed, picked, s["content_similarity_threshold"], s["adjacent_similarity_threshold"], s["temporal_adjacency_sec"])
