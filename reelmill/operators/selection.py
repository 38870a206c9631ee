"""Constrained, diversity-aware choice of a review pool, and what happens to it afterwards."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import SELECTION
from . import scoring
from .pool import SelectionError, choose

IDENTITY = ("clip_id", "source_id", "start_sec", "end_sec", "sha256")


def select_pool(rows: DataFrame, settings: dict[str, Any] = SELECTION) -> DataFrame:
    """clip_id, source_id, candidate_score, pick_number, selection_status, manual_review_status and reason of every row.

    Each choice depends on all before it, but no task or driver holds the candidates: see ``pool``. What comes back is at most
    120 ids, which are joined to the rows. Rows whose source is null are never chosen.
    """
    size = int(settings["candidate_pool_size"])
    if not 100 <= size <= 120:
        raise SelectionError("candidate_pool_size must be between 100 and 120")
    computed = rows.filter("signal_status = 'COMPUTED' and source_id is not null")
    quotas = scoring.source_quotas(computed.groupBy("source_id").agg(F.count(F.lit(1)).alias("n")), size, int(settings["source_minimum"]), float(settings["source_maximum_fraction"]))
    seats, candidates = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if candidates < size:
        raise SelectionError("not enough analysed candidates")
    if seats > size:
        raise SelectionError("the constraints overfill the pool")
    # At most as many sources as the pool has seats.
    ids, _ = choose(computed, {r.source_id: r.quota for r in quotas.filter("quota > 0").select("source_id", "quota").collect()}, settings)
    picked = rows.sparkSession.createDataFrame([(c, i) for i, c in enumerate(ids, 1)], "clip_id string, pick_number int")
    tags = F.coalesce(F.nullif("hardcase_tags", F.lit("")), F.lit("NORMAL_CASE"))
    reason = F.concat(F.lit("source_coverage="), "source_id", F.lit("; event_likelihood="), "event_likelihood_level", F.lit("; hardcase="), tags, F.lit("; diversity_aware_rank; selection_signal_only_not_ground_truth"))
    taken = F.col("pick_number").isNotNull()
    return rows.join(F.broadcast(picked), "clip_id", "left").select(
        "clip_id",
        "source_id",
        "candidate_score",
        "pick_number",
        F.when(taken, "YES").otherwise("NO").alias("recommended_for_shortlist"),
        F.when(taken, "REVIEW_POOL").otherwise("NOT_SELECTED").alias("selection_status"),
        F.when(taken, "PENDING").otherwise("").alias("manual_review_status"),
        F.when(taken, reason).otherwise("").alias("selection_reason"),
    )


def cache_split(candidates: DataFrame, cache: DataFrame, fingerprint: str, fields: tuple[str, ...], must: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """(hits with the cached fields, misses): an entry counts if id, content and settings agree and all fields it must have are there.

    Of entries of one clip the last counts, and if that one doesn't hold, no earlier one does.
    """
    last = cache.groupBy(F.col("clip_id").alias("_id")).agg(F.max_by(F.struct("analysis_sha256", "analysis_fingerprint", *dict.fromkeys([*fields, *(must or fields)])), "ordinal").alias("cached"))
    full = (F.col("cached.analysis_fingerprint") == fingerprint) & (F.col("sha256") == F.col("cached.analysis_sha256"))
    for c in must or fields:
        full = full & (F.coalesce(F.col(f"cached.{c}").cast("string"), F.lit("")) != "")
    on = (F.col("clip_id") == F.col("_id")) & full
    return candidates.join(last, on).drop("_id"), candidates.join(last, on, "left_anti")


def carry_forward(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Regenerated rows with what people had entered in the old ones, where it isn't empty. The last old row of a key counts."""
    last = old.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*columns), "ordinal").alias("_old"))
    return new.join(last, F.col(key) == F.col("_k"), "left").select(*[F.coalesce(F.nullif(F.col(f"_old.{c}"), F.lit("")), F.col(c)).alias(c) if c in columns else F.col(c) for c in new.columns])


def regenerate(new: DataFrame, old: DataFrame, eligible: DataFrame, key: str = "clip_candidate_id") -> DataFrame:
    """New candidates, and the old ones someone kept that weren't made anew, while their source is eligible."""
    kept = old.filter("status = 'keep'").join(new.select(key), key, "left_anti").join(eligible.select("source_video_id").distinct(), "source_video_id", "left_semi")
    return new.unionByName(kept.select(*new.columns))


def same_identity(candidates: DataFrame, canonical: DataFrame, fields: list[str], key: str = "clip_id") -> DataFrame:
    """(key, field) that differ, and keys on one side only."""
    a, b = candidates.alias("a"), canonical.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    k = F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}"))
    missing = F.when(F.col(f"a.{key}").isNull(), F.array(F.lit("missing_candidate"))).when(F.col(f"b.{key}").isNull(), F.array(F.lit("unknown_candidate")))
    changed = F.filter(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return both.select(k.alias(key), F.explode(F.coalesce(missing, changed)).alias("difference"))


def validate_candidates(candidates: DataFrame, canonical: DataFrame, fields: list[str], expected: int | None = None, expected_sources: int | None = None, most: int = 20) -> None:
    """Raise with the first problems of an input to selection; nothing is returned."""
    problems = []
    n, sources, ids = candidates.agg(F.count(F.lit(1)), F.count_distinct("source_id"), F.count_distinct("clip_id")).first()
    if expected is not None and n != expected:
        problems.append(f"{n} candidates, {expected} expected")
    if expected_sources is not None and sources != expected_sources:
        problems.append(f"{sources} sources, {expected_sources} expected")
    if ids != n:
        problems.append("missing or duplicate clip ids")
    problems += [f"{r[0]}: {r[1]}" for r in same_identity(candidates, canonical, fields).orderBy("clip_id", "difference").limit(most).collect()]
    if problems:
        raise SelectionError("; ".join(problems[:most]))


def finalize(pool: DataFrame, minimum: int, maximum: int) -> DataFrame:
    """Kept rows by score, if every row has been reviewed and their number is within the bounds."""
    label, status = F.upper(F.trim("manual_review_label")), F.upper(F.trim("manual_review_status"))
    bad, kept = pool.agg(F.count_if(~F.coalesce((status == "REVIEWED") & label.isin("KEEP", "REJECT"), F.lit(False))), F.count_if(label == "KEEP")).first()
    if bad:
        raise SelectionError(f"{bad} rows are not reviewed")
    if not minimum <= kept <= maximum:
        raise SelectionError(f"{kept} rows kept, {minimum} to {maximum} wanted")
    return pool.filter(label == "KEEP").orderBy(F.desc("candidate_score"), "clip_id")


def reset_selection(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumns({c: F.lit("") for c in columns})
