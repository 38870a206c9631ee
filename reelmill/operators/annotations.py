"""What people enter, as rows: cameras, scenarios, events, zones, previews. Inputs are checked; tables come back whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules
from .ranking import ranked_within


class AnnotationError(ValueError):
    pass


def register_camera(cameras: DataFrame, clips: DataFrame, clip_id: str, camera_id: str, view_id: str, width: int, height: int) -> tuple[DataFrame, DataFrame]:
    """(cameras, clips) with a view registered if it is new and the clip assigned to it; another resolution is an error."""
    if not clips.filter(F.col("clip_id") == clip_id).limit(1).count():
        raise AnnotationError("unknown clip")
    known = cameras.filter((F.col("camera_id") == camera_id) & (F.col("view_id") == view_id)).first()
    if known and (known.width, known.height) != (width, height):
        raise AnnotationError("the view has another resolution")
    if not known:
        row = cameras.sparkSession.createDataFrame([(camera_id, view_id, width, height)], "camera_id string, view_id string, width int, height int")
        cameras = cameras.unionByName(row, allowMissingColumns=True)
    here = F.col("clip_id") == clip_id
    return cameras, clips.withColumns({"camera_id": F.when(here, camera_id).otherwise(F.col("camera_id")), "view_id": F.when(here, view_id).otherwise(F.col("view_id"))})


def label_scenarios(scenarios: DataFrame, new: DataFrame, clips: DataFrame, labels: DataFrame) -> DataFrame:
    """Scenarios after new (clip_id, scenario, reviewer) rows replace those of the same clip and scenario; the group follows from the labels."""
    if new.join(clips, "clip_id", "left_anti").limit(1).count():
        raise AnnotationError("unknown clip")
    groups = labels.groupBy("scenario").agg(F.count(F.lit(1)).alias("_n"), F.min("scenario_group").alias("scenario_group"))
    made = new.join(groups, "scenario", "left")
    if made.filter("coalesce(_n, 0) != 1").limit(1).count():
        raise AnnotationError("a scenario belongs to no group, or to several")
    rows = made.select("clip_id", "scenario", "scenario_group", "reviewer", F.lit("approved").alias("review_status"), F.lit("").alias("note"))
    return scenarios.join(new.select("clip_id", "scenario"), ["clip_id", "scenario"], "left_anti").unionByName(rows)


def append_events(events: DataFrame, new: DataFrame, clips: DataFrame, zones: DataFrame, classes: list[str]) -> DataFrame:
    """Events after new ones that pass every rule; one that doesn't stops all. Ids follow from the content."""
    ready = new.join(clips.select("clip_id", "camera_id", "view_id", F.col("duration_sec").alias("_clip")), "clip_id", "left").join(
        rules.zone_rows(zones).select("camera_id", "view_id", "zone_id", "zone_type").dropDuplicates(["camera_id", "view_id", "zone_id"]), ["camera_id", "view_id", "zone_id"], "left"
    )
    ready = ready.withColumn("label", F.lit(rules.EVENT_LABEL)).withColumn("_errors", rules.event_errors(F.col("_clip"), classes))
    bad = ready.filter("_clip is null or zone_type is null or size(_errors) > 0").limit(3).collect()
    if bad:
        raise AnnotationError("; ".join(f"{r.clip_id}: {', '.join(r._errors or []) or 'unknown clip or zone'}" for r in bad))
    key = F.concat(F.lit("E"), F.substring(F.sha2(F.concat_ws("\0", "clip_id", "zone_id", "object_class", "start_time_sec", "violation_time_sec"), 256), 1, 16))
    return events.unionByName(ready.withColumn("event_id", key).withColumn("review_status", F.lit("approved")).select(*events.columns))


def numbered_zones(zones: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """Zone ids by type within a camera view, in drawing order: SW01, SW02, ..."""
    prefix = F.coalesce(F.create_map(*[F.lit(x) for p in prefixes.items() for x in p])[F.col("zone_type")], F.lit("Z"))
    numbered = ranked_within(zones, ["camera_id", "view_id", "zone_type"], ["ordinal"], "_n")
    return numbered.withColumn("zone_id", F.concat(prefix, F.format_string("%02d", F.col("_n")))).drop("_n")


def nearest_samples(wanted: Column, sampled: Column) -> Column:
    """For each wanted time the index of the nearest sampled one, the earlier of equally near ones."""
    near = lambda t: F.array_sort(F.transform(sampled, lambda s, i: F.struct(F.abs(s - t).alias("d"), i.alias("i"))))
    return F.transform(wanted, lambda t: F.get(near(t), F.lit(0))["i"])


def stale_previews(files: DataFrame, candidates: DataFrame, selected: DataFrame) -> DataFrame:
    """Preview files of known candidates that are no longer selected."""
    return files.join(candidates.select("clip_id"), "clip_id", "left_semi").join(selected.select("clip_id"), "clip_id", "left_anti")
