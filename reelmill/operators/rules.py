"""Rules as data: each is a condition over a row, with a code and a severity. One pass over a table emits all its issues."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import intervals

RANK = {"INFO": 0, "WARNING": 1, "FAIL": 2, "ERROR": 2}


@dataclass(frozen=True)
class Rule:
    code: str
    severity: str
    when: Column
    details: Column | None = None
    field: str = ""


def apply_rules(rows: DataFrame, rules: list[Rule], keys: list[str]) -> DataFrame:
    """Issues of every row: keys, seq (the rule's place), severity, code, field, details.

    A row's conditions are one number, a bit for each rule, in generated code; only rows with a bit set are taken apart. A
    filter on that number would be slower: the optimizer takes long over so many conditions in one comparison.
    """
    if len(rules) > 62:
        raise ValueError("at most 62 rules at a time")
    mask = F.lit(0).cast("bigint")
    for i, r in enumerate(rules):
        mask = mask + F.when(r.when, F.lit(1 << i)).otherwise(F.lit(0).cast("bigint"))
    held = rows.withColumn("_rules", mask)
    made = [
        F.when(
            F.col("_rules").bitwiseAND(F.lit(1 << i)) != 0,
            F.struct(F.lit(i).alias("seq"), F.lit(r.severity).alias("severity"), F.lit(r.code).alias("code"), F.lit(r.field).alias("field"), (r.details if r.details is not None else F.lit("")).alias("details")),
        )
        for i, r in enumerate(rules)
    ]
    return held.select(*keys, F.explode(F.when(F.col("_rules") != 0, F.array_compact(F.array(*made)))).alias("_i")).select(*keys, "_i.*")


def severity_rank(severity: Column | str) -> Column:
    s = F.col(severity) if isinstance(severity, str) else severity
    return F.when(s.isin("FAIL", "ERROR"), 2).when(s == "WARNING", 1).otherwise(0)


def roll_up(rows: DataFrame, issues: DataFrame, key: str, status: str = "status", notes: str = "notes") -> DataFrame:
    """Each row with the status of its worst issue, and the texts of all but INFO ones in the order of the rules."""
    text = F.when(F.col("severity") != "INFO", F.struct("seq", F.concat_ws(": ", "code", "details").alias("t")))
    per = issues.groupBy(key).agg(F.max(severity_rank("severity")).alias("_r"), F.array_sort(F.collect_list(text)).alias("_t"))
    return rows.join(per, key, "left").select(
        *rows.columns,
        F.when(F.col("_r") == 2, "FAIL").when(F.col("_r") == 1, "WARNING").otherwise("PASS").alias(status),
        F.coalesce(F.array_join(F.transform("_t", lambda x: x["t"]), "; "), F.lit("")).alias(notes),
    )


def escalate(rows: DataFrame, group_issues: DataFrame, key: str, status: str = "status", notes: str = "notes") -> DataFrame:
    """Issues of a group reach all its rows: the status rises to the worst, the notes get theirs added."""
    text = F.struct("seq", F.concat_ws(": ", "code", "details").alias("t"))
    per = group_issues.groupBy(key).agg(F.max(severity_rank("severity")).alias("_r"), F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda x: x["t"]), "; ").alias("_t"))
    now = F.greatest(severity_rank(status), F.coalesce("_r", F.lit(0)))
    kept = [c for c in rows.columns if c not in (status, notes)]
    return rows.join(per, key, "left").select(
        *kept,
        F.when(now == 2, "FAIL").when(now == 1, "WARNING").otherwise("PASS").alias(status),
        F.concat_ws("; ", F.nullif(F.col(notes), F.lit("")), "_t").alias(notes),
    )


def ordered_issues(issues: DataFrame, keys: list[str]) -> DataFrame:
    return issues.orderBy(-severity_rank("severity"), *keys)


# ---- technical quality ------------------------------------------------------------------------------------------


def technical_rules(min_sec: float = 30, max_sec: float = 180, frame_sec: float = 1.0, frame_ratio: float = 0.02) -> list[Rule]:
    """Over clips with duration_sec, fps, frame_count, width, height and the outcome of probe and decode.

    An unreadable clip has nothing to look at: it is corrupted and can't be decoded, whatever its other columns say. Figures
    that are no finite numbers count as unknown. An unknown frame count is no fault, a negative duration is an anomaly too.
    """
    known = lambda c: F.when(F.abs(F.col(c)) < float("inf"), F.col(c))
    said = lambda c: F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("''")))
    d, fps, n, width, height = (known(c) for c in ("duration_sec", "fps", "frame_count", "width", "height"))
    read = F.coalesce("readable", F.lit(False))
    implied = n / F.nullif(fps, F.lit(0.0))
    gap = F.abs(d - implied)
    return [
        Rule("CHECKSUM_MISMATCH", "FAIL", (F.col("expected_sha256") != "") & (F.col("expected_sha256") != F.col("sha256"))),
        Rule("FILE_CORRUPTED", "FAIL", ~read),
        Rule("METADATA_FALLBACK", "WARNING", read & (F.col("metadata_source") == "fallback")),
        Rule("INVALID_DURATION", "FAIL", read & (d.isNull() | (d <= 0)), said("duration_sec")),
        Rule("INVALID_FPS", "FAIL", read & (fps.isNull() | (fps <= 0)), said("fps")),
        Rule("INVALID_RESOLUTION", "FAIL", read & ((F.coalesce(width, F.lit(0)) <= 0) | (F.coalesce(height, F.lit(0)) <= 0)), F.concat(said("width"), F.lit(", "), said("height"))),
        Rule("INVALID_FRAME_COUNT", "FAIL", read & (n <= 0), said("frame_count")),
        Rule("DECODE_FALLBACK", "WARNING", read & (F.col("decode_source") == "fallback")),
        Rule("DECODE_ERROR", "FAIL", ~read | (F.col("decode_errors") > 0)),
        Rule("DURATION_ANOMALY", "WARNING", read & (d != 0) & ((d < min_sec) | (d > max_sec)), F.format_string(f"duration_sec=%.3f is outside [{min_sec:g}, {max_sec:g}]", d)),
        Rule("FRAME_COUNT_MISMATCH", "WARNING", read & (d != 0) & (fps != 0) & (n > 0) & (gap > F.greatest(F.lit(frame_sec), d * frame_ratio)), F.format_string("duration=%.3fs, frame_count/fps=%.3fs, difference=%.3fs", d, implied, gap)),
    ]


def technical_issues(clips: DataFrame, expected_overlap: float = 0.0, tolerance: float = 0.5, **settings: float) -> DataFrame:
    """All technical issues of clips: clip_id, source_id, seq, severity, code, details, related_clip_id."""
    from .dedupe import duplicate_groups
    from .registry import modal_anomalies

    own = apply_rules(clips, technical_rules(**settings), ["clip_id", "source_id"]).withColumn("related_clip_id", F.lit(None).cast("string")).drop("field")
    modal = modal_anomalies(clips)
    odd = apply_rules(modal, [Rule("FPS_ANOMALY", "WARNING", F.col("fps_anomaly")), Rule("RESOLUTION_ANOMALY", "WARNING", F.col("resolution_anomaly"))], ["clip_id", "source_id"])
    odd = odd.withColumn("seq", F.col("seq") + 20).withColumn("related_clip_id", F.lit(None).cast("string")).drop("field")
    same = duplicate_groups(clips).join(clips.select("clip_id", "source_id"), "clip_id").select(
        "clip_id", "source_id", F.lit(30).alias("seq"), F.lit("WARNING").alias("severity"), F.lit("EXACT_DUPLICATE").alias("code"), F.concat(F.lit("exact SHA-256 duplicate in "), "duplicate_group").alias("details"), "related_clip_id"
    )
    pairs = intervals.overlap_pairs(clips, expected_overlap, tolerance)
    both = F.explode(F.array(F.struct(F.col("left_id").alias("clip_id"), F.col("right_id").alias("other")), F.struct(F.col("right_id").alias("clip_id"), F.col("left_id").alias("other"))))
    over = pairs.select("source_id", "severity", "overlap_sec", "overlap_ratio", both.alias("x")).select(
        F.col("x.clip_id").alias("clip_id"), "source_id", F.lit(40).alias("seq"), "severity", F.lit("TEMPORAL_OVERLAP").alias("code"), F.format_string("overlap_sec=%.3f, overlap_ratio=%.6f", "overlap_sec", "overlap_ratio").alias("details"), F.col("x.other").alias("related_clip_id")
    )
    return own.unionByName(odd).unionByName(same).unionByName(over)


def file_verdict(min_duration: float = 0.0, min_fps: float = 5, min_width: int = 320, min_height: int = 240) -> Column:
    """struct<status, reason> of a probed file: the first thing wrong wins."""
    out = lambda s, r: F.struct(F.lit(s).alias("status"), F.lit(r).alias("reason"))
    return (
        F.when(~F.coalesce(F.col("exists"), F.lit(False)), out("invalid", "missing_file"))
        .when(F.coalesce(F.col("probe_error"), F.lit("")) != "", out("invalid", "unreadable"))
        .when(F.coalesce("duration_sec", F.lit(0.0)) <= min_duration, out("invalid", "invalid_duration"))
        .when(F.coalesce("fps", F.lit(0.0)) < min_fps, out("invalid", "invalid_fps"))
        .when((F.coalesce("expected_sha256", F.lit("")) != "") & (F.col("expected_sha256") != F.col("sha256")), out("invalid", "checksum_mismatch"))
        .when((F.coalesce("width", F.lit(0)) < min_width) | (F.coalesce("height", F.lit(0)) < min_height), out("warning", "low_resolution"))
        .otherwise(out("valid", ""))
    )


# ---- canonical metadata -----------------------------------------------------------------------------------------


def metadata_issues(manifest: DataFrame, inventory: DataFrame, registry: DataFrame, expected_overlap: float = 10.0, tolerance: float = 0.001) -> DataFrame:
    """Issues between a manifest, the inventory of its files and the registry of its sources.

    Of inventory rows with one id the first counts. Keys: clip_id, source_id.
    """
    once = inventory.groupBy("clip_id").agg(F.min_by(F.struct(*inventory.columns), "ordinal").alias("i"), F.count(F.lit(1)).alias("_times"))
    again = once.filter("_times > 1").select("clip_id", F.col("i.source_id").alias("source_id"))
    inv = once.select(*[F.col(f"i.{c}").alias(f"i_{c}") for c in inventory.columns])
    reg = registry.select(F.col("source_id").alias("r_source_id"), F.col("camera_id").alias("r_camera_id"))
    # A source holds any number of clips, the registry one row for each source: adaptive execution broadcasts it if it is small.
    # One join gives the rows of both sides: what is only in the inventory has no manifest row.
    both = manifest.withColumn("_m", F.lit(True)).join(inv, F.col("clip_id") == F.col("i_clip_id"), "full_outer").join(reg, F.col("source_id") == F.col("r_source_id"), "left")
    rows = both.withColumns({"clip_id": F.when(F.col("_m").isNull(), F.col("i_clip_id")).otherwise(F.col("clip_id")), "source_id": F.when(F.col("_m").isNull(), F.col("i_source_id")).otherwise(F.col("source_id"))})
    mine = F.col("_m").isNotNull()
    known, s, e, d = F.col("i_clip_id").isNotNull(), S.number_in(manifest, "start_sec"), S.number_in(manifest, "end_sec"), S.number_in(manifest, "duration_sec")
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    mapped = F.col("r_source_id").isNotNull()
    named = F.col("clip_id").startswith(F.concat("source_id", F.lit("_C"))) & F.expr("substring(clip_id, length(source_id) + 3)").rlike("^[0-9]+$")
    text = lambda a, b: ~F.coalesce(F.col(a), F.lit("")).eqNullSafe(F.coalesce(F.col(b), F.lit("")))
    near = lambda a, b: ~F.coalesce(F.abs(S.number_in(manifest, a) - S.number_in(inv, b)) <= tolerance, F.lit(False))
    rules = [
        Rule("MISSING_SOURCE_ID", "FAIL", empty("source_id"), field="source_id"),
        Rule("UNKNOWN_SOURCE_MAPPING", "FAIL", ~empty("source_id") & ~mapped, field="source_id"),
        Rule("CLIP_NAMING_INCONSISTENCY", "WARNING", mapped & ~named, field="clip_id"),
        Rule("MISSING_INVENTORY_RECORD", "FAIL", ~known, field="clip_id"),
        Rule("MALFORMED_TIMESTAMPS", "FAIL", s.isNull() | e.isNull(), field="start_sec/end_sec"),
        Rule("INVALID_TIMESTAMP_ORDER", "FAIL", e <= s, field="end_sec"),
        Rule("MANIFEST_DURATION_MISMATCH", "FAIL", (e > s) & (d.isNull() | (F.abs(d - (e - s)) > tolerance)), field="duration_sec"),
        Rule("METADATA_INVENTORY_MISMATCH", "FAIL", known & text("source_id", "i_source_id"), field="source_id"),
        Rule("METADATA_INVENTORY_MISMATCH", "FAIL", known & text("local_path", "i_file_path"), field="clip_path"),
        Rule("METADATA_INVENTORY_MISMATCH", "FAIL", known & near("start_sec", "i_start_sec"), field="start_sec"),
        Rule("METADATA_INVENTORY_MISMATCH", "FAIL", known & near("end_sec", "i_end_sec"), field="end_sec"),
        Rule("METADATA_INVENTORY_MISMATCH", "FAIL", known & near("duration_sec", "i_duration_sec"), field="duration_sec"),
        Rule("CHECKSUM_MISMATCH", "FAIL", known & text("sha256", "i_sha256"), field="sha256"),
        Rule("CLIP_PATH_NAMING_INCONSISTENCY", "WARNING", ~empty("local_path") & (S.stem("local_path") != F.col("clip_id")), field="clip_path"),
        Rule("UNRESOLVED_CAMERA", "WARNING", S.unresolved("r_camera_id"), field="camera_id"),
        Rule("QC_FAILED", "FAIL", F.col("i_qc_status") == "FAIL", field="qc_status"),
        Rule("QC_WARNING", "WARNING", F.col("i_qc_status") == "WARNING", field="qc_status"),
        Rule("INVALID_QC_STATUS", "FAIL", ~F.coalesce(F.col("i_qc_status"), F.lit("")).isin("FAIL", "WARNING", "PASS"), field="qc_status"),
    ]
    rules = [Rule(r.code, r.severity, mine & r.when, r.details, r.field) for r in rules]
    rules.append(Rule("ORPHAN_INVENTORY_RECORD", "FAIL", ~mine, field="clip_id"))
    keys = ["clip_id", "source_id"]
    none = F.lit(None).cast("string")
    own = apply_rules(rows, rules, keys)
    blank = lambda f: f.select(*keys, F.lit(0).alias("seq"), F.lit("FAIL").alias("severity"), "code", "field", F.lit("").alias("details"))
    # Ids and paths that are empty or stand on several rows, from one pass.
    named = manifest.select(F.explode(F.array(F.struct(F.lit("clip_id").alias("field"), F.coalesce("clip_id", F.lit("")).alias("value")), F.struct(F.lit("clip_path").alias("field"), F.coalesce("local_path", F.lit("")).alias("value")))).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    is_id = F.col("k.field") == "clip_id"
    wrong = F.when(F.col("k.value") == "", F.when(is_id, "MISSING_CLIP_ID").otherwise("MISSING_CLIP_PATH")).when(F.col("n") > 1, F.when(is_id, "DUPLICATE_CLIP_ID").otherwise("DUPLICATE_CLIP_PATH"))
    of_keys = named.withColumn("code", wrong).filter("code is not null").select(F.when(is_id, F.col("k.value")).alias("clip_id"), none.alias("source_id"), "code", F.col("k.field").alias("field"))
    twice = again.withColumn("code", F.lit("DUPLICATE_INVENTORY_CLIP_ID")).withColumn("field", F.lit("clip_id"))
    line = intervals.timeline_issues(manifest.withColumns({c: S.number_in(manifest, c) for c in ("start_sec", "end_sec")}), expected_overlap, tolerance)
    line = line.select(*keys, F.lit(90).alias("seq"), F.lit("WARNING").alias("severity"), F.col("issue_code").alias("code"), F.lit("start_sec").alias("field"), F.format_string("%.6f", "overlap_sec").alias("details"))
    out = own
    for more in (blank(of_keys), blank(twice), line):
        out = out.unionByName(more)
    return out


def escapes(path: Column | str) -> Column:
    """Whether a relative path leaves its root: an absolute one does, and one that goes up further than it came down."""
    p = F.col(path) if isinstance(path, str) else path
    step = lambda x: F.when(x.isin("", "."), 0).when(x == "..", -1).otherwise(1)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("least"))
    walked = F.aggregate(F.split(p, "/"), start, lambda s, x: F.struct((s["depth"] + step(x)).alias("depth"), F.least(s["least"], s["depth"] + step(x)).alias("least")))
    return F.coalesce(p.startswith("/") | (walked["least"] < 0), F.lit(False))


def file_issues(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Issues between a manifest and the media files that are there, (path, sha256), paths relative to the same root.

    One full outer join by path: manifest rows without a file, with another content, or with a path that leaves the root,
    and files that no row names.
    """
    there = files.groupBy(F.col("path").alias("_p")).agg(F.first("sha256").alias("_sha"))
    rows = manifest.withColumn("_m", F.lit(True)).join(there, F.col("local_path") == F.col("_p"), "full_outer")
    mine, text = F.col("_m").isNotNull(), F.coalesce("local_path", F.lit(""))
    out = escapes("local_path")
    there_ = F.col("_p").isNotNull() & ~out
    found = [
        Rule("INVALID_CLIP_PATH", "FAIL", mine & out, text, "clip_path"),
        Rule("MISSING_FILE", "FAIL", mine & ~there_, text, "clip_path"),
        Rule("CHECKSUM_MISMATCH", "FAIL", mine & there_ & ~F.coalesce((F.col("sha256") != "") & (F.col("sha256") == F.col("_sha")), F.lit(False)), F.lit(""), "sha256"),
        Rule("ORPHAN_CLIP_FILE", "FAIL", ~mine & F.col("_p").rlike(S.MEDIA_SUFFIX), F.col("_p"), "clip_path"),
    ]
    return apply_rules(rows, found, ["clip_id", "source_id"])


def source_issues(sources: DataFrame, files: DataFrame) -> DataFrame:
    """Issues of a registry's sources (source_id, mapped, source_path) with the raw files that are there, (path)."""
    rows = sources.join(files.select(F.col("path").alias("_p")).distinct(), F.col("source_path") == F.col("_p"), "left").withColumn("clip_id", F.lit(None).cast("string"))
    mapped, empty = F.coalesce(F.col("mapped"), F.lit(False)), F.coalesce("source_path", F.lit("")) == ""
    found = [
        Rule("UNKNOWN_SOURCE_MAPPING", "FAIL", ~mapped, field="source_id"),
        Rule("MISSING_SOURCE_PATH", "FAIL", mapped & empty, field="source_path"),
        Rule("MISSING_SOURCE_FILE", "FAIL", mapped & ~empty & (F.col("_p").isNull() | escapes("source_path")), F.col("source_path"), "source_path"),
    ]
    return apply_rules(rows, found, ["clip_id", "source_id"])


def media_issues(clips: DataFrame, fields: dict[str, float | None]) -> DataFrame:
    """Values of clips that differ from the first of their source, as issues."""
    from .registry import baseline_issues

    off = baseline_issues(clips, fields)
    return off.select("clip_id", "source_id", F.lit(95).alias("seq"), F.lit("WARNING").alias("severity"), F.lit("SOURCE_MEDIA_INCONSISTENCY").alias("code"), "field", F.concat_ws(" differs from ", "value", "baseline").alias("details"))


# ---- cross-table validation -------------------------------------------------------------------------------------

EVENT_LABEL = "SUSPECTED_AREA_OCCUPATION"
ZONE_TYPES = ("SIDEWALK", "MONITORED", "ALLOWED", "IGNORE")


def event_errors(duration: Column, classes: list[str]) -> Column:
    """Codes of what is wrong with an event row, one invalid_bbox for each bad keyframe."""
    s, v = S.number("start_time_sec"), S.number("violation_time_sec")
    end_text = F.coalesce(F.col("end_time_sec").cast("string"), F.lit(""))
    e = F.when(end_text == "", duration).otherwise(S.number("end_time_sec"))
    frames = F.from_json(F.coalesce(F.nullif(F.col("bbox_keyframes"), F.lit("")), F.lit("[]")), "array<struct<time_sec:double,bbox:array<double>>>")
    x = lambda f, i: F.get(f["bbox"], F.lit(i))
    unread = s.isNull() | v.isNull() | e.isNull() | frames.isNull() | F.exists(frames, lambda f: f.isNull() | f["time_sec"].isNull() | (F.coalesce(F.size(f["bbox"]), F.lit(0)) != 4))
    bad = F.filter(frames, lambda f: ~((f["time_sec"] >= s) & (f["time_sec"] <= e) & (x(f, 0) < x(f, 2)) & (x(f, 1) < x(f, 3))))
    one = lambda code, when: F.when(F.coalesce(when, F.lit(False)), F.array(F.lit(code))).otherwise(F.array().cast("array<string>"))
    timed = F.when(unread, F.array(F.lit("invalid_timing_or_bbox"))).otherwise(
        F.concat(one("invalid_timing", ~((s >= 0) & (s <= v) & (v <= e) & (e <= duration))), F.transform(bad, lambda _: F.lit("invalid_bbox")))
    )
    return F.concat(one("invalid_label", ~F.col("label").eqNullSafe(EVENT_LABEL)), one("invalid_class", ~F.coalesce(F.col("object_class").isin(*classes), F.lit(False))), timed)


def zone_rows(zone_documents: DataFrame) -> DataFrame:
    """Zones of each camera view: (camera_id, view_id, width, height, zone_id, zone_type, valid, times)."""
    z = zone_documents.select("camera_id", "view_id", F.get("resolution", F.lit(0)).alias("width"), F.get("resolution", F.lit(1)).alias("height"), F.explode_outer("zones").alias("z"))
    good = F.col("z.zone_type").isin(*ZONE_TYPES) & S.polygon_valid(F.col("z.polygon"), F.col("width"), F.col("height"))
    rows = z.select("camera_id", "view_id", "width", "height", F.col("z.zone_id").alias("zone_id"), F.col("z.zone_type").alias("zone_type"), F.coalesce(good, F.lit(False)).alias("valid"))
    # Counts of ids that stand more than once come back, so the zones of a view need not meet in a task.
    again = rows.filter("zone_id is not null").groupBy(F.col("camera_id").alias("_c"), F.col("view_id").alias("_v"), F.col("zone_id").alias("_z")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    same = F.col("camera_id").eqNullSafe(F.col("_c")) & F.col("view_id").eqNullSafe(F.col("_v")) & (F.col("zone_id") == F.col("_z"))
    times = F.when(F.col("zone_id").isNull(), F.lit(0)).otherwise(F.coalesce("_n", F.lit(1))).cast("long")
    return rows.join(again, same, "left").withColumn("times", times).drop("_c", "_v", "_z", "_n")


def cross_issues(clips: DataFrame, cameras: DataFrame, zone_documents: DataFrame, scenarios: DataFrame, events: DataFrame, splits: DataFrame, sources: DataFrame, labels: DataFrame, classes: list[str], grouping: str = "source_video_id") -> DataFrame:
    """(severity, code, entity): what the tables of an annotated set say against each other.

    ``labels`` has (scenario, scenario_group) as configured; ``sources`` (source_video_id, selected).
    """
    out: list[DataFrame] = []

    def add(rows: DataFrame, code: str | Column, entity: str | Column) -> None:
        out.append(rows.select(F.lit("ERROR").alias("severity"), (F.lit(code) if isinstance(code, str) else code).alias("code"), (F.col(entity) if isinstance(entity, str) else entity).cast("string").alias("entity")))

    add(clips.agg(F.count(F.lit(1)).alias("n")).filter("n = 0"), "no_clips", F.lit(""))
    for name, rows, key in (("clip", clips, "clip_id"), ("event", events, "event_id"), ("split", splits, "clip_id")):
        # As many tasks as shuffles have: ids pack so well that adaptive execution would put millions of groups into one task.
        spread = rows.select(key).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
        add(spread.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), f"duplicate_{name}", key)
    src = sources.groupBy(F.col("source_video_id").alias("_s")).agg(F.max("selected").alias("_selected"))
    own = clips.join(src, F.col("source_video_id") == F.col("_s"), "left")
    add(own.filter("_s is null"), "missing_source", "clip_id")
    add(own.filter("_s is not null and not _selected"), "source_not_selected", "clip_id")
    cam = cameras.select("camera_id", "view_id", F.col("width").alias("cam_w"), F.col("height").alias("cam_h")).dropDuplicates(["camera_id", "view_id"])
    placed = clips.join(cam, ["camera_id", "view_id"], "left")
    add(placed.filter("cam_w is null"), "missing_camera_view", "clip_id")
    seen = placed.filter("cam_w is not null")
    add(seen.filter("width is not null and (width != cam_w or height != cam_h)"), "camera_resolution_mismatch", "clip_id")
    safe = F.col("camera_id").rlike("^[A-Za-z0-9_-]*[A-Za-z0-9][A-Za-z0-9_-]*$") & F.col("view_id").rlike("^[A-Za-z0-9_-]*[A-Za-z0-9][A-Za-z0-9_-]*$")
    add(seen.filter(~safe), "invalid_camera_view_id", "clip_id")
    zones = zone_rows(zone_documents)
    docs = zone_documents.select("camera_id", "view_id", F.get("resolution", F.lit(0)).alias("doc_w"), F.get("resolution", F.lit(1)).alias("doc_h"), F.when(F.col("zones").isNotNull(), F.size("zones")).alias("n_zones"), F.lit(True).alias("_doc"))
    framed = seen.filter(safe).join(docs, ["camera_id", "view_id"], "left").withColumn("has_doc", F.coalesce("_doc", F.lit(False)))
    add(framed.filter("n_zones is null and not has_doc"), "missing_roi", "clip_id")
    add(framed.filter("has_doc and (doc_w is null or doc_h is null or n_zones is null)"), "invalid_roi_file", "clip_id")
    add(framed.filter("doc_w != cam_w or doc_h != cam_h"), "roi_resolution_mismatch", "clip_id")
    add(framed.filter("n_zones = 0"), "empty_roi", "clip_id")
    of_clip = clips.select("clip_id", "camera_id", "view_id").join(zones, ["camera_id", "view_id"])
    add(of_clip.filter("times > 1").select("clip_id", "zone_id").distinct(), "duplicate_zone", "clip_id")
    add(of_clip.filter("zone_id is not null and not valid"), "invalid_polygon", "clip_id")
    want = labels.groupBy(F.col("scenario").alias("_l")).agg(F.collect_list("scenario_group").alias("_groups"))
    sc = scenarios.join(want, F.col("scenario") == F.col("_l"), "left")
    add(scenarios.join(clips, "clip_id", "left_anti"), "scenario_missing_clip", "clip_id")
    add(sc.filter("not coalesce(size(_groups) = 1 and _groups[0] = scenario_group, false)"), "invalid_scenario", "clip_id")
    add(scenarios.filter("not (review_status <=> 'approved')"), "scenario_not_approved", "clip_id")
    add(events.join(clips, "clip_id", "left_anti"), "event_missing_clip", "event_id")
    ev = events.join(clips.select("clip_id", F.col("camera_id").alias("clip_camera"), F.col("view_id"), F.col("duration_sec").alias("clip_duration")), "clip_id")
    zoned = ev.join(of_clip.select("clip_id", "zone_id", F.col("zone_type").alias("real_type")).dropDuplicates(["clip_id", "zone_id"]), ["clip_id", "zone_id"], "left")
    add(zoned.filter("not coalesce(real_type = zone_type, false)"), "event_missing_zone", "event_id")
    add(ev.filter("not (camera_id <=> clip_camera)"), "event_camera_mismatch", "event_id")
    add(ev.select("event_id", F.explode(event_errors(F.col("clip_duration"), classes)).alias("code")), F.col("code"), "event_id")
    add(ev.filter("not (review_status <=> 'approved')"), "event_not_approved", "event_id")
    out.append(scenario_logic(clips, scenarios, events))
    known = splits.join(clips.select("clip_id", *[F.col(c).alias(f"c_{c}") for c in ("source_video_id", "camera_id", "session_id")]), "clip_id")
    add(splits.join(clips, "clip_id", "left_anti"), "split_missing_clip", "clip_id")
    add(known.filter("not coalesce(split in ('dev', 'test'), false)"), "invalid_split", "clip_id")
    add(known.filter("not (source_video_id <=> c_source_video_id and camera_id <=> c_camera_id and session_id <=> c_session_id)"), "split_metadata_mismatch", "clip_id")
    keyed = known.withColumn("_key", S.group_key(grouping, "c_source_video_id", "c_camera_id", "c_session_id"))
    add(keyed.filter("_key is null"), "invalid_split_group", "clip_id")
    add(keyed.filter("_key is not null").groupBy("_key").agg(F.count_distinct("split").alias("n")).filter("n > 1"), "split_leakage", "_key")
    add(clips.join(splits, "clip_id", "left_anti"), "missing_split", "clip_id")
    all_ = out[0]
    for more in out[1:]:
        all_ = all_.unionByName(more)
    return all_


def scenario_logic(clips: DataFrame, scenarios: DataFrame, events: DataFrame) -> DataFrame:
    """What a clip's set of scenario groups and its events say about each other."""
    groups = scenarios.groupBy("clip_id").agg(F.collect_set("scenario_group").alias("g"))
    counts = events.groupBy("clip_id").agg(F.count(F.lit(1)).alias("n_events"))
    rows = clips.select("clip_id").join(groups, "clip_id", "left").join(counts, "clip_id", "left").withColumn("g", F.coalesce("g", F.array().cast("array<string>"))).fillna(0, ["n_events"])
    has = lambda x: F.array_contains("g", x)
    rules = [
        Rule("missing_scenario", "ERROR", F.size("g") == 0),
        Rule("missing_outcome_scenario", "ERROR", (F.size("g") == 1) & has("hard")),
        Rule("conflicting_scenarios", "ERROR", has("negative") & has("positive")),
        Rule("negative_has_events", "ERROR", has("negative") & (F.col("n_events") > 0)),
        Rule("positive_without_event", "ERROR", has("positive") & (F.col("n_events") == 0)),
    ]
    return apply_rules(rows, rules, ["clip_id"]).select("severity", "code", F.col("clip_id").cast("string").alias("entity"))


def report_status(issues: DataFrame) -> DataFrame:
    return issues.agg(F.when(F.count_if(F.col("severity") == "ERROR") > 0, "ERROR").otherwise("PASS").alias("status"), F.count(F.lit(1)).alias("issues"))
