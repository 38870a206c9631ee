"""Queries over the benchmark tables: one for each operator, with the same query in SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import annotations, catalog, dedupe, intervals, registry, rules, scoring, selection, split, summaries
from ..settings import SELECTION
from . import views as V
from .register import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]

# ---- intervals --------------------------------------------------------------------------------------------------

_PIECES = """pieces AS (SELECT *, CASE WHEN d <= 180 THEN 0 ELSE greatest(0, least(ceil((d - 120) / 110), greatest(ceil((d - 180) / 110), floor((d - 120 + 10 - 30) / 110) + 1))) END::BIGINT AS last
    FROM (SELECT *, floor(duration_sec * 1000) / 1000 AS d FROM videos) WHERE d >= 30),
    cut AS (SELECT video_id, k AS interval_number, round(k * 110.0::DOUBLE, 3) AS start_sec, round(CASE WHEN k = last THEN d ELSE k * 110.0::DOUBLE + 120 END, 3) AS end_sec
    FROM (SELECT *, unnest(range(last + 1)) AS k FROM pieces))"""


@query(f"WITH {V.VIDEOS}, {_PIECES} SELECT video_id, interval_number::INT AS interval_number, start_sec, end_sec, round(end_sec - start_sec, 3) AS length_sec FROM cut")
def segment_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.segment(V.videos(spark, sf_dir)).select("video_id", "interval_number", "start_sec", "end_sec", "length_sec")


@query(f"WITH {V.VIDEOS}, {_PIECES} SELECT video_id, 'A' || substr(sha256(video_id || ':' || printf('%.3f', start_sec) || ':' || printf('%.3f', end_sec)), 1, 16) AS clip_candidate_id FROM cut")
def candidate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.segment(V.videos(spark, sf_dir)).select("video_id", "clip_candidate_id")


@query(f"WITH {V.VIDEOS} SELECT video_id, 'V' || substr(sha256('local:' || source_video_id || ':' || local_path), 1, 16) AS stable_id FROM videos")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.videos(spark, sf_dir).select("video_id", S.item_id(F.lit("local"), "source_video_id", "local_path").alias("stable_id"))


@query(
    f"""WITH {V.VIDEOS}, {_PIECES}, n AS (SELECT v.source_video_id, c.*, CASE WHEN l.quality = 0 THEN 'reject' ELSE 'keep' END AS status,
        'A' || substr(sha256(c.video_id || ':' || printf('%.3f', start_sec) || ':' || printf('%.3f', end_sec)), 1, 16) AS cid FROM cut c JOIN videos v USING (video_id) LEFT JOIN labels l ON l.doc_id = v.doc_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY source_video_id ORDER BY start_sec, end_sec, cid) AS k FROM n)
        SELECT video_id, start_sec, k::INT AS clip_number, source_video_id || '_C' || CASE WHEN k < 1000 THEN lpad(k::VARCHAR, 3, '0') ELSE k::VARCHAR END AS clip_id FROM r WHERE status = 'keep'"""
)
def trim_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = intervals.segment(V.videos(spark, sf_dir)).join(V.table(spark, sf_dir, "labels"), "doc_id", "left")
    return intervals.trim_jobs(cut.withColumn("status", F.when(F.col("quality") == 0, "reject").otherwise("keep"))).select("video_id", "start_sec", "clip_number", "clip_id")


_PAIRS = """pairs AS (SELECT a.source_id, a.clip_id AS left_id, b.clip_id AS right_id, least(a.end_sec, b.end_sec) - greatest(a.start_sec, b.start_sec) AS o, least(a.duration, b.duration) AS shorter
    FROM (SELECT *, end_sec - start_sec AS duration FROM clips WHERE end_sec > start_sec) a JOIN (SELECT *, end_sec - start_sec AS duration FROM clips WHERE end_sec > start_sec) b
    ON a.source_id = b.source_id AND (a.start_sec, a.end_sec, a.clip_id) < (b.start_sec, b.end_sec, b.clip_id) AND least(a.end_sec, b.end_sec) - greatest(a.start_sec, b.start_sec) > 1e-9)"""


@query(f"WITH {V.CLIPS}, {_PAIRS} SELECT source_id, left_id, right_id, round(o, 3) AS overlap_sec, CASE WHEN o > 1000.5 THEN 'WARNING' ELSE 'INFO' END AS severity FROM pairs")
def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlap_pairs(V.clips(spark, sf_dir), expected=1000.0, tolerance=0.5).select("source_id", "left_id", "right_id", F.round("overlap_sec", 3).alias("overlap_sec"), "severity")


@query(
    f"""WITH {V.CLIPS}, m AS (SELECT *, CASE WHEN max(end_sec) OVER w - start_sec > 1e-9 THEN 0 ELSE 1 END AS n FROM clips WHERE end_sec > start_sec
        WINDOW w AS (PARTITION BY source_id ORDER BY start_sec, end_sec, clip_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        i AS (SELECT *, sum(n) OVER (PARTITION BY source_id ORDER BY start_sec, end_sec, clip_id ROWS UNBOUNDED PRECEDING) AS island FROM m),
        g AS (SELECT *, count(*) OVER (PARTITION BY source_id, island) AS members, min(clip_id) OVER (PARTITION BY source_id, island) AS least_id FROM i),
        r AS (SELECT *, dense_rank() OVER (ORDER BY least_id) AS k FROM g WHERE members > 1)
        SELECT clip_id, source_id, 'OVL' || CASE WHEN k < 1000 THEN lpad(k::VARCHAR, 3, '0') ELSE k::VARCHAR END AS overlap_group, members FROM r"""
)
def overlap_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlap_groups(V.clips(spark, sf_dir))


@query(
    f"""WITH {V.CLIPS}, {_PAIRS}, s AS (SELECT left_id AS clip_id, o FROM pairs UNION ALL SELECT right_id, o FROM pairs), m AS (SELECT clip_id, max(o) AS o FROM s GROUP BY clip_id)
        SELECT c.clip_id, CASE WHEN NOT (c.end_sec > c.start_sec) THEN 'NOT_CHECKED' WHEN m.o IS NOT NULL THEN 'CHECKED_OVERLAP' ELSE 'CHECKED_NO_OVERLAP' END AS overlap_status, round(m.o, 3) AS overlap_max_sec FROM clips c LEFT JOIN m USING (clip_id)"""
)
def overlap_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlap_status(V.clips(spark, sf_dir)).select("clip_id", "overlap_status", F.round("overlap_max_sec", 3).alias("overlap_max_sec"))


@query(
    f"""WITH {V.CLIPS}, n AS (SELECT source_id, clip_id, lag(clip_id) OVER w AS previous_id, lag(end_sec) OVER w - start_sec AS o FROM clips WHERE end_sec > start_sec WINDOW w AS (PARTITION BY source_id ORDER BY start_sec, end_sec, clip_id))
        SELECT source_id, clip_id, previous_id, CASE WHEN o > 600.001 THEN 'EXCESS_TEMPORAL_OVERLAP' ELSE 'TIMELINE_GAP' END AS issue_code, round(o, 3) AS overlap_sec FROM n WHERE o > 600.001 OR o < -0.001"""
)
def timeline_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.timeline_issues(V.clips(spark, sf_dir), 600.0, 0.001).withColumn("overlap_sec", F.round("overlap_sec", 3))


@query(
    f"""WITH {V.CLIPS}, n AS (SELECT source_id, lag(end_sec) OVER (PARTITION BY source_id ORDER BY start_sec, end_sec) - start_sec AS o FROM clips WHERE end_sec > start_sec)
        SELECT source_id, count(*) FILTER (abs(o - 600) <= 500) AS expected_pairs, count(*) FILTER (NOT abs(o - 600) <= 500 AND (o > 1100 OR o < -500)) AS irregular_pairs FROM n GROUP BY source_id"""
)
def timeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.timeline_counts(V.clips(spark, sf_dir), 600.0, 500.0)


# ---- dedupe -----------------------------------------------------------------------------------------------------

_ITEMS = """items AS (SELECT v.*, CASE WHEN l.quality = 0 THEN 'invalid' WHEN l.toxic = 1 THEN 'warning' ELSE 'valid' END AS status, CASE WHEN v.doc_id % 3 = 0 THEN 'source.mp4' ELSE 'copy.mp4' END AS filename,
    CASE WHEN v.doc_id % 2 = 0 THEN 'W' || (v.doc_id // 2) ELSE 'W' || (v.doc_id // 4) END AS origin FROM videos v LEFT JOIN labels l USING (doc_id)),
    one AS (SELECT *, row_number() OVER (PARTITION BY origin ORDER BY CASE status WHEN 'valid' THEN 0 ELSE 1 END, CASE filename WHEN 'source.mp4' THEN 0 ELSE 1 END, local_path, video_id) = 1 AS f FROM items),
    two AS (SELECT *, f AND row_number() OVER (PARTITION BY sha256, f ORDER BY CASE status WHEN 'valid' THEN 0 ELSE 1 END, CASE filename WHEN 'source.mp4' THEN 0 ELSE 1 END, local_path, video_id) > 1 AS again FROM one)"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = V.videos(spark, sf_dir).join(V.table(spark, sf_dir, "labels"), "doc_id", "left")
    origin = F.concat(F.lit("W"), F.when(F.col("doc_id") % 2 == 0, F.expr("doc_id div 2")).otherwise(F.expr("doc_id div 4")))
    return v.select(
        "video_id", origin.alias("source_video_id"), "sha256", "local_path", "duration_sec", F.lit(640).alias("width"), (F.col("doc_id") % 500).alias("height"), F.when(F.col("quality") == 0, "invalid").when(F.col("toxic") == 1, "warning").otherwise("valid").alias("status"), F.when(F.col("doc_id") % 3 == 0, "source.mp4").otherwise("copy.mp4").alias("filename")
    )


@query(f"WITH {V.VIDEOS}, {_ITEMS} SELECT video_id, NOT f AS duplicate_source, again AS duplicate_checksum FROM two")
def preferred_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.preferred_sources(_items(spark, sf_dir)).select("video_id", "duplicate_source", "duplicate_checksum")


@query(
    f"""WITH {V.VIDEOS}, {_ITEMS} SELECT video_id, concat_ws(';', CASE WHEN status = 'invalid' THEN 'invalid_video' END, CASE WHEN duration_sec < 500 THEN 'too_short' END, CASE WHEN doc_id % 500 < 240 THEN 'unsupported_resolution' END,
        CASE WHEN NOT f THEN 'duplicate_source_video_id' END, CASE WHEN again THEN 'duplicate_checksum' END) AS review_reason FROM two"""
)
def review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.review_reasons(_items(spark, sf_dir), 500, 320, 240).select("video_id", "review_reason")


@query(
    f"""WITH {V.VIDEOS}, g AS (SELECT *, count(*) OVER (PARTITION BY sha256) AS members, min(video_id) OVER (PARTITION BY sha256) AS a FROM videos),
        b AS (SELECT sha256, min(video_id) AS b FROM g WHERE video_id != a GROUP BY sha256), r AS (SELECT *, dense_rank() OVER (ORDER BY sha256) AS k FROM g WHERE members > 1)
        SELECT video_id AS clip_id, 'DUP' || CASE WHEN k < 1000 THEN lpad(k::VARCHAR, 3, '0') ELSE k::VARCHAR END AS duplicate_group, members, CASE WHEN video_id = a THEN b ELSE a END AS related_clip_id FROM r JOIN b USING (sha256)"""
)
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_groups(V.videos(spark, sf_dir), "video_id").select("clip_id", "duplicate_group", "members", "related_clip_id")


@query("SELECT sha AS key, count(*) AS times FROM (SELECT sha256(text) AS sha FROM documents) GROUP BY sha HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_keys(V.videos(spark, sf_dir).withColumnRenamed("sha256", "key"), "key")


@query(
    """WITH m AS (SELECT page_id, 'http' || regexp_replace(url, '^https?', '') AS local_path, list_extract(string_split(url, '/'), -1) AS name FROM pages), p AS (SELECT local_path, arg_max(page_id::VARCHAR, page_id) AS by_path FROM m GROUP BY local_path),
        n AS (SELECT name, min(page_id::VARCHAR) AS by_name FROM m GROUP BY name HAVING count(*) = 1)
        SELECT page_id, coalesce(by_path, by_name) AS clip_id, CASE WHEN by_path IS NOT NULL THEN 'path' WHEN by_name IS NOT NULL THEN 'basename' ELSE 'none' END AS matched_by
        FROM (SELECT page_id, url AS path, list_extract(string_split(url, '/'), -1) AS name FROM pages) f LEFT JOIN p ON f.path = p.local_path LEFT JOIN n ON f.name = n.name"""
)
def fallback_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = V.table(spark, sf_dir, "pages")
    manifest = p.select(F.col("page_id").cast("string").alias("clip_id"), F.concat(F.lit("http"), F.regexp_replace("url", "^https?", "")).alias("local_path"), F.col("page_id").alias("ordinal"))
    return dedupe.fallback_match(p.select("page_id", F.col("url").alias("path")), manifest).select("page_id", "clip_id", "matched_by")


@query("SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY source || lang ORDER BY doc_id::VARCHAR) > 1 THEN source || lang || '-' || substr(sha256(doc_id::VARCHAR), 1, 8) ELSE source || lang END AS clip_id FROM documents")
def collision_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents").select("doc_id", F.concat("source", "lang").alias("clip_id"), F.col("doc_id").cast("string").alias("path"))
    return dedupe.collision_suffix(d).select("doc_id", "clip_id")


# ---- registry ---------------------------------------------------------------------------------------------------


@query(
    f"""WITH {V.CLIPS}, n AS (SELECT source_id, lag(end_sec) OVER (PARTITION BY source_id ORDER BY start_sec, end_sec) - start_sec AS o FROM clips WHERE end_sec > start_sec),
        t AS (SELECT source_id, count(*) FILTER (abs(o - 600) <= 500) AS expected_pairs, count(*) FILTER (NOT abs(o - 600) <= 500 AND (o > 1100 OR o < -500)) AS irregular_pairs FROM n GROUP BY source_id),
        s AS (SELECT source_id, count(*) AS num_clips, round(sum(duration_sec), 3) AS total_duration_sec, min(start_sec) AS first_clip_start_sec, max(end_sec) AS last_clip_end_sec FROM clips GROUP BY source_id)
        SELECT s.*, coalesce(expected_pairs, 0) AS expected_pairs, coalesce(irregular_pairs, 0) AS irregular_pairs, CASE WHEN source_id::INT % 2 = 0 THEN 'CAM' || source_id ELSE 'UNRESOLVED' END AS camera_id FROM s LEFT JOIN t USING (source_id)"""
)
def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = V.clips(spark, sf_dir)
    n = F.col("source_id").cast("int")
    cameras = clips.select("source_id").distinct().select("source_id", F.when(n % 2 == 0, F.concat(F.lit("CAM"), "source_id")).alias("mapped_camera"), F.lit("").alias("catalog_camera"))
    out = registry.source_registry(clips, cameras, 600.0, 500.0).withColumn("total_duration_sec", F.round("total_duration_sec", 3)).fillna(0, ["expected_pairs", "irregular_pairs"])
    return out.select("source_id", "num_clips", "total_duration_sec", "first_clip_start_sec", "last_clip_end_sec", "expected_pairs", "irregular_pairs", "camera_id")


@query(
    """WITH c AS (SELECT c_custkey, c_nationkey::VARCHAR AS source_id, CASE WHEN c_custkey % 5 = 0 THEN 'CAM' || c_nationkey END AS mapped, CASE WHEN c_nationkey % 2 = 0 THEN 'unknown' ELSE '' END AS cat FROM customer),
        s AS (SELECT source_id, count(*) AS num_clips, max(mapped) FILTER (c_custkey % 10 = 0 AND source_id::INT % 3 = 0) AS m, max(cat) AS c FROM c GROUP BY source_id)
        SELECT source_id, num_clips, coalesce(nullif(m, ''), nullif(c, ''), 'UNRESOLVED') AS camera_id, CASE WHEN upper(coalesce(nullif(m, ''), nullif(c, ''), 'UNRESOLVED')) IN ('', 'UNRESOLVED', 'UNKNOWN', 'NULL', 'NONE') THEN 'UNRESOLVED' ELSE 'RESOLVED' END AS camera_status FROM s"""
)
def camera_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = V.table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("source_id"), "c_nationkey", "c_custkey")
    clips = c.select("source_id", F.col("c_custkey").cast("string").alias("clip_id"), F.lit(1.0).alias("duration_sec"), F.col("c_custkey").cast("double").alias("start_sec"), (F.col("c_custkey") + 1.0).alias("end_sec"))
    mapped = F.when((F.col("c_custkey") % 10 == 0) & (F.col("c_nationkey") % 3 == 0), F.concat(F.lit("CAM"), "c_nationkey"))
    cameras = c.groupBy("source_id").agg(F.max(mapped).alias("mapped_camera"), F.max(F.when(F.col("c_nationkey") % 2 == 0, "unknown").otherwise("")).alias("catalog_camera"))
    return registry.source_registry(clips, cameras).select("source_id", "num_clips", "camera_id", "camera_status")


_PARTS = """parts AS (SELECT p_partkey::VARCHAR AS clip_id, p_brand AS source_id, (p_size % 4 + 24)::DOUBLE AS fps, p_size % 3 + 1 AS width, 1 AS height, p_partkey AS ordinal FROM part)"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("clip_id"), F.col("p_brand").alias("source_id"), (F.col("p_size") % 4 + 24).cast("double").alias("fps"), (F.col("p_size") % 3 + 1).alias("width"), F.lit(1).alias("height"), F.col("p_partkey").alias("ordinal")
    )


@query(
    f"""WITH {_PARTS}, f AS (SELECT source_id, fps, count(*) AS n, min(ordinal) AS o FROM parts GROUP BY ALL), mf AS (SELECT source_id, arg_max(fps, (n, -o)) AS mode_fps, max(n) AS nf FROM f GROUP BY source_id),
        s AS (SELECT source_id, width, count(*) AS n, min(ordinal) AS o FROM parts GROUP BY ALL), ms AS (SELECT source_id, arg_max(width, (n, -o)) AS mode_w, max(n) AS ns FROM s GROUP BY source_id)
        SELECT clip_id, source_id, nf >= 2 AND abs(fps - mode_fps) > greatest(0.1, mode_fps * 0.02) AS fps_anomaly, ns >= 2 AND width != mode_w AS resolution_anomaly FROM parts JOIN mf USING (source_id) JOIN ms USING (source_id)"""
)
def modal_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.modal_anomalies(_parts(spark, sf_dir))


@query(
    f"""WITH {_PARTS}, b AS (SELECT *, first_value(width) OVER (PARTITION BY source_id ORDER BY ordinal) AS base FROM parts)
        SELECT clip_id, source_id, 'width' AS field, width::VARCHAR AS value, base::VARCHAR AS baseline FROM b WHERE NOT abs(width - base) <= 0.001"""
)
def baseline_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.baseline_issues(_parts(spark, sf_dir), {"width": 0.001})


# ---- rules ------------------------------------------------------------------------------------------------------

_LINE_RULES = """lines AS (SELECT l_orderkey, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, CASE WHEN l_discount > 0.09::DOUBLE THEN 2 WHEN l_quantity > 45 THEN 1 ELSE 0 END AS r,
    concat_ws('; ', CASE WHEN l_quantity > 45 THEN 'LARGE: ' || l_linenumber END, CASE WHEN l_discount > 0.09::DOUBLE THEN 'DISCOUNT: ' || l_linenumber END) AS notes FROM lineitem)"""


def _line_issues(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = V.table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), "l_linenumber", "l_quantity", "l_discount", "l_tax")
    n = F.col("l_linenumber").cast("string")
    found = rules.apply_rules(
        rows,
        [rules.Rule("LARGE", "WARNING", F.col("l_quantity") > 45, n), rules.Rule("DISCOUNT", "FAIL", F.col("l_discount") > 0.09, n), rules.Rule("UNTAXED", "INFO", F.col("l_tax") == 0, n)],
        ["id", "l_orderkey"],
    )
    return rows.select("id", "l_orderkey"), found


@query(
    f"""WITH {_LINE_RULES} SELECT id, CASE r WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARNING' ELSE 'PASS' END AS status, notes FROM lines"""
)
def severity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = _line_issues(spark, sf_dir)
    return rules.roll_up(rows.select("id"), found, "id")


_FIGURES = """figures AS (SELECT l_orderkey || '-' || l_linenumber AS clip_id, l_orderkey * 7 + l_linenumber AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
    clips AS (SELECT clip_id, CASE n % 11 WHEN 0 THEN NULL WHEN 1 THEN -5.0 WHEN 2 THEN 0.0 WHEN 3 THEN 29.999 WHEN 4 THEN 30.0 WHEN 5 THEN 180.0 WHEN 6 THEN 180.001 ELSE 120.0 END::DOUBLE AS d, CASE n % 13 WHEN 0 THEN NULL WHEN 1 THEN 0.0 WHEN 2 THEN -25.0 ELSE 25.0 END::DOUBLE AS fps,
    CASE n % 7 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -3 WHEN 3 THEN 3060 WHEN 4 THEN 3061 ELSE 3000 END AS frames, CASE n % 17 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 1920 END AS w, CASE n % 19 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE 1080 END AS h,
    CASE n % 23 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS readable, CASE n % 29 WHEN 0 THEN 2 WHEN 1 THEN NULL ELSE 0 END AS errors, n % 31 = 0 AS guessed, n % 37 = 0 AS patched, n % 41 = 0 AS other FROM figures)"""


@query(
    f"""WITH {_FIGURES}, head AS (SELECT *, coalesce(readable, false) AS ok, abs(d - frames / fps) AS gap FROM clips),
        said AS (SELECT clip_id, list_filter(CASE WHEN NOT ok THEN [CASE WHEN other THEN 'CHECKSUM_MISMATCH: ' END, 'FILE_CORRUPTED: ', 'DECODE_ERROR: '] ELSE [
            CASE WHEN other THEN 'CHECKSUM_MISMATCH: ' END, CASE WHEN guessed THEN 'METADATA_FALLBACK: ' END,
            CASE WHEN d IS NULL THEN 'INVALID_DURATION: duration_sec=''''' WHEN d <= 0 THEN 'INVALID_DURATION: duration_sec=' || d END, CASE WHEN fps IS NULL THEN 'INVALID_FPS: fps=''''' WHEN fps <= 0 THEN 'INVALID_FPS: fps=' || fps END,
            CASE WHEN w IS NULL OR h IS NULL OR w <= 0 OR h <= 0 THEN 'INVALID_RESOLUTION: width=' || coalesce(w::VARCHAR, '''''') || ', height=' || coalesce(h::VARCHAR, '''''') END,
            CASE WHEN frames IS NOT NULL AND frames <= 0 THEN 'INVALID_FRAME_COUNT: frame_count=' || frames END, CASE WHEN patched THEN 'DECODE_FALLBACK: ' END, CASE WHEN errors > 0 THEN 'DECODE_ERROR: ' END,
            CASE WHEN d IS NOT NULL AND d <> 0 AND (d < 30 OR d > 180) THEN printf('DURATION_ANOMALY: duration_sec=%.3f is outside [30, 180]', d) END,
            CASE WHEN d IS NOT NULL AND d <> 0 AND fps IS NOT NULL AND fps <> 0 AND frames > 0 AND gap > greatest(1.0::DOUBLE, d * 0.02::DOUBLE) THEN printf('FRAME_COUNT_MISMATCH: duration=%.3fs, frame_count/fps=%.3fs, difference=%.3fs', d, frames / fps, gap) END] END, lambda x: x IS NOT NULL) AS notes FROM head)
        SELECT clip_id, CASE WHEN len(list_filter(notes, lambda x: NOT regexp_matches(x, '^(METADATA_FALLBACK|DECODE_FALLBACK|DURATION_ANOMALY|FRAME_COUNT_MISMATCH):'))) > 0 THEN 'FAIL' WHEN len(notes) > 0 THEN 'WARNING' ELSE 'PASS' END AS status, array_to_string(notes, '; ') AS notes FROM said"""
)
def technical_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as clips whose figures lie at the edges of every technical rule."""
    n = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    one_of = lambda by, values, other, kind: F.element_at(F.array(*[F.lit(x).cast(kind) for x in [*values, other]]), F.least(n % by, F.lit(len(values))).cast("int") + 1)
    x = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct().select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("clip_id"), one_of(11, [None, -5.0, 0.0, 29.999, 30.0, 180.0, 180.001], 120.0, "double").alias("duration_sec"), one_of(13, [None, 0.0, -25.0], 25.0, "double").alias("fps"),
        one_of(7, [None, 0, -3, 3060, 3061], 3000, "int").alias("frame_count"), one_of(17, [None, 0], 1920, "int").alias("width"), one_of(19, [None, -1], 1080, "int").alias("height"), one_of(23, [False, None], True, "boolean").alias("readable"),
        one_of(29, [2, None], 0, "int").alias("decode_errors"), one_of(31, ["fallback", None], "probe", "string").alias("metadata_source"), one_of(37, ["fallback", None], "probe", "string").alias("decode_source"), one_of(41, ["other", None, ""], "same", "string").alias("expected_sha256"), F.lit("same").alias("sha256"),
    )
    return rules.roll_up(x.select("clip_id"), rules.apply_rules(x, rules.technical_rules(), ["clip_id"]), "clip_id")


@query(
    f"""WITH {_LINE_RULES}, o AS (SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 2 WHEN o_orderstatus = 'P' THEN 1 END AS r, CASE WHEN o_totalprice > 400000 THEN 'DEAR: ' || o_orderstatus WHEN o_orderstatus = 'P' THEN 'PENDING: P' END AS t FROM orders)
        SELECT id, CASE greatest(s.r, coalesce(o.r, 0)) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARNING' ELSE 'PASS' END AS status, concat_ws('; ', nullif(notes, ''), o.t) AS notes FROM lines s LEFT JOIN o ON s.l_orderkey = o.o_orderkey"""
)
def escalate_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = _line_issues(spark, sf_dir)
    base = rules.roll_up(rows, found, "id")
    dear = F.col("o_totalprice") > 400000
    orders = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice", "o_orderstatus")
    group = rules.apply_rules(orders, [rules.Rule("DEAR", "FAIL", dear, F.col("o_orderstatus")), rules.Rule("PENDING", "WARNING", ~dear & (F.col("o_orderstatus") == "P"), F.col("o_orderstatus"))], ["l_orderkey"])
    return rules.escalate(base, group, "l_orderkey").select("id", "status", "notes")


@query(
    f"""WITH {V.CLIPS}, m AS (SELECT source_id || '_C' || lpad(clip_id, 8, '0') AS clip_id, source_id, start_sec, CASE WHEN ordinal % 17 = 0 THEN start_sec - 1 WHEN ordinal % 19 = 0 THEN NULL ELSE end_sec END AS end_sec, duration_sec, ordinal FROM clips),
        n AS (SELECT clip_id, lag(end_sec) OVER (PARTITION BY source_id ORDER BY start_sec, end_sec, clip_id) - start_sec AS o FROM m WHERE end_sec > start_sec),
        x AS (SELECT clip_id, unnest(list_filter([CASE WHEN end_sec IS NULL THEN 'MALFORMED_TIMESTAMPS|FAIL|start_sec/end_sec' END, CASE WHEN end_sec <= start_sec THEN 'INVALID_TIMESTAMP_ORDER|FAIL|end_sec' END,
            CASE WHEN end_sec > start_sec AND abs(duration_sec - (end_sec - start_sec)) > 0.001 THEN 'MANIFEST_DURATION_MISMATCH|FAIL|duration_sec' END, CASE WHEN ordinal % 23 = 0 THEN 'MISSING_INVENTORY_RECORD|FAIL|clip_id' END,
            CASE WHEN ordinal % 23 != 0 AND end_sec IS NULL THEN 'METADATA_INVENTORY_MISMATCH|FAIL|end_sec' END, CASE WHEN ordinal % 23 != 0 AND ordinal % 41 = 0 THEN 'METADATA_INVENTORY_MISMATCH|FAIL|clip_path' END, CASE WHEN ordinal % 41 = 0 THEN 'CLIP_PATH_NAMING_INCONSISTENCY|WARNING|clip_path' END,
            CASE WHEN ordinal % 23 != 0 AND ordinal % 29 = 0 THEN 'CHECKSUM_MISMATCH|FAIL|sha256' END, 'UNRESOLVED_CAMERA|WARNING|camera_id', CASE WHEN ordinal % 23 = 0 THEN 'INVALID_QC_STATUS|FAIL|qc_status' WHEN ordinal % 31 = 0 THEN 'QC_WARNING|WARNING|qc_status' END], lambda x: x IS NOT NULL)) AS c FROM m
        UNION ALL SELECT source_id || '_C' || lpad(clip_id, 8, '0') || 'x', 'ORPHAN_INVENTORY_RECORD|FAIL|clip_id' FROM clips WHERE ordinal % 37 = 0
        UNION ALL SELECT clip_id, CASE WHEN o > 10.001 THEN 'EXCESS_TEMPORAL_OVERLAP' ELSE 'TIMELINE_GAP' END || '|WARNING|start_sec' FROM n WHERE o > 10.001 OR o < -0.001
        UNION ALL SELECT source_id || '_C' || lpad(clip_id, 8, '0') || 'x', 'DUPLICATE_INVENTORY_CLIP_ID|FAIL|clip_id' FROM clips WHERE ordinal % 74 = 0)
        SELECT clip_id, split_part(c, '|', 1) AS code, split_part(c, '|', 2) AS severity, split_part(c, '|', 3) AS field FROM x"""
)
def metadata_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest with errors of many sorts against an inventory with rows of its own, some of them twice."""
    c = V.clips(spark, sf_dir)
    name = F.concat("source_id", F.lit("_C"), F.lpad("clip_id", 8, "0"))
    o = F.col("ordinal")
    path = F.concat(F.lit("clips/"), name, F.when(o % 41 == 0, "_.mp4").otherwise(".mp4"))
    m = c.select(name.alias("clip_id"), "source_id", path.alias("local_path"), "start_sec", F.when(o % 17 == 0, F.col("start_sec") - 1).when(o % 19 == 0, None).otherwise(F.col("end_sec")).alias("end_sec"), "duration_sec", F.lit("x").alias("sha256"), "ordinal")
    kept = F.concat(F.lit("clips/"), "clip_id", F.lit(".mp4")).alias("file_path")
    inv = m.filter(o % 23 != 0).select("clip_id", "source_id", kept, "start_sec", "end_sec", "duration_sec", F.when(o % 29 == 0, "y").otherwise("x").alias("sha256"), F.when(o % 31 == 0, "WARNING").otherwise("PASS").alias("qc_status"), "ordinal")
    extra = m.filter(o % 37 == 0).select(F.concat("clip_id", F.lit("x")).alias("clip_id"), "source_id", kept, "start_sec", "end_sec", "duration_sec", "sha256", F.lit("PASS").alias("qc_status"), "ordinal")
    reg = m.select("source_id").distinct().withColumn("camera_id", F.lit("UNRESOLVED"))
    found = rules.metadata_issues(m, inv.unionByName(extra).unionByName(extra.filter(o % 74 == 0)), reg)
    return found.select("clip_id", "code", "severity", "field")


@query(
    """WITH l AS (SELECT doc_id::VARCHAR AS clip_id, CASE WHEN quality = 1 THEN 'negative' ELSE 'hard' END AS g FROM labels UNION ALL SELECT doc_id::VARCHAR, 'positive' FROM labels WHERE toxic = 1),
        e AS (SELECT DISTINCT user_id::VARCHAR AS clip_id FROM events), c AS (SELECT doc_id::VARCHAR AS clip_id FROM documents), s AS (SELECT c.clip_id, list(DISTINCT g) FILTER (g IS NOT NULL) AS g, any_value(e.clip_id) IS NOT NULL AS ev FROM c LEFT JOIN l USING (clip_id) LEFT JOIN e USING (clip_id) GROUP BY c.clip_id)
        SELECT clip_id AS entity, unnest(list_filter([CASE WHEN g IS NULL THEN 'missing_scenario' END, CASE WHEN g = ['hard'] THEN 'missing_outcome_scenario' END, CASE WHEN list_contains(g, 'negative') AND list_contains(g, 'positive') THEN 'conflicting_scenarios' END,
            CASE WHEN list_contains(g, 'negative') AND ev THEN 'negative_has_events' END, CASE WHEN list_contains(g, 'positive') AND NOT ev THEN 'positive_without_event' END], lambda x: x IS NOT NULL)) AS code FROM s"""
)
def group_logic(spark: SparkSession, sf_dir: str) -> DataFrame:
    clip = F.col("doc_id").cast("string").alias("clip_id")
    lab = V.table(spark, sf_dir, "labels")
    scenarios = lab.select(clip, F.when(F.col("quality") == 1, "negative").otherwise("hard").alias("scenario_group")).unionByName(lab.filter("toxic = 1").select(clip, F.lit("positive").alias("scenario_group")))
    events = V.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("clip_id"))
    return rules.scenario_logic(V.table(spark, sf_dir, "documents").select(clip), scenarios, events).select("entity", "code")


@query(
    """SELECT o_orderkey, 'o_totalprice' AS difference FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 13 != 0 AND o_orderkey % 17 != 0
        UNION ALL SELECT o_orderkey, 'missing_candidate' FROM orders WHERE o_orderkey % 13 = 0 AND o_orderkey % 17 != 0 UNION ALL SELECT o_orderkey, 'unknown_candidate' FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey % 13 != 0"""
)
def identity_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two copies of one table, from which rows were taken on either side and some prices changed: the filters make the differences."""
    o = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    a = o.filter("o_orderkey % 13 != 0")
    b = o.filter("o_orderkey % 17 != 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return selection.same_identity(a, b, ["o_totalprice", "o_orderstatus"], "o_orderkey")


# ---- scoring ----------------------------------------------------------------------------------------------------


@query(f"WITH {V.SCORED} SELECT clip_id, event_likelihood_score, event_likelihood_level, hardcase_score, hardcase_tags FROM scored")
def level_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_signals(V.signals(spark, sf_dir)).select("clip_id", "event_likelihood_score", "event_likelihood_level", "hardcase_score", "hardcase_tags")


_DIVERSE = (
    V.SCORED
    + ", med AS (SELECT "
    + ", ".join(f"median({f}) AS m_{f}" for f in scoring.FEATURES)
    + " FROM scored), spr AS (SELECT "
    + ", ".join(f"greatest(quantile_cont(abs({f} - m_{f}), 0.75::DOUBLE), 0.05::DOUBLE) AS s_{f}" for f in scoring.FEATURES)
    + " FROM scored, med), div AS (SELECT clip_id, source_id, event_likelihood_score, hardcase_score, activity_score, ("
    + " + ".join(f"least(abs({f} - m_{f}) / (2.5::DOUBLE * s_{f}), 1.0::DOUBLE)" for f in scoring.FEATURES)
    + ") / 7 AS diversity FROM scored, med, spr), cand AS (SELECT *, round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.42::DOUBLE * event_likelihood_score + 0.28::DOUBLE * hardcase_score + 0.18::DOUBLE * diversity + 0.12::DOUBLE * activity_score)), 6) AS candidate_score FROM div)"
)


@query(f"WITH {_DIVERSE} SELECT clip_id, round(diversity, 5) AS diversity_score FROM cand")
def robust_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.with_diversity(scoring.score_signals(V.signals(spark, sf_dir))).select("clip_id", F.round("diversity", 5).alias("diversity_score"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.candidate_scores(scoring.score_signals(V.signals(spark, sf_dir)))


@query(f"WITH {_DIVERSE} SELECT clip_id, candidate_score FROM cand")
def candidate_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("clip_id", "candidate_score")


@query("SELECT doc_id::VARCHAR AS clip_id, row_number() OVER (ORDER BY n_chars DESC, doc_id::VARCHAR) AS global_rank FROM documents")
def global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("clip_id"), F.col("n_chars").cast("double").alias("candidate_score"))
    return scoring.global_rank(d).select("clip_id", "global_rank")


@query("SELECT doc_id::VARCHAR AS clip_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id::VARCHAR)::INT AS source_rank FROM documents")
def source_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("clip_id"), F.col("source").alias("source_id"), F.col("n_chars").alias("candidate_score"))
    return scoring.source_rank(d).select("clip_id", "source_rank")


@query(
    f"""WITH {V.SIGNATURES} SELECT a.source_id, least(a.clip_id, b.clip_id) AS left_id, greatest(a.clip_id, b.clip_id) AS right_id, bit_count(xor(a.bits, b.bits))::INT AS distance FROM signatures a JOIN signatures b ON a.source_id = b.source_id AND a.clip_id < b.clip_id
        WHERE bit_count(xor(a.bits, b.bits)) <= 22"""
)
def signature_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.signature_pairs(V.signatures(spark, sf_dir), 22)


@query(
    f"""WITH {V.SIGNATURES}, turned AS (SELECT clip_id || 'b' AS clip_id, source_id, array_to_string(list_transform(embedding, lambda x, i: CASE WHEN coalesce(x > 0, false) != (i <= e.vec_id % 16) THEN '1' ELSE '0' END), '')::BIT AS bits
        FROM signatures s JOIN embeddings e USING (vec_id)), clips AS (SELECT clip_id, source_id, bits FROM signatures UNION ALL FROM turned)
        SELECT a.source_id, a.clip_id AS left_id, b.clip_id AS right_id, bit_count(xor(a.bits, b.bits))::INT AS distance FROM clips a JOIN clips b ON a.source_id = b.source_id AND a.clip_id < b.clip_id WHERE bit_count(xor(a.bits, b.bits)) <= 9"""
)
def signature_adjacent_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs as alike as neighbours on a timeline have to be (0.86), by bands with one bit turned: each embedding's clip and one that follows it with some bits changed."""
    clips = V.signatures(spark, sf_dir).select("clip_id", "source_id", "signature", "vec_id")
    changed = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("vec_id", F.lit(16)).cast("int")) - 1
    after = clips.withColumns({"clip_id": F.concat("clip_id", F.lit("b")), "signature": F.col("signature").bitwiseXOR(changed)})
    return scoring.signature_pairs(clips.unionByName(after), 9)


@query(
    f"""WITH {V.SIGNATURES}, c AS (SELECT * FROM signatures WHERE vec_id % 10 = 0) SELECT r.clip_id FROM signatures r SEMI JOIN c ON r.source_id = c.source_id AND r.clip_id != c.clip_id AND (bit_count(xor(r.bits, c.bits)) <= 64 * 0.3
        OR (greatest(0.0, greatest(r.start_sec, c.start_sec) - least(r.end_sec, c.end_sec)) <= 500 AND bit_count(xor(r.bits, c.bits)) <= 64 * 0.4)) WHERE vec_id % 10 != 0"""
)
def redundant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.signatures(spark, sf_dir).drop("embedding")
    return scoring.redundant(s, s.filter("vec_id % 10 = 0"), content=0.7, adjacent=0.6, adjacency_sec=500.0).select("clip_id")


@query(
    """WITH n AS (SELECT source AS source_id, count(*) AS n FROM documents GROUP BY source), b AS (SELECT *, least(n, 3)::INT AS f, least(n, 55)::INT AS m FROM n), s AS (SELECT source_id, n, unnest(range(f, m)) AS k FROM b),
        r AS (SELECT *, row_number() OVER (ORDER BY sqrt(n) / (k + 1) DESC, source_id DESC) AS r FROM s), t AS (SELECT source_id, count(*) AS more FROM r WHERE r <= (SELECT 110 - sum(f) FROM b) GROUP BY source_id)
        SELECT source_id, n, (f + coalesce(more, 0))::INT AS quota FROM b LEFT JOIN t USING (source_id)"""
)
def source_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = V.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("source_id")).agg(F.count(F.lit(1)).alias("n"))
    return scoring.source_quotas(n, 110, 3, 0.5)


@query(f"WITH {V.SCORED} SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(hardcase_tags, '|')) AS tag FROM scored) WHERE tag != '' GROUP BY tag")
def tag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.tag_histogram(scoring.score_signals(V.signals(spark, sf_dir)))


@query(f"WITH {V.SCORED} SELECT level, count(s.clip_id) AS n FROM (VALUES ('LOW'), ('MEDIUM'), ('HIGH')) v(level) LEFT JOIN scored s ON s.event_likelihood_level = v.level GROUP BY level")
def level_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.level_histogram(scoring.score_signals(V.signals(spark, sf_dir)))


# ---- selection --------------------------------------------------------------------------------------------------


def _pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = V.signatures(spark, sf_dir)
    unit = lambda i: (F.get("embedding", F.lit(i)).cast("double") + 1) / 2
    rows = e.select("clip_id", "source_id", "signature", "start_sec", "end_sec", F.lit("COMPUTED").alias("signal_status"), *[S.score6(unit(i)).alias(f) for i, f in enumerate(scoring.FEATURES)])
    level = F.element_at(F.array(F.lit("LOW"), F.lit("MEDIUM"), F.lit("HIGH")), (F.col("clip_id").cast("int") % 3 + 1).cast("int"))
    return scoring.candidate_scores(rows).withColumn("event_likelihood_level", level).withColumn("hardcase_tags", F.when(F.col("clip_id").cast("int") % 3 == 0, "BLUR").otherwise(""))


@query(
    f"""{V.CHOICES} SELECT clip_id, source_id, score AS candidate_score, coalesce(pick, 0)::INT AS pick_number, CASE WHEN taken THEN 'YES' ELSE 'NO' END AS recommended_for_shortlist, CASE WHEN taken THEN 'REVIEW_POOL' ELSE 'NOT_SELECTED' END AS selection_status, CASE WHEN taken THEN 'PENDING' ELSE '' END AS manual_review_status,
        CASE WHEN taken THEN 'source_coverage=' || source_id || '; event_likelihood=' || list_extract(['LOW', 'MEDIUM', 'HIGH'], (lev + 1)::INT) || '; hardcase=' || CASE WHEN hard THEN 'BLUR' ELSE 'NORMAL_CASE' END || '; diversity_aware_rank; selection_signal_only_not_ground_truth' ELSE '' END AS selection_reason FROM chosen"""
)
def greedy_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool with the number of each choice; 0 is no choice."""
    return selection.select_pool(_pool(spark, sf_dir), SELECTION | {"source_minimum": 5}).withColumn("pick_number", F.coalesce("pick_number", F.lit(0)))


@query(
    """WITH c AS (SELECT doc_id, sha256(text) AS sha, CASE WHEN doc_id % 5 = 0 THEN 'old' ELSE sha256(text) END AS cached FROM documents) SELECT doc_id, CASE WHEN sha = cached AND doc_id % 7 != 0 THEN 'hit' ELSE 'miss' END AS outcome FROM c"""
)
def cache_hit_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = V.videos(spark, sf_dir).select(F.col("video_id").alias("clip_id"), "doc_id", "sha256", "ordinal")
    cache = v.select("clip_id", F.when(F.col("doc_id") % 5 == 0, "old").otherwise(F.col("sha256")).alias("analysis_sha256"), F.lit("f").alias("analysis_fingerprint"), F.when(F.col("doc_id") % 7 == 0, "").otherwise("s").alias("visual_signature"), "ordinal")
    hits, misses = selection.cache_split(v, cache, "f", ("visual_signature",))
    return hits.select("doc_id", F.lit("hit").alias("outcome")).unionByName(misses.select("doc_id", F.lit("miss").alias("outcome")))


@query("SELECT doc_id, CASE WHEN l.quality IS NULL THEN '' WHEN l.quality = 1 THEN 'KEEP' ELSE 'REJECT' END AS review_status, CASE WHEN l.toxic = 1 THEN 'note' ELSE 'new' END AS review_note FROM documents d LEFT JOIN labels l USING (doc_id)")
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = V.table(spark, sf_dir, "documents").select("doc_id", F.lit("").alias("review_status"), F.lit("new").alias("review_note"))
    old = V.table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "KEEP").otherwise("REJECT").alias("review_status"), F.when(F.col("toxic") == 1, "note").otherwise("").alias("review_note"), F.lit(1).alias("ordinal"))
    return selection.carry_forward(new, old, "doc_id", ["review_status", "review_note"])


@query(
    """WITH n AS (SELECT doc_id AS k, source AS source_video_id, 'pending' AS status FROM documents WHERE doc_id % 3 != 0), o AS (SELECT doc_id AS k, source AS source_video_id, CASE WHEN quality = 1 THEN 'keep' ELSE 'reject' END AS status FROM documents JOIN labels USING (doc_id))
        SELECT * FROM n UNION ALL SELECT * FROM o WHERE status = 'keep' AND k % 3 = 0 AND source_video_id NOT IN ('src0', 'src1')"""
)
def regenerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates made anew and old ones; the filters make rows of each kind."""
    d = V.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), F.col("source").alias("source_video_id"))
    new = d.filter("k % 3 != 0").withColumn("status", F.lit("pending"))
    old = d.join(V.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("k"), "quality"), "k").select("k", "source_video_id", F.when(F.col("quality") == 1, "keep").otherwise("reject").alias("status"))
    return selection.regenerate(new, old, d.filter("source_video_id not in ('src0', 'src1')"), "k")


# ---- split ------------------------------------------------------------------------------------------------------

_SPLIT = """g AS (SELECT o_custkey, row_number() OVER (ORDER BY sha256('42:' || o_custkey)) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT o_custkey FROM orders)),
    s AS (SELECT o_custkey, CASE WHEN r <= CASE WHEN n > 1 THEN greatest(1, least(n - 1, round_even(n * 0.7::DOUBLE, 0))) ELSE round_even(n * 0.7::DOUBLE, 0) END THEN 'dev' ELSE 'test' END AS split FROM g)"""


@query(f"WITH {_SPLIT} SELECT o_orderkey, o_custkey, split FROM orders JOIN s USING (o_custkey)")
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.assign_split(V.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey").select("o_orderkey", "o_custkey", "split")


@query(f"WITH {_SPLIT}, x AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 97 = 0 THEN 'test' ELSE split END AS split FROM orders JOIN s USING (o_custkey)) SELECT o_custkey, count(DISTINCT split) AS splits FROM x GROUP BY o_custkey HAVING count(DISTINCT split) > 1")
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = group_split(spark, sf_dir).withColumn("split", F.when(F.col("o_orderkey") % 97 == 0, "test").otherwise(F.col("split")))
    return split.leakage(x, "o_custkey")


@query(
    f"WITH {_SPLIT} SELECT o_orderpriority AS scenario, count(*) FILTER (split = 'dev') AS count_dev, count(*) FILTER (split = 'test') AS count_test, count(*) AS total FROM orders JOIN s USING (o_custkey) WHERE o_orderstatus = 'F' GROUP BY o_orderpriority"
)
def scenario_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.table(spark, sf_dir, "orders")
    scenarios = o.select(F.col("o_orderkey").alias("clip_id"), F.col("o_orderpriority").alias("scenario"), F.when(F.col("o_orderstatus") == "F", "approved").otherwise("pending").alias("review_status"))
    return split.coverage(scenarios, group_split(spark, sf_dir).withColumnRenamed("o_orderkey", "clip_id"))


# ---- text functions ---------------------------------------------------------------------------------------------


@query("SELECT doc_id FROM documents WHERE contains(replace(lower(strip_accents(text)), 'đ', 'd'), 'retitioning') OR contains(replace(lower(strip_accents(text)), 'đ', 'd'), 'eeeux')")
def keyword_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "documents").filter(S.any_keyword("text", ["Retitioning", "éÊeux"])).select("doc_id")


@query(
    """WITH u AS (SELECT page_id, 'https://www.youtube.com/watch?v=' || substr(sha256(url), 1, CASE WHEN page_id % 4 = 0 THEN 9 ELSE 11 END) || CASE WHEN page_id % 3 = 0 THEN '&t=5' ELSE '' END AS ref FROM pages)
        SELECT page_id, CASE WHEN length(regexp_extract(ref, 'v=([^&]*)', 1)) = 11 THEN regexp_extract(ref, 'v=([^&]*)', 1) END AS video_id FROM u"""
)
def reference_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = V.table(spark, sf_dir, "pages")
    made = F.concat(F.lit("https://www.youtube.com/watch?v="), F.expr("substring(sha2(url, 256), 1, if(page_id % 4 = 0, 9, 11))"), F.when(F.col("page_id") % 3 == 0, "&t=5").otherwise(""))
    return p.select("page_id", S.video_id_of(made).alias("video_id"))


@query("SELECT page_id, list_extract(string_split(url, '/'), -1) AS name, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages")
def url_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "pages").select("page_id", S.basename("url").alias("name"), F.try_parse_url("url", F.lit("HOST")).alias("host"))


@query("SELECT l_orderkey, l_linenumber, coalesce(TRY_CAST(l_quantity AS DOUBLE) / nullif(l_linenumber - 1, 0), 0.0::DOUBLE) AS rate FROM lineitem")
def rational_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = V.table(spark, sf_dir, "lineitem")
    return x.select("l_orderkey", "l_linenumber", S.rate(F.concat(F.col("l_quantity").cast("string"), F.lit("/"), (F.col("l_linenumber") - 1).cast("string"))).alias("rate"))


# ---- catalog ----------------------------------------------------------------------------------------------------


@query(
    f"""WITH {V.LOG} SELECT video_id, arg_max(payload, (ts, event_id)) FILTER (payload IS NOT NULL) AS duration_sec, coalesce(arg_max(event_type, (ts, event_id)) FILTER (event_type != 'error'), 'unknown') AS live_status, arg_min(event_type, (ts, event_id)) AS item_type FROM log GROUP BY video_id"""
)
def upsert_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = V.log(spark, sf_dir)
    rows = x.select(
        "video_id", F.lit("c").alias("channel_id"), F.lit("u").alias("source_url"), F.col("event_type").alias("item_type"), F.lit(None).cast("string").alias("channel_name"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("scheduled_start"), F.lit(None).cast("string").alias("actual_start"), F.col("payload").alias("duration_sec"), F.when(F.col("event_type") == "error", "unknown").otherwise(F.col("event_type")).alias("live_status"), "ts", "event_id",
    )
    return catalog.fold_batch(rows, ["ts", "event_id"]).select("video_id", "duration_sec", "live_status", "item_type")


@query(f"WITH {V.LOG} SELECT video_id, max(event_id) AS id, arg_max(event_type, event_id) AS job_type FROM log GROUP BY video_id")
def latest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.latest_jobs(V.log(spark, sf_dir).select("video_id", F.col("event_id").alias("id"), F.col("event_type").alias("job_type"))).select("video_id", "id", "job_type")


_STATES = "['is_upcoming', 'is_live', 'was_live', 'not_live', 'unknown']"
_LOCALS = "['DISCOVERED', 'WAITING', 'QUEUED', 'RECORDING', 'COMPLETED', 'FAILED', 'RETRY']"


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = V.table(spark, sf_dir, "events")
    pick = lambda xs, c: F.element_at(F.array(*[F.lit(x) for x in xs]), (c % len(xs) + 1).cast("int"))
    live, local = ("is_upcoming", "is_live", "was_live", "not_live", "unknown"), ("DISCOVERED", "WAITING", "QUEUED", "RECORDING", "COMPLETED", "FAILED", "RETRY")
    return e.select("event_id", "user_id", "ts", pick(live, F.col("event_id")).alias("live_status"), pick(local, F.expr("event_id div 5")).alias("local_status"), F.nullif((F.expr("event_id div 35") % 3).cast("int"), F.lit(2)).alias("capture_complete"))


_ROWS = f"""items AS (SELECT event_id, user_id, ts, list_extract({_STATES}, (event_id % 5 + 1)::INT) AS live_status, list_extract({_LOCALS}, (event_id // 5 % 7 + 1)::INT) AS local_status, nullif(event_id // 35 % 3, 2) AS capture_complete FROM events)"""


@query(
    f"""WITH {_ROWS} SELECT event_id, CASE WHEN local_status IN ('QUEUED', 'DOWNLOADING', 'RECORDING', 'VALIDATING') OR live_status = 'is_upcoming' THEN NULL WHEN live_status = 'is_live' THEN CASE WHEN local_status != 'COMPLETED' THEN 'LIVE_RECORD' END
        WHEN live_status = 'was_live' AND capture_complete = 0 THEN 'REPLAY_RECOVERY' WHEN live_status = 'was_live' THEN CASE WHEN local_status != 'COMPLETED' THEN 'REPLAY_RECOVERY' END WHEN live_status = 'not_live' AND local_status != 'COMPLETED' THEN 'VOD_DOWNLOAD' END AS job_type FROM items"""
)
def desired_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("event_id", catalog.desired_job().alias("job_type"))


_MOVES = " OR ".join(f"(a = '{a}' AND b IN ({', '.join(repr(x) for x in to)}))" for a, to in catalog.TRANSITIONS.items())


@query(f"WITH {_ROWS}, s AS (SELECT event_id, lag(local_status) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a, local_status AS b FROM items) SELECT event_id, a AS previous_state, b AS local_status FROM s WHERE a IS NOT NULL AND NOT (a = b OR {_MOVES})")
def illegal_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.illegal_moves(_rows(spark, sf_dir), "user_id", ["ts", "event_id"], "local_status").select("event_id", "previous_state", "local_status")


@query("SELECT event_id AS id, user_id::VARCHAR AS video_id FROM events WHERE event_type = 'click' AND ts <= TIMESTAMP '2030-01-01' ORDER BY event_id LIMIT 4")
def claim_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = V.table(spark, sf_dir, "events")
    jobs = e.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("video_id"), F.when(F.col("event_type") == "click", "QUEUED").otherwise("DONE").alias("status"), F.col("ts").cast("timestamp").alias("available_at"), F.lit(0).alias("attempts"), F.col("ts").cast("timestamp").alias("updated_at"))
    return catalog.claim(jobs, F.lit("2030-01-01").cast("timestamp"), workers=4)[1].select("id", "video_id")


@query(
    f"""WITH {_ROWS}, j AS (SELECT event_id AS video_id, CASE event_id % 4 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'QUEUED' ELSE 'DONE' END AS status FROM events WHERE event_id % 3 = 0)
        SELECT i.event_id, CASE WHEN local_status = 'RECORDING' AND status IN ('RUNNING', 'QUEUED') THEN 'QUEUED' WHEN local_status = 'RECORDING' THEN 'RETRY' ELSE local_status END AS local_status FROM items i LEFT JOIN j ON i.event_id = j.video_id"""
)
def recover_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and, for a third of them, jobs."""
    now = F.lit("2030-01-01").cast("timestamp")
    items = _rows(spark, sf_dir).select(F.col("event_id").alias("video_id"), "local_status", now.alias("updated_at"))
    kind = F.when(F.col("event_id") % 4 == 0, "RUNNING").when(F.col("event_id") % 4 == 1, "QUEUED").otherwise("DONE")
    jobs = V.table(spark, sf_dir, "events").filter("event_id % 3 = 0").select(F.col("event_id").alias("id"), F.col("event_id").alias("video_id"), kind.alias("status"), now.alias("updated_at"))
    return catalog.recover(items, jobs, now)[0].select(F.col("video_id").alias("event_id"), "local_status")


@query(
    f"""WITH {V.LOG}, r AS (SELECT DISTINCT user_id AS id FROM events), i AS (SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'COMPLETED' WHEN doc_id % 3 = 1 THEN 'FAILED' ELSE 'DISCOVERED' END AS s, CASE WHEN doc_id % 5 = 0 THEN 'is_upcoming' ELSE 'not_live' END AS l FROM documents WHERE doc_id % 2 = 0)
        SELECT CAST(r.id AS VARCHAR) AS video_id, CASE WHEN s = 'COMPLETED' THEN 'skipped' WHEN i.id IS NULL THEN 'failed' WHEN l = 'is_upcoming' THEN 'waiting' WHEN s = 'FAILED' THEN 'retried' ELSE 'queued' END AS outcome FROM r LEFT JOIN i USING (id)"""
)
def request_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for every user; every other document is in the catalog."""
    requests = V.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("video_id"), F.lit(None).cast("string").alias("channel_hint"))
    d = V.table(spark, sf_dir, "documents").filter("doc_id % 2 = 0")
    n = F.col("doc_id") % 3
    items = d.select(F.col("doc_id").cast("string").alias("video_id"), F.lit("c").alias("channel_id"), F.when(n == 0, "COMPLETED").when(n == 1, "FAILED").otherwise("DISCOVERED").alias("local_status"), F.when(F.col("doc_id") % 5 == 0, "is_upcoming").otherwise("not_live").alias("live_status"), F.lit(1).alias("capture_complete"))
    return catalog.request_outcomes(requests, items, enabled_channels=2)


@query(
    """SELECT source AS source_id, count(*) AS candidates, count(*) FILTER (doc_id % 7 = 0) AS selected, round(100.0::DOUBLE * count(*) FILTER (doc_id % 7 = 0) / (SELECT count(*) FROM documents WHERE doc_id % 7 = 0), 2) AS percent FROM documents GROUP BY source"""
)
def selection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents")
    return summaries.selection_summary(d.select(F.col("source").alias("source_id"), F.when(F.col("doc_id") % 7 == 0, "REVIEW_POOL").otherwise("NOT_SELECTED").alias("selection_status")))


@query(f"WITH {_LINE_RULES} SELECT count(*) AS clips, count(*) FILTER (r = 0) AS status_pass, count(*) FILTER (r = 1) AS status_warning, count(*) FILTER (r = 2) AS status_fail FROM lines")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = _line_issues(spark, sf_dir)
    rolled = rules.roll_up(rows.select("id"), found, "id").withColumn("duration_sec", F.lit(1.0))
    return summaries.quality_summary(rolled, found).select("clips", "status_pass", "status_warning", "status_fail")


@query("SELECT conv_id, turn, CASE role WHEN 'user' THEN 'SW' WHEN 'assistant' THEN 'MO' ELSE 'Z' END || lpad(row_number() OVER (PARTITION BY conv_id, role ORDER BY turn)::VARCHAR, 2, '0') AS zone_id FROM conversations")
def zone_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = V.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("conv_id").alias("camera_id"), F.lit("v").alias("view_id"), F.col("role").alias("zone_type"), F.col("turn").alias("ordinal"))
    return annotations.numbered_zones(c, {"user": "SW", "assistant": "MO"}).select("conv_id", "turn", "zone_id")


@query()
def frame_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six small frames from each embedding, shifted by a row each, as one clip."""
    from ..functions.frames import analyse_clips

    byte = lambda x: F.lpad(F.hex(F.least(F.lit(255), F.greatest(F.lit(0), ((x + 1) * 127).cast("int")))), 2, "0")
    # A column of their own: within the lambda below they would be worked out for each frame.
    e = V.table(spark, sf_dir, "embeddings").filter(F.size("embedding") == 64).select("vec_id", F.transform("embedding", lambda x: F.repeat(byte(F.coalesce(x, F.lit(0.0))), 3)).alias("pixels"))
    shifted = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.concat(F.array_join(F.slice("pixels", i * 8 + 1, F.lit(64)), ""), F.array_join(F.slice("pixels", F.lit(1), i * 8), "")))
    clips_ = e.select(F.col("vec_id").cast("string").alias("clip_id"), F.unhex(F.array_join(shifted, "")).alias("frames"), F.lit(6).alias("n"), F.lit(8).alias("height"), F.lit(8).alias("width"))
    return analyse_clips(clips_).select("clip_id", "signal_status", "activity_score", "brightness_score", "visual_signature", F.array_join("keyframe_reasons", ";").alias("reasons"))


_clip = "least(1.0::DOUBLE, greatest(0.0::DOUBLE, {}))".format


@query(
    f"""WITH px AS (SELECT vec_id::VARCHAR AS clip_id, list_transform(embedding, lambda x: least(255, greatest(0, trunc((coalesce(x, 0)::DOUBLE + 1) * 127)))::INT) AS v FROM embeddings WHERE len(embedding) = 64),
        fr AS (SELECT clip_id, i, p, v[((p + 8 * (i * i % 8)) % 64 + 1)::INT] AS g FROM px, range(6) a(i), range(64) b(p)), d AS MATERIALIZED (SELECT a.clip_id, b.i, a.p, abs(a.g - b.g) AS d FROM fr a JOIN fr b ON a.clip_id = b.clip_id AND a.p = b.p AND b.i = a.i + 1),
        nb AS (SELECT p, q FROM range(64) a(p), range(64) b(q) WHERE abs(p // 8 - q // 8) <= 1 AND abs(p % 8 - q % 8) <= 1),
        m1 AS (SELECT clip_id, i, nb.p, bool_and(d >= 24) AS m FROM d JOIN nb ON d.p = nb.q GROUP BY ALL), m2 AS (SELECT clip_id, i, nb.p, bool_or(m) AS m FROM m1 JOIN nb ON m1.p = nb.q GROUP BY ALL),
        m3 AS (SELECT clip_id, i, nb.p, bool_or(m) AS m FROM m2 JOIN nb ON m2.p = nb.q GROUP BY ALL), m4 AS (SELECT clip_id, i, nb.p, bool_and(m) AS m FROM m3 JOIN nb ON m3.p = nb.q GROUP BY ALL),
        pairs AS (SELECT clip_id, i, avg(m::INT) AS share, avg(d) / 42.0::DOUBLE AS move FROM m4 JOIN d USING (clip_id, i, p) GROUP BY ALL),
        s AS (SELECT clip_id, avg(move) AS move, stddev_pop(move) AS sway, avg(share) AS share, avg((share >= 0.015::DOUBLE)::INT) AS busy, quantile_cont(move, 0.9::DOUBLE) AS fast FROM pairs GROUP BY clip_id),
        b AS (SELECT clip_id, avg(g) / 255.0::DOUBLE AS bright FROM fr GROUP BY clip_id)
        SELECT e.vec_id::VARCHAR AS clip_id, CASE WHEN s.clip_id IS NULL THEN 'FAILED' ELSE 'COMPUTED' END AS signal_status, round({_clip("move")}, 6) AS activity_score, round({_clip("2.5::DOUBLE * sway")}, 6) AS motion_variation_score, round(bright, 6) AS brightness_score,
            round({_clip("(0.38::DOUBLE - bright) / 0.30::DOUBLE")}, 6) AS low_light_score, round({_clip("2 * share")}, 6) AS foreground_occupancy_score, round(busy, 6) AS persistence_score, round({_clip("fast")}, 6) AS fast_motion_score
        FROM embeddings e LEFT JOIN s ON s.clip_id = e.vec_id::VARCHAR LEFT JOIN b ON b.clip_id = s.clip_id"""
)
def frames_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six small frames from each embedding, turned by 0, 1, 4, 1, 0 and 1 rows, each frame a row. Embeddings of another length make no frame."""
    from ..operators import frame_rows

    byte = lambda x: F.lpad(F.hex(F.least(F.lit(255), F.greatest(F.lit(0), ((F.coalesce(x, F.lit(0.0)).cast("double") + 1) * 127).cast("int")))), 2, "0")
    e = V.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("clip_id"), F.transform("embedding", lambda x: F.repeat(byte(x), 3)).alias("v"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("frame_no"))
    turn = F.col("frame_no") * F.col("frame_no") % 8 * 8
    pixels = F.unhex(F.concat(F.array_join(F.slice("v", turn + 1, F.lit(64)), ""), F.array_join(F.slice("v", F.lit(1), turn), "")))
    out = frame_rows.frame_signals(e.select("clip_id", "frame_no", F.lit(8).alias("height"), F.lit(8).alias("width"), pixels.alias("pixels")))
    scores = ("activity_score", "motion_variation_score", "brightness_score", "low_light_score", "foreground_occupancy_score", "persistence_score", "fast_motion_score")
    return out.select("clip_id", "signal_status", *[F.round(c, 6).alias(c) for c in scores])


from . import curation  # noqa: E402, F401  registers its queries
