"""Queries of the catalog, of sources and sinks, of reviews and of the checks across tables, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import frames
from ..functions import scalars as S
from ..operators import analysis, annotations, catalog, dedupe, intervals, ranking, registry, release, rules, segmentation, selection, split, summaries
from ..settings import Acquisition, Channel, fingerprint
from ..sources import cutting, sinks, tables
from ..storage import shared_dir, stash
from ..streaming import watcher
from ..streaming.store import Snapshots
from . import views as V
from .register import query


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/reelmill-{name}-{uuid.uuid4().hex}"


# ---- sources and sinks ------------------------------------------------------------------------------------------


@query("SELECT n_nationkey, n_name, n_regionkey, '' AS remark FROM nation")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text table written with a fixed header and read back; a column that isn't there is empty."""
    path = _scratch(spark, "csv")
    sinks.write_csv(V.table(spark, sf_dir, "nation"), path, ["n_nationkey", "n_name", "n_regionkey", "remark"])
    return tables.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int, remark string").withColumn("remark", F.coalesce("remark", F.lit("")))


@query("SELECT trim(n_name) AS reference FROM nation WHERE n_nationkey % 3 != 0")
def list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a list, among them blank ones and comments, which aren't read."""
    n = V.table(spark, sf_dir, "nation")
    lines = n.select(F.when(F.col("n_nationkey") % 3 != 0, F.concat(F.lit("  "), "n_name")).when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit(" # "), "n_name")).otherwise("").alias("value"))
    path = _scratch(spark, "list")
    sinks.write_table(lines, path, "text")
    return tables.read_list(spark, path)


def _probe() -> F.Column:
    i = F.col("doc_id")
    video = F.format_string('{"codec_type":"video","codec_name":"h%d","width":%d,"height":%d,"avg_frame_rate":"%d/1001","r_frame_rate":"25/1","nb_frames":"%d"}', i % 7, i % 640, i % 480, (i % 5) * 6000, F.col("n_chars"))
    streams = F.when(i % 11 == 0, "").when(i % 3 == 0, F.concat(F.lit('{"codec_type":"audio"},'), video)).otherwise(video)
    return F.when(i % 13 == 0, "no json").otherwise(F.format_string('{"format":{"duration":"%s"},"streams":[%s]}', F.when(i % 17 == 0, "N/A").otherwise(F.col("n_chars").cast("string")), streams))


_PROBE = """p AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'unreadable' WHEN doc_id % 11 = 0 THEN 'no_video_stream' END AS reason,
    CASE WHEN doc_id % 13 = 0 OR doc_id % 17 = 0 THEN NULL ELSE n_chars::DOUBLE END AS duration_sec, (CASE WHEN doc_id % 13 = 0 OR doc_id % 11 = 0 THEN 0 ELSE doc_id % 640 END)::INT AS width,
    CASE WHEN doc_id % 13 = 0 OR doc_id % 11 = 0 THEN 0.0::DOUBLE WHEN doc_id % 5 = 0 THEN 25.0::DOUBLE ELSE (doc_id % 5) * 6000 / 1001::DOUBLE END AS fps,
    CASE WHEN doc_id % 13 = 0 OR doc_id % 11 = 0 THEN NULL ELSE 'h' || doc_id % 7 END AS codec FROM documents)"""


@query(f"WITH {_PROBE} SELECT * FROM p")
def probe_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe documents, some of which are broken, without video or without a duration."""
    p = V.table(spark, sf_dir, "documents").select("doc_id", tables.probed(_probe()).alias("p"))
    return p.select("doc_id", "p.reason", "p.duration_sec", F.coalesce("p.width", F.lit(0)).alias("width"), F.coalesce("p.fps", F.lit(0.0)).alias("fps"), "p.codec")


@query(
    f"""WITH {_PROBE} SELECT doc_id, CASE WHEN reason IS NULL THEN 'probe' WHEN doc_id % 2 = 0 THEN 'fallback' ELSE 'unavailable' END AS metadata_source, coalesce(reason, '') AS reason,
        CASE WHEN reason IS NULL THEN duration_sec WHEN doc_id % 2 = 0 THEN 7.0::DOUBLE END AS duration_sec FROM p"""
)
def probe_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second probe steps in where the first one fails."""
    second = F.when(F.col("doc_id") % 2 == 0, '{"format":{"duration":"7"},"streams":[{"codec_type":"video"}]}').otherwise("")
    d = V.table(spark, sf_dir, "documents").select("doc_id", _probe().alias("first"), second.alias("second"))
    return d.select("doc_id", tables.probe_with_fallback("first", "second").alias("p")).select("doc_id", "p.metadata_source", "p.reason", "p.duration_sec")


_OVERLAY = "o AS (SELECT d.doc_id, coalesce(CASE WHEN d.doc_id % 3 = 0 THEN d.lang END, CASE WHEN l.doc_id IS NOT NULL THEN 's' || l.quality END) AS title, CASE WHEN d.doc_id % 3 = 0 THEN d.source END AS channel FROM documents d LEFT JOIN labels l USING (doc_id))"


def _overlaid(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents")
    path = lambda c: F.concat(F.lit("raw/"), F.col(c).cast("string"), F.lit(".mp4"))
    files = d.select("doc_id", path("doc_id").alias("path"))
    side = V.table(spark, sf_dir, "labels").select(path("doc_id").alias("path"), F.concat(F.lit("s"), "quality").alias("title"), F.lit(None).cast("string").alias("channel"))
    cat = d.select(F.when(F.col("doc_id") % 3 == 0, path("doc_id")).alias("local_path"), F.col("lang").alias("title"), F.col("source").alias("channel"))
    return tables.sidecar_overlay(files, side, cat, ["title", "channel"])


@query(f"WITH {_OVERLAY} SELECT * FROM o")
def sidecar_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with what the catalog says of them, or else the document beside them."""
    return _overlaid(spark, sf_dir).select("doc_id", "title", "channel")


@query(
    f"""WITH {_PROBE}, f AS (SELECT d.doc_id, 'raw/' || d.source || '/' || d.doc_id || '.mp4' AS path, CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE 'youtube' END AS src, CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE 'v' || d.doc_id END AS sid FROM documents d)
        SELECT path, 'V' || substr(sha256(coalesce(src, 'local') || ':' || coalesce(sid, doc_id::VARCHAR) || ':' || path), 1, 16) AS video_id, doc_id || '.mp4' AS filename, duration_sec, reason FROM f JOIN p USING (doc_id)"""
)
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with stable ids, probes and metadata."""
    d = V.table(spark, sf_dir, "documents")
    path = F.concat(F.lit("raw/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".mp4"))
    files = d.select(path.alias("path"), F.octet_length("text").alias("file_size_bytes"), F.sha2("text", 256).alias("sha256"))
    known = F.col("doc_id") % 4 != 0
    metadata = d.select(path.alias("path"), F.when(known, "youtube").alias("source"), F.when(known, F.concat(F.lit("v"), F.col("doc_id").cast("string"))).alias("source_video_id"))
    return tables.build_inventory(files, d.select(path.alias("path"), _probe().alias("probe")), metadata).select("path", "video_id", "filename", "duration_sec", "reason")


@query(
    """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'missing_file' WHEN doc_id % 5 = 0 THEN 'empty_file' WHEN doc_id % 3 = 0 THEN 'no_video_stream' WHEN doc_id % 4 = 0 THEN 'invalid_duration' ELSE '' END AS reason,
        doc_id % 7 != 0 AND doc_id % 5 != 0 AND doc_id % 3 != 0 AND doc_id % 4 != 0 AS ok FROM documents"""
)
def download_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with downloaded files; an unknown duration is fine."""
    i = F.col("doc_id")
    d = V.table(spark, sf_dir, "documents").select("doc_id", (i % 7 != 0).alias("exists"), F.when(i % 5 != 0, F.lit(1)).otherwise(0).alias("file_size_bytes"), F.when(i % 3 == 0, "x").alias("probe_reason"), F.when(i % 4 == 0, 0.0).when(i % 2 == 0, 9.0).alias("duration_sec"))
    return d.select("doc_id", tables.download_verdict().alias("v")).select("doc_id", "v.reason", "v.ok")


@query(
    """SELECT doc_id, n_chars / 2::DOUBLE AS middle, greatest(0.0::DOUBLE, n_chars - 1.0::DOUBLE) AS last, (CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END)::INT AS errors FROM documents"""
)
def decode_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where frames are looked at, and how many of them or of whole files don't decode."""
    i = F.col("doc_id")
    d = V.table(spark, sf_dir, "documents").select("doc_id", tables.decode_points("n_chars").alias("at"), tables.decode_verdict(F.array(i % 2 != 0, F.lit(True), F.when(i % 3 != 0, F.lit(True))), i % 5 != 0).alias("v"))
    return d.select("doc_id", F.get("at", F.lit(1)).alias("middle"), F.get("at", F.lit(2)).alias("last"), "v.errors")


@query("SELECT doc_id, k::INT AS k, round(n_chars * (k + 0.5::DOUBLE) / 12, 6) AS at FROM documents, unnest(range(12)) t(k)")
def frame_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve times for each clip."""
    d = V.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(frames.sample_timestamps(F.col("n_chars").cast("double"), 12)).alias("k", "at"))
    return d.withColumn("at", F.round("at", 6))


@query(
    f"""WITH {V.ITEMS} SELECT video_id, local_status, live_status FROM items WHERE local_status = 'FAILED' AND live_status = 'not_live'"""
)
def list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of one state and one live status: the filter is the operator."""
    return catalog.list_items(V.items(spark, sf_dir), "FAILED", "not_live").select("video_id", "local_status", "live_status")


@query("SELECT user_id::VARCHAR AS video_id, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id HAVING count(*) > 1")
def broken_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with several active jobs, if every click and view were one."""
    e = V.table(spark, sf_dir, "events")
    jobs = e.select(F.col("user_id").cast("string").alias("video_id"), F.when(F.col("event_type") == "click", "QUEUED").when(F.col("event_type") == "view", "RUNNING").otherwise("DONE").alias("status"))
    return catalog.broken_uniqueness(jobs)


@query(f"WITH {V.ITEMS} SELECT video_id, title, duration_sec, coalesce(capture_complete, 0) != 0 AS capture_complete FROM items")
def sidecar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents beside files, written as a table and read again."""
    path = _scratch(spark, "sidecars")
    sinks.write_sidecars(V.items(spark, sf_dir), V.now(), path)
    doc = lambda f: F.get_json_object("document", f"$.{f}")
    return spark.read.schema("video_id string, document string").json(path).select("video_id", doc("title").alias("title"), doc("duration_sec").cast("double").alias("duration_sec"), (doc("capture_complete") == "true").alias("capture_complete"))


@query(
    """SELECT event_id, TRY_CAST(CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS DOUBLE) AS start_time_sec, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END::INT AS keyframes FROM events"""
)
def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON lines, with times as numbers and keyframes parsed, and read again."""
    i, e = F.col("event_id"), V.table(spark, sf_dir, "events")
    rows = e.select("event_id", F.when(i % 5 == 0, "soon").otherwise(F.col("value").cast("string")).alias("start_time_sec"), F.lit("1").alias("violation_time_sec"), F.lit("").alias("end_time_sec"), F.when(i % 3 == 0, '[{"time_sec":1,"bbox":[0,0,1,1]}]').otherwise("").alias("bbox_keyframes"))
    path = _scratch(spark, "events")
    sinks.write_events(rows, path)
    back = spark.read.schema("event_id bigint, start_time_sec double, violation_time_sec double, bbox_keyframes array<struct<time_sec:double,bbox:array<double>>>").json(path)
    return back.select("event_id", "start_time_sec", F.size("bbox_keyframes").alias("keyframes"))


@query("SELECT doc_id, CASE WHEN n_chars = 0 OR doc_id % 100 < 25 THEN 0 WHEN doc_id % 100 <= 50 THEN 1 WHEN doc_id % 100 <= 75 THEN 2 ELSE 3 END::INT AS sample FROM documents")
def nearest_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled frame nearest to a wanted time."""
    d, n = V.table(spark, sf_dir, "documents"), F.col("n_chars").cast("double")
    wanted = F.array((F.col("doc_id") % 100 + 0.3) / 101.0 * n)
    return d.select("doc_id", F.get(annotations.nearest_samples(wanted, frames.sample_timestamps(n, 4)), F.lit(0)).cast("int").alias("sample"))


@query("SELECT doc_id::VARCHAR AS clip_id FROM labels WHERE quality = 0 GROUP BY doc_id")
def stale_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews of labelled clips that aren't good."""
    lab = V.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("clip_id"), "quality")
    files = V.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("clip_id"))
    return annotations.stale_previews(files, lab, lab.filter("quality = 1"))


# ---- projections and predicates ---------------------------------------------------------------------------------

_RAW = """raw AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'bad' ELSE lpad(doc_id::VARCHAR, 11, 'a') END AS id, source AS channel_id, 'Café ' || lang AS title,
    list_extract(['is_upcoming', 'is_live', 'was_live', 'not_live', 'unknown', 'strange'], (doc_id % 6 + 1)::INT) AS live_status, doc_id * 1000 AS release_timestamp, n_chars::DOUBLE AS duration FROM documents),
    found AS (SELECT doc_id, id AS video_id, channel_id, title, CASE WHEN live_status = 'strange' THEN 'unknown' ELSE live_status END AS live_status, release_timestamp, duration FROM raw WHERE id != 'bad')"""


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    null = F.lit(None).cast("bigint")
    return V.table(spark, sf_dir, "documents").select(
        F.when(i % 7 == 0, "bad").otherwise(F.lpad(i.cast("string"), 11, "a")).alias("id"), F.col("source").alias("channel_id"), F.lit(None).cast("string").alias("channel_name"), F.concat(F.lit("Café "), "lang").alias("title"),
        V.pick(("is_upcoming", "is_live", "was_live", "not_live", "unknown", "strange"), i).alias("live_status"), (i * 1000).cast("bigint").alias("release_timestamp"), null.alias("timestamp"), F.col("n_chars").cast("double").alias("duration"), i.cast("bigint").alias("ordinal"),
    )


@query(
    f"""WITH {_RAW} SELECT video_id, live_status, CASE live_status WHEN 'not_live' THEN 'vod' WHEN 'unknown' THEN 'unknown' ELSE 'live' END AS item_type, duration AS duration_sec,
        CASE WHEN live_status = 'is_upcoming' THEN strftime(make_timestamp(release_timestamp * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') END AS scheduled_start,
        CASE WHEN live_status IN ('is_live', 'was_live') THEN strftime(make_timestamp(release_timestamp * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') END AS actual_start FROM found"""
)
def normalized_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw metadata as discoveries."""
    return tables.normalized_items(_raw(spark, sf_dir)).select("video_id", "live_status", "item_type", "duration_sec", "scheduled_start", "actual_start")


_POLICY = """((video_id IN ('aaaaaaaaaa1', 'aaaaaaaaaa2')) OR title = 'Café de' OR (live_status IN ('is_upcoming', 'is_live', 'was_live') AND title = 'Café en') OR (live_status = 'not_live' AND title = 'Café fr'))"""


@query(f"WITH {_RAW} SELECT video_id FROM found WHERE {_POLICY}")
def title_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that a channel's ids and keywords take."""
    rows = tables.normalized_items(_raw(spark, sf_dir))
    return rows.filter(S.title_policy("video_id", "title", "live_status", ("aaaaaaaaaa1", "aaaaaaaaaa2"), ("CAFE DE",), ("café en",), ("Cafe Fr",))).select("video_id")


def _acquisition(**more) -> Acquisition:
    one = lambda s, **k: Channel(s, f"https://www.youtube.com/@{s}", **k)
    return Acquisition((one("src0", live_keywords=("cafe en",)), one("src1", video_ids=("aaaaaaaaaa1",), title_keywords=("cafe de",)), one("src2", enabled=False, title_keywords=("cafe",))), **more)


@query(f"WITH {_RAW} SELECT id FROM raw WHERE (channel_id = 'src0' AND title = 'Café en') OR (channel_id = 'src1' AND (title = 'Café de' OR id = 'aaaaaaaaaa1')) OR channel_id = 'src2'")
def flat_sieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat entries that may be taken, before their details are known."""
    return watcher.may_match(_raw(spark, sf_dir), _acquisition()).select("id")


_NAMED = "SELECT video_id, channel_id FROM found WHERE video_id = 'aaaaaaaaaa1'"
_TAKEN = "((channel_id = 'src0' AND live_status IN ('is_upcoming', 'is_live', 'was_live') AND title = 'Café en') OR (channel_id = 'src1' AND (title = 'Café de' OR video_id = 'aaaaaaaaaa1')))"


@query(
    f"""WITH {_RAW}, taken AS (SELECT * FROM found WHERE {_TAKEN}) SELECT video_id, CASE WHEN live_status = 'is_upcoming' THEN 'WAITING' WHEN live_status = 'unknown' THEN 'DISCOVERED' ELSE 'QUEUED' END AS local_status,
        CASE live_status WHEN 'is_live' THEN 'LIVE_RECORD' WHEN 'was_live' THEN 'REPLAY_RECOVERY' WHEN 'not_live' THEN 'VOD_DOWNLOAD' END AS job_type FROM taken"""
)
def scan_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch of the watcher over an empty catalog: what is stored, and the job it gets."""
    items, jobs = spark.createDataFrame([], catalog.ITEMS), spark.createDataFrame([], catalog.JOBS)
    items, jobs, _ = watcher.tick(items, jobs, _raw(spark, sf_dir), _acquisition(), V.now())
    return items.join(jobs.select("video_id", "job_type"), "video_id", "left").select("video_id", "local_status", "job_type")


@query(f"WITH {_RAW} SELECT id, count(*) AS times FROM raw WHERE id = 'bad' GROUP BY id")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a batch that are no items."""
    items, jobs = spark.createDataFrame([], catalog.ITEMS), spark.createDataFrame([], catalog.JOBS)
    bad = watcher.tick(items, jobs, _raw(spark, sf_dir), _acquisition(), V.now())[2]
    return bad.groupBy("id").agg(F.count(F.lit(1)).alias("times"))


_FIRST = """o AS (SELECT source AS channel_id, doc_id::VARCHAR AS video_id, lang, CASE WHEN doc_id % 10 = 0 THEN 0 ELSE 1 END AS part, doc_id AS ordinal FROM documents),
    one AS (SELECT *, row_number() OVER (PARTITION BY channel_id, lang ORDER BY part, ordinal) AS k FROM o)"""


@query(f"WITH {_FIRST} SELECT channel_id || lang AS video_id, ordinal FROM one WHERE k = 1")
def explicit_then_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of rows with one id those named come before those found, then the first."""
    d = V.table(spark, sf_dir, "documents").select(F.concat("source", "lang").alias("video_id"), F.col("doc_id").cast("bigint").alias("ordinal"))
    return catalog.explicit_then_found(d.filter("ordinal % 10 = 0"), d.filter("ordinal % 10 != 0")).select("video_id", "ordinal")


@query(
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY source) AS n FROM documents WHERE source IN ('src0', 'src1', 'src2')),
        c0 AS (SELECT least(max(n), 25) AS t FROM n WHERE source = 'src0'), c1 AS (SELECT least(max(n), greatest(1, 25 - t)) AS t1, t FROM n, c0 WHERE source = 'src1' GROUP BY t)
        SELECT doc_id::VARCHAR AS video_id FROM n, c1 WHERE (source = 'src0' AND k <= t) OR (source = 'src1' AND k <= t1) OR (source = 'src2' AND k <= greatest(1, 25 - t - t1))"""
)
def scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan that stops after 25 items: the limit is the operator. Later channels still take one."""
    d = V.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("video_id"), F.col("source").alias("channel_id"), F.col("doc_id").alias("place"))
    return catalog.scan_limit(d, ["src0", "src1", "src2"], 25).select("video_id")


@query("SELECT page_id, CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 4 = 0 THEN 1.5::DOUBLE ELSE page_id::DOUBLE END AS x, page_id % 3 = 0 AND page_id % 5 != 0 AND page_id % 4 != 0 AS same FROM pages")
def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in text, some of which are none, and their tolerant comparison."""
    i = F.col("page_id")
    text = F.when(i % 5 == 0, F.when(i % 2 == 0, "NaN").otherwise("1e999")).when(i % 4 == 0, " 1.5 ").otherwise(i.cast("string"))
    return V.table(spark, sf_dir, "pages").select("page_id", S.number(text).alias("x"), S.same_number(text, F.when(i % 4 == 0, i.cast("double") + 9).otherwise(F.when(i % 3 == 0, i + 0.0005).otherwise(i + 0.5)), 0.001).alias("same"))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'missing_file' WHEN doc_id % 11 = 0 THEN 'unreadable' WHEN n_chars <= 300 THEN 'invalid_duration' WHEN doc_id % 6 < 5 AND doc_id % 6 >= 4 THEN 'invalid_fps' WHEN doc_id % 5 = 0 THEN 'checksum_mismatch' WHEN doc_id % 640 < 320 THEN 'low_resolution' ELSE '' END AS reason,
        CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 OR n_chars <= 300 OR doc_id % 6 = 4 OR doc_id % 5 = 0 THEN 'invalid' WHEN doc_id % 640 < 320 THEN 'warning' ELSE 'valid' END AS status FROM documents"""
)
def file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first thing wrong with each file."""
    i = F.col("doc_id")
    d = V.table(spark, sf_dir, "documents").select("doc_id", (i % 7 != 0).alias("exists"), F.when(i % 11 == 0, "x").otherwise("").alias("probe_error"), F.col("n_chars").cast("double").alias("duration_sec"), F.when(i % 6 == 4, 4.0).otherwise(25.0).alias("fps"), F.when(i % 5 == 0, "other").otherwise("").alias("expected_sha256"), F.lit("x").alias("sha256"), (i % 640).alias("width"), F.lit(480).alias("height"))
    return d.select("doc_id", rules.file_verdict(min_duration=300).alias("v")).select("doc_id", "v.reason", "v.status")


@query(f"WITH {V.CLIPS} SELECT clip_id, coalesce(start_sec - 1.7e9 >= -0.000001 AND start_sec < end_sec AND end_sec - 1.7e9 <= 5e7 + 0.000001 AND end_sec - start_sec >= 600 - 0.000001 AND end_sec - start_sec <= 2400 + 0.000001, false) AS valid FROM clips")
def valid_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips that lie inside their source and are neither too short nor too long."""
    s, e = F.col("start_sec") - 1.7e9, F.col("end_sec") - 1.7e9
    return V.clips(spark, sf_dir).select("clip_id", F.coalesce(intervals.valid_interval(s, e, F.lit(5e7), 600, 2400), F.lit(False)).alias("valid"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lang ELSE 'none' END AS origin FROM documents")
def origin_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item that a file came from, by its path."""
    path = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("data/youtube/"), "source", F.lit("/"), "lang", F.lit("/source.mp4"))).when(F.col("doc_id") % 4 == 1, "data/youtube").otherwise("raw/x.mp4")
    return V.table(spark, sf_dir, "documents").select("doc_id", S.origin_of_path(path, F.lit("none")).alias("origin"))


_REVIEW = "r AS (SELECT doc_id, doc_id::VARCHAR AS video_id, CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR ELSE 'odd' || doc_id END AS source_video_id, n_chars::DOUBLE AS duration_sec, doc_id % 3 = 0 AS bad, doc_id % 5 = 0 AS rejected, doc_id % 7 != 0 AS valid FROM documents)"


def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    d, i = V.table(spark, sf_dir, "documents"), F.col("doc_id")
    video = i.cast("string").alias("video_id")
    review = d.select(video, F.when(i % 3 == 0, "too_short").otherwise("").alias("review_reason"), F.when(i % 5 == 0, "reject").otherwise("").alias("review_status"))
    items = d.select(video, F.when(i % 2 == 0, i.cast("string")).otherwise(F.concat(F.lit("odd"), i.cast("string"))).alias("source_video_id"), F.col("n_chars").cast("double").alias("duration_sec"), F.lit("p").alias("local_path"))
    return review, items, d.select(video, F.when(i % 7 != 0, "valid").otherwise("invalid").alias("status"))


@query(f"WITH {_REVIEW} SELECT source_video_id, video_id FROM r WHERE NOT bad AND NOT rejected AND valid")
def eligible_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one eligible item of each source."""
    return segmentation.eligible_sources(*_reviewed(spark, sf_dir), strict=True).select("source_video_id", "video_id")


_CUT = """cut0 AS (SELECT *, CASE WHEN d <= 180 THEN 0 ELSE greatest(0, least(ceil((d - 120) / 110), greatest(ceil((d - 180) / 110), floor((d - 120 + 10 - 30) / 110) + 1))) END::BIGINT AS last
    FROM (SELECT *, floor(duration_sec * 1000) / 1000 AS d FROM r WHERE NOT bad AND NOT rejected AND valid) WHERE d >= 30),
    cut AS (SELECT source_video_id, round(k * 110.0::DOUBLE, 3) AS start_sec, round(CASE WHEN k = last THEN d ELSE k * 110.0::DOUBLE + 120 END, 3) AS end_sec FROM (SELECT *, unnest(range(last + 1)) AS k FROM cut0)),
    made AS (SELECT *, 'A' || substr(sha256(source_video_id || ':' || printf('%.3f', start_sec) || ':' || printf('%.3f', end_sec)), 1, 16) AS id FROM cut)"""


@query(
    f"""WITH {_REVIEW}, {_CUT} SELECT id AS clip_candidate_id, source_video_id, start_sec, end_sec, CASE WHEN start_sec = 0 AND end_sec > 100 THEN 'keep' ELSE 'pending' END AS status, CASE WHEN start_sec = 0 AND end_sec > 100 THEN 'seen' ELSE '' END AS note FROM made
        UNION ALL SELECT 'old' || video_id, source_video_id, 1.0::DOUBLE, 5.0::DOUBLE, 'keep', 'old' FROM r WHERE NOT bad AND NOT rejected AND valid AND doc_id % 11 = 0"""
)
def generated_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of eligible sources, with what people had decided about those that were there, and kept ones that are no longer made."""
    review, items, validation = _reviewed(spark, sf_dir)
    first = intervals.segment(items, id_col="source_video_id").filter("start_sec = 0 and end_sec > 100")
    old = first.select("clip_candidate_id", "source_video_id", "start_sec", "end_sec", F.col("length_sec").alias("duration_sec"), F.lit("").alias("scenario_hint"), F.lit("keep").alias("status"), F.lit("seen").alias("note"), F.lit(1).alias("ordinal"))
    gone = items.select(F.concat(F.lit("old"), "video_id").alias("clip_candidate_id"), "source_video_id", F.lit(1.0).alias("start_sec"), F.lit(5.0).alias("end_sec"), F.lit(4.0).alias("duration_sec"), F.lit("").alias("scenario_hint"), F.when(F.col("video_id").cast("int") % 11 == 0, "keep").otherwise("pending").alias("status"), F.lit("old").alias("note"), F.lit(2).alias("ordinal"))
    # Kept candidates of sources that aren't eligible are in the table too, and go.
    return segmentation.generate(review, items, validation, old.unionByName(gone)).select("clip_candidate_id", "source_video_id", "start_sec", "end_sec", "status", "note")


@query(f"WITH {_REVIEW}, {_CUT} SELECT id AS clip_candidate_id, row_number() OVER (ORDER BY source_video_id, start_sec, end_sec) AS place FROM made")
def ordered_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates in the order of the timelines, times compared as numbers though they are text."""
    cut = intervals.segment(segmentation.eligible_sources(*_reviewed(spark, sf_dir)), id_col="source_video_id")
    rows = cut.select("clip_candidate_id", "source_video_id", F.col("start_sec").cast("string").alias("start_sec"), F.col("end_sec").cast("string").alias("end_sec"))
    return ranking.ranked(segmentation.ordered(rows), ["source_video_id", S.number("start_sec"), S.number("end_sec")], "place").select("clip_candidate_id", "place")


@query(f"WITH {_REVIEW}, {_CUT} SELECT source_video_id, start_sec FROM made WHERE NOT start_sec = 0")
def pending_trims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs without a verified output: the first clip of each source is there, the second is too short."""
    sources = segmentation.eligible_sources(*_reviewed(spark, sf_dir))
    cut = intervals.segment(sources, id_col="source_video_id").withColumn("status", F.lit("keep"))
    jobs = segmentation.jobs(cut.drop("duration_sec", "local_path"), sources, 30, 180)
    there = jobs.select("clip_id", F.when(F.col("start_sec") == 0, F.col("end_sec") + 0.9).otherwise(F.lit(1.0)).alias("duration_sec"), F.lit(True).alias("readable"))
    return segmentation.pending(jobs, there).select("source_video_id", "start_sec")


@query(
    """SELECT doc_id, CASE WHEN length(coalesce(text, '')) > 400 THEN 'failed' ELSE 'cut' END AS first_outcome, CASE WHEN length(coalesce(text, '')) > 400 THEN 'cut' END AS second_outcome,
        octet_length(encode(coalesce(text, ''))) AS file_size_bytes, sha256(coalesce(text, '')) AS sha256 FROM documents WHERE doc_id IS NOT NULL"""
)
def resumed_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text is cut to a file by a provider that has no room for long ones at first; the second run cuts those alone, and the log of both is folded."""
    root = f"{shared_dir(spark)}/reelmill-cuts-{uuid.uuid4().hex}"
    texts = V.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("clip_id"), F.coalesce("text", F.lit("")).alias("text"))

    def cutter(most: int | None):
        def cut(job, out, cancelled):
            if most is not None and len(job["text"]) > most:
                raise OSError("no room")
            out.write(job["text"].encode())

        return cut

    runs = []
    for most in (400, None):
        done = cutting.cut_clips(texts, f"{root}/clips", f"{root}/log", cutter(most), ".txt").select("clip_id", "outcome")
        runs.append(stash(done, "outcomes"))
        cutting.fold(spark, f"{root}/log")
    first, second = runs[0].withColumnRenamed("outcome", "first_outcome"), runs[1].withColumnRenamed("outcome", "second_outcome")
    out = first.join(second, "clip_id", "left").join(cutting.finished(spark, f"{root}/log"), "clip_id")
    return out.select(F.col("clip_id").cast("long").alias("doc_id"), "first_outcome", "second_outcome", "file_size_bytes", "sha256")


@query(f"WITH {_REVIEW}, {_CUT}, n AS (SELECT *, row_number() OVER (PARTITION BY source_video_id ORDER BY start_sec, end_sec, id) AS k FROM made) SELECT source_video_id, k::INT AS clip_number, round(end_sec - start_sec, 3) AS duration_sec, CASE WHEN k = 1 THEN 'cam' ELSE '' END AS camera_id, false AS incomplete FROM n WHERE k != 2 UNION ALL SELECT source_video_id, 2, NULL, NULL, true FROM n WHERE k = 2")
def reconciled_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest rebuilt from files: the second clip of each source is too short, the first had a camera."""
    sources = segmentation.eligible_sources(*_reviewed(spark, sf_dir))
    jobs = segmentation.jobs(intervals.segment(sources, id_col="source_video_id").withColumn("status", F.lit("keep")).drop("duration_sec", "local_path"), sources, 30, 180)
    length = F.col("end_sec") - F.col("start_sec")
    files = jobs.select("clip_id", F.when(F.col("clip_number") == 2, 1.0).otherwise(length).alias("duration_sec"), F.lit("s").alias("sha256"), F.lit(True).alias("readable"), F.lit("p").alias("path"))
    prior = jobs.filter("clip_number = 1").select("clip_id", "start_sec", "end_sec", F.lit("s").alias("sha256"), F.lit("cam").alias("camera_id"), F.lit("").alias("view_id"), F.lit("").alias("session_id"))
    done, incomplete = release.reconcile(jobs, files, prior)
    named = jobs.select("clip_id", "source_video_id", "clip_number")
    a = done.join(named.drop("source_video_id"), "clip_id").select("source_video_id", "clip_number", "duration_sec", "camera_id", F.lit(False).alias("incomplete"))
    return a.unionByName(incomplete.join(named, "clip_id").select("source_video_id", "clip_number", F.lit(None).cast("double").alias("duration_sec"), F.lit(None).cast("string").alias("camera_id"), F.lit(True).alias("incomplete")))


@query("SELECT doc_id::VARCHAR AS clip_id, lang AS camera_id, NULL::DOUBLE AS candidate_score, NULL::VARCHAR AS codec, 'NOT_COMPUTED' AS signal_status FROM documents")
def candidate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata as candidates without any signal."""
    d = V.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("clip_id"), F.col("lang").alias("camera_id"), F.col("source").alias("source_id"))
    return analysis.candidate_table(d).select("clip_id", "camera_id", "candidate_score", "codec", "signal_status")


@query("SELECT doc_id::VARCHAR AS clip_id, n_chars::DOUBLE AS candidate_score, row_number() OVER (ORDER BY n_chars DESC, doc_id::VARCHAR) AS place FROM documents WHERE doc_id % 4 != 0")
def final_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed rows that were kept, by score: what is kept is the operator."""
    i = F.col("doc_id")
    pool = V.table(spark, sf_dir, "documents").select(i.cast("string").alias("clip_id"), F.col("n_chars").cast("double").alias("candidate_score"), F.lit(" reviewed ").alias("manual_review_status"), F.when(i % 4 != 0, "keep").otherwise("Reject").alias("manual_review_label"))
    kept = selection.finalize(pool, 0, 1 << 40)
    return ranking.ranked(kept, [F.desc("candidate_score"), "clip_id"], "place").select("clip_id", "candidate_score", "place")


@query("SELECT doc_id, '' AS lang, source FROM documents")
def reset_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.reset_selection(V.table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), ["lang"])


@query("SELECT doc_id, 'videos/' || CASE WHEN doc_id % 3 = 0 THEN 'dev' ELSE 'test' END || '/' || doc_id || '.mp4' AS frozen_path FROM documents")
def frozen_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = V.videos(spark, sf_dir).withColumnRenamed("video_id", "clip_id")
    return release.frozen_paths(clips, clips.select("clip_id", F.when(F.col("doc_id") % 3 == 0, "dev").otherwise("test").alias("split"))).select("doc_id", "frozen_path")


@query("SELECT c_nationkey::VARCHAR AS source_id, count(*) AS num_clips FROM customer WHERE c_nationkey % 3 != 0 GROUP BY c_nationkey")
def camera_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources without a camera."""
    c = V.table(spark, sf_dir, "customer")
    reg = c.groupBy(F.col("c_nationkey").cast("string").alias("source_id")).agg(F.count(F.lit(1)).alias("num_clips")).withColumn("camera_id", F.when(F.col("source_id").cast("int") % 3 == 0, "cam").otherwise("unknown"))
    return registry.camera_report(reg.withColumn("camera_status", F.when(S.unresolved("camera_id"), "UNRESOLVED").otherwise("RESOLVED"))).select("source_id", "num_clips")


@query(
    """WITH p AS (SELECT page_id, string_split(substr(url, 9), '/') AS s FROM pages), q AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN list_concat(s, ['..', '..', '..', '..', 'x']) WHEN page_id % 3 = 1 THEN list_concat(['.'], s) ELSE s END AS s FROM p),
        d AS (SELECT page_id, list_transform(s, lambda x: CASE WHEN x IN ('', '.') THEN 0 WHEN x = '..' THEN -1 ELSE 1 END) AS steps FROM q)
        SELECT page_id, list_min(list_transform(range(1, len(steps) + 1), lambda k: list_sum(steps[1:k]))) < 0 AS escapes FROM d"""
)
def confined_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative paths that leave their root."""
    p, u = V.table(spark, sf_dir, "pages"), F.expr("substring(url, 9)")
    path = F.when(F.col("page_id") % 3 == 0, F.concat(u, F.lit("/../../../../x"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("./"), u)).otherwise(u)
    return p.select("page_id", rules.escapes(path).alias("escapes"))


# ---- joins ------------------------------------------------------------------------------------------------------


@query(
    """SELECT doc_id::VARCHAR AS clip_id, CASE WHEN doc_id % 13 = 0 THEN 'INVALID_CLIP_PATH' WHEN doc_id % 7 = 0 THEN 'MISSING_FILE' ELSE 'CHECKSUM_MISMATCH' END AS code, CASE WHEN doc_id % 13 = 0 THEN '../' || doc_id || '.mp4' WHEN doc_id % 7 = 0 THEN 'clips/' || doc_id || '.mp4' ELSE '' END AS details FROM documents WHERE doc_id % 13 = 0 OR doc_id % 7 = 0 OR doc_id % 5 = 0
        UNION ALL SELECT doc_id::VARCHAR, 'MISSING_FILE', '../' || doc_id || '.mp4' FROM documents WHERE doc_id % 13 = 0 UNION ALL SELECT NULL, 'ORPHAN_CLIP_FILE', 'clips/extra' || page_id || '.MP4' FROM pages WHERE page_id % 2 = 0"""
)
def file_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows against the files that are there, and files that no row names; the text files among them are none of ours."""
    d, i = V.table(spark, sf_dir, "documents"), F.col("doc_id")
    path = F.concat(F.when(i % 13 == 0, "../").otherwise("clips/"), i.cast("string"), F.lit(".mp4"))
    manifest = d.select(i.cast("string").alias("clip_id"), "source", path.alias("local_path"), F.when(i % 5 == 0, "old").otherwise("x").alias("sha256")).withColumnRenamed("source", "source_id")
    extra = V.table(spark, sf_dir, "pages").select(F.concat(F.lit("clips/extra"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".MP4").otherwise(".txt")).alias("path"), F.lit("x").alias("sha256"))
    files = d.filter("doc_id % 7 != 0").select(path.alias("path"), F.lit("x").alias("sha256")).unionByName(extra)
    return rules.file_issues(manifest, files).select("clip_id", "code", "details")


@query("SELECT 's' || doc_id AS source_id, CASE WHEN doc_id % 3 = 0 THEN 'UNKNOWN_SOURCE_MAPPING' WHEN doc_id % 5 = 0 THEN 'MISSING_SOURCE_PATH' ELSE 'MISSING_SOURCE_FILE' END AS code FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 0 OR doc_id % 7 = 0")
def source_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources without a mapping, a path or a file."""
    d, i = V.table(spark, sf_dir, "documents"), F.col("doc_id")
    path = F.concat(F.lit("raw/"), i.cast("string"))
    sources = d.select(F.concat(F.lit("s"), i.cast("string")).alias("source_id"), (i % 3 != 0).alias("mapped"), F.when(i % 5 != 0, path).alias("source_path"))
    return rules.source_issues(sources, d.filter("doc_id % 7 != 0").select(path.alias("path"))).select("source_id", "code")


@query(
    """WITH p AS (SELECT p_partkey, p_brand, p_size, first_value(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS b FROM part)
        SELECT p_partkey::VARCHAR AS clip_id, 'SOURCE_MEDIA_INCONSISTENCY' AS code, 'width' AS field, p_size || ' differs from ' || b AS details FROM p WHERE abs(p_size - b) > 3"""
)
def media_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips whose width is off the first of their source."""
    p = V.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("clip_id"), F.col("p_brand").alias("source_id"), F.col("p_size").alias("width"), F.col("p_partkey").alias("ordinal"))
    return rules.media_issues(p, {"width": 3.0}).select("clip_id", "code", "field", "details")


_SET = """c AS (SELECT doc_id, doc_id::VARCHAR AS clip_id, source AS source_video_id, CASE WHEN doc_id % 9 = 0 THEN 'nocam' ELSE lang END AS camera_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'k' || doc_id % 4 END AS session_id, n_chars::DOUBLE AS duration_sec, CASE WHEN doc_id % 10 = 0 THEN 99 ELSE 640 END AS width FROM documents WHERE doc_id % 8 != 0),
    e AS (SELECT event_id::VARCHAR AS event_id, event_id AS i, user_id::VARCHAR AS clip_id, value FROM events),
    s AS (SELECT doc_id AS clip, doc_id::VARCHAR AS clip_id, quality, toxic FROM labels),
    p AS (SELECT doc_id, doc_id::VARCHAR AS clip_id, source, lang, CASE WHEN doc_id % 29 = 0 THEN 'train' WHEN source IN ('src0', 'src1') THEN 'dev' ELSE 'test' END AS split FROM documents WHERE doc_id % 6 != 0)"""

_VALID = "CASE WHEN lang_ = 'de' THEN false ELSE true END"


def annotated(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Documents as clips, events as events, labels as scenarios; much in them is wrong."""
    d, i = V.table(spark, sf_dir, "documents"), F.col("doc_id")
    clip = i.cast("string").alias("clip_id")
    camera = F.when(i % 9 == 0, "nocam").otherwise(F.col("lang"))
    session = F.when(i % 5 == 0, "").otherwise(F.concat(F.lit("k"), (i % 4).cast("string")))
    clips = d.filter("doc_id % 8 != 0").select(clip, F.col("source").alias("source_video_id"), camera.alias("camera_id"), F.lit("v").alias("view_id"), session.alias("session_id"), F.col("n_chars").cast("double").alias("duration_sec"), F.when(i % 10 == 0, 99).otherwise(640).alias("width"), F.lit(480).alias("height"))
    cameras = d.select(F.col("lang").alias("camera_id"), F.lit("v").alias("view_id"), F.lit(640).alias("width"), F.lit(480).alias("height")).distinct()
    # The German camera's zone crosses itself, the English one stands twice, the French camera has no zones.
    square, bow = "array(array(0D,0D),array(9D,0D),array(9D,9D),array(0D,9D))", "array(array(0D,0D),array(9D,9D),array(9D,0D),array(0D,9D))"
    zone = lambda z, p: f"named_struct('zone_id','{z}','zone_type','SIDEWALK','polygon',{p})"
    zones = F.expr(f"case camera_id when 'de' then array({zone('Z1', bow)}) when 'en' then array({zone('Z1', square)}, {zone('Z1', square)}) when 'fr' then filter(array({zone('Z1', square)}), x -> false) else array({zone('Z1', square)}) end")
    documents = cameras.select("camera_id", "view_id", F.array(F.lit(640), F.lit(480)).alias("resolution"), zones.alias("zones"))
    lab = V.table(spark, sf_dir, "labels")
    scenarios = lab.select(clip, F.when(F.col("toxic") == 1, "crash").when(F.col("quality") == 1, "calm").otherwise("odd").alias("scenario"), F.when(F.col("toxic") == 1, "positive").otherwise("negative").alias("scenario_group"), F.when(i % 3 == 0, "pending").otherwise("approved").alias("review_status"))
    e, k = V.table(spark, sf_dir, "events"), F.col("event_id")
    events = e.select(k.cast("string").alias("event_id"), F.col("user_id").cast("string").alias("clip_id"), F.lit("en").alias("camera_id"), F.when(k % 4 == 0, "Z9").otherwise("Z1").alias("zone_id"), F.lit("SIDEWALK").alias("zone_type"), F.lit(rules.EVENT_LABEL).alias("label"), F.when(k % 7 == 0, "cow").otherwise("car").alias("object_class"), F.when(k % 11 == 0, "soon").otherwise("0").alias("start_time_sec"), F.lit("0").alias("violation_time_sec"), F.when(k % 13 == 0, "1e12").otherwise("").alias("end_time_sec"), F.lit("").alias("bbox_keyframes"), F.when(k % 5 == 0, "pending").otherwise("approved").alias("review_status"))
    splits = d.filter("doc_id % 6 != 0").select(clip, F.when(i % 29 == 0, "train").when(F.col("source").isin("src0", "src1"), "dev").otherwise("test").alias("split"), F.col("source").alias("source_video_id"), F.when(i % 31 == 0, "moved").otherwise(camera).alias("camera_id"), session.alias("session_id"))
    sources = d.filter("source != 'src3'").groupBy(F.col("source").alias("source_video_id")).agg((F.col("source_video_id") != "src2").alias("selected"))
    labels = spark.createDataFrame([("crash", "positive"), ("calm", "negative"), ("odd", "hard")], "scenario string, scenario_group string")
    return {"clips": clips, "cameras": cameras, "zone_documents": documents, "scenarios": scenarios, "events": events, "splits": splits, "sources": sources, "labels": labels, "classes": ["car", "person"]}


_CROSS = f"""{_SET}, x AS (SELECT e.*, c.camera_id, c.duration_sec FROM e JOIN c USING (clip_id)),
    g AS (SELECT clip_id, bool_or(toxic = 1) AS pos, bool_or(toxic != 1) AS neg FROM s GROUP BY clip_id), n AS (SELECT DISTINCT clip_id FROM e)
    SELECT 'missing_source' AS code, clip_id AS entity FROM c WHERE source_video_id = 'src3'
    UNION ALL SELECT 'source_not_selected', clip_id FROM c WHERE source_video_id = 'src2'
    UNION ALL SELECT 'missing_camera_view', clip_id FROM c WHERE camera_id = 'nocam'
    UNION ALL SELECT 'camera_resolution_mismatch', clip_id FROM c WHERE camera_id != 'nocam' AND width = 99
    UNION ALL SELECT 'empty_roi', clip_id FROM c WHERE camera_id = 'fr' UNION ALL SELECT 'invalid_polygon', clip_id FROM c WHERE camera_id = 'de' UNION ALL SELECT 'duplicate_zone', clip_id FROM c WHERE camera_id = 'en'
    UNION ALL SELECT 'scenario_missing_clip', clip_id FROM s WHERE clip_id NOT IN (SELECT clip_id FROM c) UNION ALL SELECT 'invalid_scenario', clip_id FROM s WHERE toxic = 0 AND quality = 0
    UNION ALL SELECT 'scenario_not_approved', clip_id FROM s WHERE clip % 3 = 0 UNION ALL SELECT 'event_missing_clip', event_id FROM e WHERE clip_id NOT IN (SELECT clip_id FROM c)
    UNION ALL SELECT 'event_missing_zone', event_id FROM x WHERE i % 4 = 0 OR camera_id IN ('fr', 'nocam') UNION ALL SELECT 'event_camera_mismatch', event_id FROM x WHERE camera_id != 'en'
    UNION ALL SELECT 'invalid_class', event_id FROM x WHERE i % 7 = 0 UNION ALL SELECT 'invalid_timing_or_bbox', event_id FROM x WHERE i % 11 = 0 UNION ALL SELECT 'invalid_timing', event_id FROM x WHERE i % 11 != 0 AND i % 13 = 0
    UNION ALL SELECT 'event_not_approved', event_id FROM x WHERE i % 5 = 0
    UNION ALL SELECT 'missing_scenario', c.clip_id FROM c ANTI JOIN g USING (clip_id) UNION ALL SELECT 'conflicting_scenarios', c.clip_id FROM c JOIN g USING (clip_id) WHERE pos AND neg
    UNION ALL SELECT 'negative_has_events', c.clip_id FROM c JOIN g USING (clip_id) JOIN n USING (clip_id) WHERE neg UNION ALL SELECT 'positive_without_event', c.clip_id FROM c JOIN g USING (clip_id) ANTI JOIN n USING (clip_id) WHERE pos
    UNION ALL SELECT 'split_missing_clip', clip_id FROM p WHERE doc_id % 8 = 0 UNION ALL SELECT 'invalid_split', clip_id FROM p WHERE split = 'train' AND doc_id % 8 != 0
    UNION ALL SELECT 'split_metadata_mismatch', clip_id FROM p WHERE doc_id % 31 = 0 AND doc_id % 8 != 0
    UNION ALL SELECT 'split_leakage', source FROM p WHERE doc_id % 8 != 0 GROUP BY source HAVING count(DISTINCT split) > 1
    UNION ALL SELECT 'missing_split', clip_id FROM c WHERE doc_id % 6 = 0"""


@query(f"WITH {_CROSS}")
def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tables of an annotated set say against each other."""
    return rules.cross_issues(**annotated(spark, sf_dir)).select("code", "entity")


@query(
    f"""WITH x AS (WITH {_CROSS}) SELECT CASE WHEN count(*) > 0 THEN 'ERROR' ELSE 'PASS' END AS status, count(*) AS issues FROM x"""
)
def cross_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report_status(rules.cross_issues(**annotated(spark, sf_dir)))


@query(
    """WITH c AS (SELECT doc_id::VARCHAR AS video_id, doc_id, source || lang AS source_video_id FROM documents), e AS (SELECT * FROM c WHERE doc_id % 3 = 0 AND doc_id % 5 != 0),
        r AS (SELECT source_video_id, count(*) AS n, min(video_id) AS v FROM e GROUP BY ALL), a AS (SELECT source_video_id, count(*) AS n, min(video_id) AS v FROM c GROUP BY ALL)
        SELECT a.source_video_id, CASE WHEN r.n = 1 THEN r.v WHEN r.n IS NULL AND a.n = 1 THEN a.v END AS video_id FROM a LEFT JOIN r USING (source_video_id)"""
)
def selected_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw item of each source, none where several are eligible."""
    d, i = V.table(spark, sf_dir, "documents"), F.col("doc_id")
    items = d.select(i.cast("string").alias("video_id"), F.concat("source", "lang").alias("source_video_id"))
    review = d.select(i.cast("string").alias("video_id"), F.when(i % 3 == 0, "").otherwise("x").alias("review_reason"), F.when(i % 5 == 0, "rejected").otherwise("").alias("review_status"))
    return registry.selected_catalog(items, review)


@query("SELECT user_id::VARCHAR AS clip_id, 'E' || substr(sha256(user_id || chr(0) || 'Z1' || chr(0) || 'car' || chr(0) || '0' || chr(0) || event_id), 1, 16) AS event_id, 'SIDEWALK' AS zone_type FROM events")
def appended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events added to none, with ids that follow from their content."""
    e = V.table(spark, sf_dir, "events")
    new = e.select(F.col("user_id").cast("string").alias("clip_id"), F.lit("Z1").alias("zone_id"), F.lit("car").alias("object_class"), F.lit("0").alias("start_time_sec"), F.col("event_id").cast("string").alias("violation_time_sec"), F.lit("").alias("end_time_sec"), F.lit("").alias("bbox_keyframes"))
    clips = V.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("clip_id"), F.lit("c").alias("camera_id"), F.lit("v").alias("view_id"), F.lit(1e9).alias("duration_sec")).distinct()
    zones = spark.range(1).select(F.lit("c").alias("camera_id"), F.lit("v").alias("view_id"), F.array(F.lit(640), F.lit(480)).alias("resolution"), F.expr("array(named_struct('zone_id','Z1','zone_type','SIDEWALK','polygon',array(array(0D,0D),array(9D,0D),array(9D,9D))))").alias("zones"))
    none = spark.createDataFrame([], "event_id string, clip_id string, zone_id string, zone_type string")
    return annotations.append_events(none, new, clips, zones, ["car"]).select("clip_id", "event_id", "zone_type")


@query("SELECT doc_id::VARCHAR AS clip_id, CASE WHEN quality = 1 THEN 'calm' ELSE 'crash' END AS scenario, CASE WHEN toxic = 1 THEN 'new' ELSE 'old' END AS reviewer FROM labels")
def labelled_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios after some were labelled anew: these replace what stood there."""
    lab = V.table(spark, sf_dir, "labels")
    rows = lab.select(F.col("doc_id").cast("string").alias("clip_id"), F.when(F.col("quality") == 1, "calm").otherwise("crash").alias("scenario"), F.col("toxic"))
    groups = spark.createDataFrame([("calm", "negative"), ("crash", "positive")], "scenario string, scenario_group string")
    old = rows.join(F.broadcast(groups), "scenario").select("clip_id", "scenario", "scenario_group", F.lit("old").alias("reviewer"), F.lit("approved").alias("review_status"), F.lit("").alias("note"))
    new = rows.filter("toxic = 1").select("clip_id", "scenario", F.lit("new").alias("reviewer"))
    return annotations.label_scenarios(old, new, rows.select("clip_id"), groups).select("clip_id", "scenario", "reviewer")


@query("SELECT doc_id::VARCHAR AS clip_id, CASE WHEN doc_id = 5 THEN 'cam' ELSE '' END AS camera_id FROM documents")
def registered_camera(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips after one was assigned to a new camera view."""
    clips = V.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("clip_id"), F.lit("").alias("camera_id"), F.lit("").alias("view_id"))
    none = spark.createDataFrame([], "camera_id string, view_id string, width int, height int")
    return annotations.register_camera(none, clips, "5", "cam", "v", 640, 480)[1].select("clip_id", "camera_id")


# ---- aggregates, order, functions -------------------------------------------------------------------------------


@query(
    f"""WITH {V.CLIPS} SELECT count(*) AS clips, count(DISTINCT source_id) AS sources, count(DISTINCT CASE WHEN ordinal % 3 = 0 THEN 'UNRESOLVED' ELSE event_type END) AS cameras, count(*) FILTER (ordinal % 3 = 0) AS unresolved_camera_clips,
        count(*) FILTER (ordinal % 2 = 0) AS metadata_fail, count(*) FILTER (ordinal % 4 = 0) AS missing_file FROM clips"""
)
def metadata_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = V.clips(spark, sf_dir), F.col("ordinal")
    rows = c.select("clip_id", "source_id", F.when(o % 3 == 0, "UNRESOLVED").otherwise(F.col("event_type")).alias("camera_id"), "duration_sec", F.when(o % 2 == 0, "FAIL").otherwise("PASS").alias("metadata_status"), F.lit(1).alias("width"), F.lit(1).alias("height"), F.lit("c").alias("codec"))
    issues = c.filter("ordinal % 4 = 0").select("clip_id", F.explode(F.array(F.lit("MISSING_FILE"), F.lit("MISSING_FILE"))).alias("code"))
    return summaries.metadata_summary(rows, issues).select("clips", "sources", "cameras", "unresolved_camera_clips", "metadata_fail", "missing_file")


@query("SELECT count(*) AS clips, count(*) FILTER (source IN ('src0', 'src1')) AS dev_clips, count(*) FILTER (NOT source IN ('src0', 'src1')) AS test_clips, count(DISTINCT lang) AS cameras, count(*) FILTER (toxic = 1) AS positive_clips, count(*) FILTER (toxic = 0) AS negative_clips FROM documents LEFT JOIN labels USING (doc_id)")
def set_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents")
    clip = F.col("doc_id").cast("string").alias("clip_id")
    clips = d.select(clip, F.col("lang").alias("camera_id"), F.col("n_chars").cast("double").alias("duration_sec"))
    splits = d.select(clip, F.when(F.col("source").isin("src0", "src1"), "dev").otherwise("test").alias("split"))
    scenarios = V.table(spark, sf_dir, "labels").select(clip, F.when(F.col("toxic") == 1, "positive").otherwise("negative").alias("scenario_group"))
    return split.summary(clips, splits, scenarios).select("clips", "dev_clips", "test_clips", "cameras", "positive_clips", "negative_clips")


@query("SELECT count(*) AS candidates, count(*) FILTER (quality = 1) AS reused, count(*) FILTER (quality != 1 AND toxic != 1) AS analysed, count(*) FILTER (toxic = 1) AS failed FROM labels")
def analysis_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.table(spark, sf_dir, "labels").select(F.when(F.col("quality") == 1, "cache").otherwise("new").alias("origin"), F.when(F.col("toxic") == 1, "FAILED").otherwise("COMPUTED").alias("signal_status"))
    return summaries.analysis_summary(rows)


@query(f"WITH {V.JOBS} SELECT count(*) AS running FROM jobs WHERE status = 'RUNNING'")
def running_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many jobs run, as a backup asks."""
    return V.jobs(spark, sf_dir).filter("status = 'RUNNING'").agg(F.count(F.lit(1)).alias("running"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each key in a given order."""
    return dedupe.first_per_key(V.table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 ELSE 2 END, o_custkey, o_orderkey) AS place FROM orders")
def issue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues by falling severity, then by keys."""
    o = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "F", "FAIL").when(F.col("o_orderstatus") == "P", "WARNING").otherwise("INFO").alias("severity"))
    ordered = rules.ordered_issues(o, ["o_custkey", "o_orderkey"])
    return ranking.ranked(ordered, [-rules.severity_rank("severity"), "o_custkey", "o_orderkey"], "place").select("o_orderkey", "place")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 2 = 0 THEN greatest(0.0::DOUBLE, greatest(l_quantity, l_linenumber * 10.0) - least(l_quantity + 5, l_linenumber * 10.0 + 5))::DOUBLE ELSE 'Infinity'::DOUBLE END AS gap FROM lineitem")
def temporal_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n = F.col("l_quantity").cast("double"), F.col("l_linenumber") * 10.0
    return V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.temporal_gap(F.lit(0).cast("bigint"), q, q + 5, (F.col("l_suppkey") % 2).cast("bigint"), n, n + 5).alias("gap"))


@query("SELECT a.vec_id, round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2)) / 64), 6) AS distance FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE len(a.embedding) = 64 AND len(b.embedding) = 64")
def feature_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root mean square difference of each vector from the next one."""
    e = V.table(spark, sf_dir, "embeddings").filter(F.size("embedding") == 64).select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("e").alias("f"))
    return e.join(after, "vec_id").select("vec_id", F.round(S.rms_distance(F.col("e"), F.col("f")), 6).alias("distance"))


@query("SELECT event_id, CASE WHEN event_id % 9 = 0 THEN false ELSE event_id % 12 <= 5 END AS complete FROM events")
def capture_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings that began at most five seconds after the broadcast."""
    e, i = V.table(spark, sf_dir, "events"), F.col("event_id")
    begin = F.timestamp_seconds(F.lit(1_000_000)).cast("timestamp")
    return e.select("event_id", S.capture_complete(F.timestamp_seconds(F.lit(1_000_000) + i % 12), F.when(i % 9 != 0, begin)).alias("complete"))


@query("SELECT event_id, strftime(make_timestamp((event_id * 86399) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS at FROM events")
def instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "events").select("event_id", S.instant(F.col("event_id").cast("bigint") * 86399).alias("at"))


@query(
    """SELECT event_id, CASE event_id % 8 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN false WHEN 4 THEN false WHEN 5 THEN false WHEN 6 THEN event_id % 100 + 10 < 640 ELSE true END AS valid FROM events"""
)
def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons of eight sorts: square, bow, two points, no area, outside, touching itself, one that is moved about, star."""
    sorts = ["array(array(0D,0D),array(9D,0D),array(9D,9D),array(0D,9D))", "array(array(0D,0D),array(9D,9D),array(9D,0D),array(0D,9D))", "array(array(0D,0D),array(9D,9D),array(0D,0D))", "array(array(0D,0D),array(4D,4D),array(9D,9D))", "array(array(0D,0D),array(640D,0D),array(9D,9D))", "array(array(0D,0D),array(8D,0D),array(8D,8D),array(4D,0D),array(0D,8D))", "array(array(event_id % 100 + 1D,0D),array(event_id % 100 + 10D,0D),array(event_id % 100 + 10D,10D))", "array(array(0D,4D),array(3D,3D),array(4D,0D),array(5D,3D),array(8D,4D),array(5D,5D),array(4D,8D),array(3D,5D))"]
    points = F.expr(f"element_at(array({', '.join(sorts)}), cast(event_id % 8 + 1 as int))")
    return V.table(spark, sf_dir, "events").select("event_id", S.polygon_valid(points, F.lit(640), F.lit(480)).alias("valid"))


@query(
    """SELECT event_id, unnest(list_concat(CASE WHEN event_id % 3 = 0 THEN ['invalid_label'] ELSE [] END, CASE WHEN event_id % 5 = 0 THEN ['invalid_class'] ELSE [] END,
        CASE WHEN event_id % 7 = 0 THEN ['invalid_timing_or_bbox'] ELSE list_concat(CASE WHEN event_id % 11 = 0 THEN ['invalid_timing'] ELSE [] END, CASE WHEN event_id % 2 = 0 THEN ['invalid_bbox', 'invalid_bbox'] ELSE [] END) END)) AS code FROM events"""
)
def event_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with events, one code for each bad keyframe."""
    e, i = V.table(spark, sf_dir, "events"), F.col("event_id")
    frames_ = F.when(i % 2 == 0, '[{"time_sec":1,"bbox":[5,0,1,1]},{"time_sec":99,"bbox":[0,0,1,1]},{"time_sec":2,"bbox":[0,0,1,1]}]').otherwise("")
    rows = e.select("event_id", F.when(i % 3 == 0, "x").otherwise(rules.EVENT_LABEL).alias("label"), F.when(i % 5 == 0, "cow").otherwise("car").alias("object_class"), F.when(i % 7 == 0, "?").otherwise("0").alias("start_time_sec"), F.when(i % 11 == 0, "50").otherwise("3").alias("violation_time_sec"), F.when(i % 4 == 0, "").otherwise("10").alias("end_time_sec"), frames_.alias("bbox_keyframes"))
    return rows.select("event_id", F.explode(rules.event_errors(F.lit(10.0), ["car"])).alias("code"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 4 = 0 THEN NULL ELSE lang || chr(0) || source END AS by_session, source AS by_source FROM documents")
def group_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    camera, session = F.when(i % 3 != 0, F.col("lang")), F.when(i % 4 == 0, "").otherwise(F.col("source"))
    return V.table(spark, sf_dir, "documents").select("doc_id", S.group_key("camera_session", "source", camera, session).alias("by_session"), S.group_key("source_video_id", "source", camera, session).alias("by_source"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END::INT AS n FROM documents")
def json_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    text = F.when(i % 3 == 0, F.format_string("[%d, 1.5]", i)).when(i % 3 == 1, "not json")
    return V.table(spark, sf_dir, "documents").select("doc_id", F.size(S.json_list(text, "double")).alias("n"))


@query("SELECT 'Z' || event_id % 3 AS zone_id, lang AS camera_id, count(*) AS n, bool_and(event_id % 2 = 0) AS all_valid FROM events JOIN documents ON user_id = doc_id GROUP BY ALL")
def zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones out of the documents of camera views; every other one crosses itself."""
    e = V.table(spark, sf_dir, "events").join(V.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("user_id"), "lang"), "user_id")
    polygon = F.expr("if(event_id % 2 = 0, array(array(0D,0D),array(9D,0D),array(9D,9D)), array(array(0D,0D),array(9D,9D),array(9D,0D),array(0D,9D)))")
    zone = F.struct(F.concat(F.lit("Z"), (F.col("event_id") % 3).cast("string")).alias("zone_id"), F.lit("ALLOWED").alias("zone_type"), polygon.alias("polygon"))
    documents = e.select(F.col("lang").alias("camera_id"), F.lit("v").alias("view_id"), F.array(F.lit(640), F.lit(480)).alias("resolution"), F.array(zone).alias("zones"))
    return rules.zone_rows(documents).groupBy("zone_id", "camera_id").agg(F.max("times").alias("n"), F.min("valid").alias("all_valid"))


# ---- catalog ----------------------------------------------------------------------------------------------------

_CAME = f"""w AS (SELECT i.*, last_type, coalesce(active, false) AS active, {V.DESIRED} AS want FROM items i LEFT JOIN last USING (video_id)),
    go AS (SELECT *, want IS NOT NULL AND NOT active AND (local_status != 'COMPLETED' OR want = 'REPLAY_RECOVERY') AND {V.MAY_QUEUE} AND (local_status != 'FAILED' OR (want = 'REPLAY_RECOVERY' AND last_type IS DISTINCT FROM want)) AS go FROM w)"""


@query(
    f"""WITH {V.ITEMS}, {V.JOBS}, {_CAME} SELECT video_id, CASE WHEN go THEN 'QUEUED' WHEN live_status = 'is_upcoming' AND local_status = 'DISCOVERED' THEN 'WAITING' ELSE local_status END AS local_status,
        (CASE WHEN go AND last_type IS NOT NULL AND last_type != want THEN 0 ELSE retry_count END)::INT AS retry_count, CASE WHEN go THEN want END AS new_job, CASE WHEN go THEN (SELECT max(id) FROM jobs) + row_number() OVER (PARTITION BY go ORDER BY video_id) ELSE -1 END AS job_id FROM go"""
)
def scheduled_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog after what can be queued was, and the new jobs."""
    jobs = V.jobs(spark, sf_dir)
    items, after = catalog.schedule(V.items(spark, sf_dir), jobs, V.now())
    new = after.join(jobs.select("id"), "id", "left_anti").select("video_id", F.col("job_type").alias("new_job"), F.col("id").alias("job_id"))
    return items.join(new, "video_id", "left").select("video_id", "local_status", "retry_count", "new_job", F.coalesce("job_id", F.lit(-1)).alias("job_id"))


@query(
    f"""WITH {V.ITEMS}, {V.JOBS}, q AS (SELECT i.*, last_type, NOT coalesce(active, false) AND local_status != 'COMPLETED' AND {V.MAY_QUEUE} AND doc_id % 2 = 0 AS go FROM items i LEFT JOIN last USING (video_id))
        SELECT video_id, CASE WHEN go THEN 'QUEUED' ELSE local_status END AS local_status, (CASE WHEN go AND last_type != 'VOD_DOWNLOAD' THEN 0 ELSE retry_count END)::INT AS retry_count, go AS queued FROM q"""
)
def enqueued_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other item is wanted as a download: the rest of the rules decides."""
    jobs, items = V.jobs(spark, sf_dir), V.items(spark, sf_dir)
    wanted = items.filter("cast(video_id as int) % 2 = 0").select("video_id", F.lit("VOD_DOWNLOAD").alias("job_type"))
    new_items, after = catalog.enqueue(items, jobs, wanted, V.now(), "manual")
    new = after.join(jobs.select("id"), "id", "left_anti").select("video_id", F.lit(True).alias("queued"))
    return new_items.join(new, "video_id", "left").select("video_id", "local_status", "retry_count", F.coalesce("queued", F.lit(False)).alias("queued"))


@query(
    f"""WITH {V.ITEMS}, {V.JOBS}, x AS (SELECT * FROM jobs WHERE status = 'QUEUED' AND origin = 'watcher' AND video_id NOT IN (SELECT video_id FROM items WHERE doc_id % 3 = 0))
        SELECT video_id, CASE WHEN video_id IN (SELECT video_id FROM x) AND local_status = 'QUEUED' THEN 'DISCOVERED' ELSE local_status END AS local_status, (SELECT count(*) FROM x) AS cancelled FROM items"""
)
def cancelled_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a shorter list of allowed items does to the catalog."""
    items = V.items(spark, sf_dir)
    after, jobs = catalog.cancel_outside(items, V.jobs(spark, sf_dir), items.filter("cast(video_id as int) % 3 = 0"), V.now())
    n = jobs.filter("status = 'CANCELLED'").agg(F.count(F.lit(1)).alias("cancelled"))
    return after.select("video_id", "local_status").crossJoin(F.broadcast(n))  # one row


_OUTCOMES = f"""{V.ITEMS}, o AS (SELECT doc_id, doc_id % 2 = 1 AS bad FROM items WHERE local_status = 'VALIDATING')"""


@query(
    f"""WITH {_OUTCOMES} SELECT i.video_id, CASE WHEN bad AND retry_count + 1 < 3 THEN 'QUEUED' WHEN bad THEN 'FAILED' WHEN NOT bad THEN 'COMPLETED' ELSE local_status END AS local_status, (retry_count + CASE WHEN bad THEN 1 ELSE 0 END)::INT AS retry_count,
        CASE WHEN bad THEN 2000 ELSE 0 END::INT AS error_chars, CASE WHEN bad AND retry_count + 1 < 3 THEN 'QUEUED' WHEN bad THEN 'FAILED' WHEN NOT bad THEN 'DONE' END AS job_status FROM items i LEFT JOIN o USING (doc_id)"""
)
def finished_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items being validated, half of which fail: errors are cut, and items come back until their attempts are used up."""
    items = V.items(spark, sf_dir)
    mine = items.filter("local_status = 'VALIDATING'").select(F.col("video_id").cast("bigint").alias("id"), "video_id")
    null = lambda t: F.lit(None).cast(t)
    outcomes = mine.select("id", "video_id", F.when(F.col("id") % 2 == 1, F.repeat(F.lit("x"), 3000)).alias("error"), F.lit("p").alias("path"), F.lit(1).cast("bigint").alias("size"), F.lit("s").alias("sha256"), null("double").alias("duration_sec"), F.lit("vod_download").alias("source"), F.lit(True).alias("complete"))
    jobs = mine.select("id", "video_id", F.lit("VOD_DOWNLOAD").alias("job_type"), F.lit("RUNNING").alias("status"), F.lit("watcher").alias("origin"), F.lit(1).alias("attempts"), V.now().alias("available_at"), null("string").alias("last_error"), V.now().alias("created_at"), V.now().alias("updated_at"))
    after, done = catalog.finish(items, jobs, outcomes, V.now(), 3, 60)
    return after.join(done.select("video_id", F.col("status").alias("job_status")), "video_id", "left").select("video_id", "local_status", "retry_count", F.coalesce(F.length("last_error"), F.lit(0)).alias("error_chars"), "job_status")


@query(f"WITH {V.ITEMS} SELECT video_id, CASE WHEN doc_id % 3 = 0 THEN 7.0::DOUBLE ELSE duration_sec END AS duration_sec, (CASE WHEN doc_id % 3 = 0 THEN 9 ELSE retry_count END)::INT AS retry_count, local_status FROM items")
def set_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that may be changed, of some items."""
    items = V.items(spark, sf_dir)
    changes = items.filter("cast(video_id as int) % 3 = 0").select("video_id", F.lit(7.0).alias("duration_sec"), F.lit(9).alias("retry_count"))
    return catalog.set_fields(items, changes, V.now()).select("video_id", "duration_sec", "retry_count", "local_status")


_REQUESTS = f"""{V.ITEMS}, {V.JOBS}, r AS (SELECT i.*, last_type, coalesce(active, false) AS active, CASE WHEN doc_id % 7 = 0 AND channel_id != 'src0' THEN 'failed' WHEN local_status = 'COMPLETED' AND capture_complete = 1 THEN 'skipped' WHEN live_status = 'is_upcoming' THEN 'waiting' WHEN local_status = 'FAILED' THEN 'retried' ELSE 'queued' END AS outcome FROM items i LEFT JOIN last USING (video_id)),
    r2 AS (SELECT * REPLACE (CASE WHEN outcome IN ('retried', 'waiting') AND local_status = 'FAILED' THEN 'RETRY' ELSE local_status END AS local_status, CASE WHEN outcome IN ('retried', 'waiting') AND local_status = 'FAILED' THEN 0 ELSE retry_count END AS retry_count) FROM r),
    q AS (SELECT *, {V.DESIRED} AS want FROM r2), g AS (SELECT *, outcome IN ('queued', 'retried', 'waiting') AND want IS NOT NULL AND NOT active AND (local_status != 'COMPLETED' OR want = 'REPLAY_RECOVERY') AND {V.MAY_QUEUE} AND (local_status != 'FAILED' OR (want = 'REPLAY_RECOVERY' AND last_type IS DISTINCT FROM want)) AS go FROM q)"""


@query(
    f"""WITH {_REQUESTS} SELECT video_id, outcome, CASE WHEN go THEN 'QUEUED' WHEN outcome = 'waiting' AND local_status = 'DISCOVERED' THEN 'WAITING' ELSE local_status END AS local_status, (CASE WHEN go AND last_type IS NOT NULL AND last_type != want THEN 0 ELSE retry_count END)::INT AS retry_count, go AS queued FROM g"""
)
def manual_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog after a request for every item, some under another channel's name."""
    items, jobs = V.items(spark, sf_dir), V.jobs(spark, sf_dir)
    requests = items.select("video_id", F.when(F.col("video_id").cast("int") % 7 == 0, "src0").alias("channel_hint"))
    after, now, outcomes = catalog.request(items, jobs, requests, V.now(), enabled_channels=2)
    new = now.filter("origin = 'manual'").join(jobs.select("id"), "id", "left_anti").select("video_id", F.lit(True).alias("queued"))
    return after.join(outcomes, "video_id").join(new, "video_id", "left").select("video_id", "outcome", "local_status", "retry_count", F.coalesce("queued", F.lit(False)).alias("queued"))


@query(
    f"""WITH {V.ITEMS}, {V.JOBS}, j AS (SELECT *, CASE WHEN status = 'RUNNING' THEN 'QUEUED' ELSE status END AS now FROM jobs), a AS (SELECT video_id, bool_or(now = 'QUEUED') AS q FROM j GROUP BY video_id),
        i AS (SELECT items.*, coalesce(a.q, false) AS q FROM items LEFT JOIN a USING (video_id)), s AS (SELECT * REPLACE (CASE WHEN local_status IN ('DOWNLOADING', 'RECORDING', 'VALIDATING') THEN CASE WHEN q THEN 'QUEUED' ELSE 'RETRY' END ELSE local_status END AS local_status) FROM i),
        w AS (SELECT s.*, last_type, {V.DESIRED} AS want FROM s LEFT JOIN last USING (video_id)), g AS (SELECT *, want IS NOT NULL AND NOT q AND channel_id IN ('src0', 'src1') AND (local_status != 'COMPLETED' OR want = 'REPLAY_RECOVERY') AND {V.MAY_QUEUE} AND (local_status != 'FAILED' OR (want = 'REPLAY_RECOVERY' AND last_type IS DISTINCT FROM want)) AS go FROM w)
        SELECT video_id, CASE WHEN go THEN 'QUEUED' WHEN channel_id IN ('src0', 'src1') AND live_status = 'is_upcoming' AND local_status = 'DISCOVERED' THEN 'WAITING' ELSE local_status END AS local_status FROM g"""
)
def resumed_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start of a watcher in mode ``all``: recovered, and the items of enabled channels scheduled."""
    items, _ = watcher.resume(V.items(spark, sf_dir), V.jobs(spark, sf_dir), _acquisition(mode="all"), V.now())
    return items.select("video_id", "local_status")


@query(
    f"""WITH {V.ITEMS}, c AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS k FROM items WHERE local_status = 'QUEUED' AND doc_id % 2 = 0), d AS (SELECT * FROM c WHERE k <= 50)
        SELECT video_id, CASE WHEN d.doc_id IS NULL THEN i.local_status WHEN i.doc_id % 3 = 0 AND i.retry_count + 1 < 3 THEN 'QUEUED' WHEN i.doc_id % 3 = 0 THEN 'FAILED' ELSE 'COMPLETED' END AS local_status,
        CASE WHEN d.doc_id IS NULL OR i.doc_id % 3 = 0 THEN NULL WHEN i.doc_id % 4 = 0 THEN 'live_record' ELSE 'vod_download' END AS capture_source, coalesce(CASE WHEN d.doc_id IS NULL OR i.doc_id % 3 = 0 THEN i.capture_complete WHEN i.doc_id % 4 = 0 THEN 0 ELSE 1 END, -1)::INT AS capture_complete FROM items i LEFT JOIN (SELECT doc_id FROM d) d USING (doc_id)"""
)
def worked_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty workers' worth of queued jobs, claimed and done by a provider that fails on every third; live recordings began too late."""
    store = watcher.Snapshots(spark, _scratch(spark, "catalog"))
    items = V.items(spark, sf_dir)
    i = F.col("video_id").cast("bigint")
    null = lambda t: F.lit(None).cast(t)
    jobs = items.filter("local_status = 'QUEUED' and cast(video_id as int) % 2 = 0").select(i.alias("id"), "video_id", F.when(i % 4 == 0, "LIVE_RECORD").otherwise("VOD_DOWNLOAD").alias("job_type"), F.lit("QUEUED").alias("status"), F.lit("watcher").alias("origin"), F.lit(0).alias("attempts"), V.now().alias("available_at"), null("string").alias("last_error"), V.now().alias("created_at"), V.now().alias("updated_at"))
    store.write(items, jobs)

    def provider(claimed: DataFrame) -> DataFrame:
        return claimed.select("id", V.now().alias("started_at"), F.lit("p").alias("path"), F.lit(1).cast("bigint").alias("size"), F.lit("s").alias("sha256"), null("double").alias("duration_sec"), F.when(F.col("id") % 3 == 0, "no network").alias("error"))

    watcher.work(store, provider, _acquisition(), V.now(), 50)
    return store.read()[0].select("video_id", "local_status", "capture_source", F.coalesce("capture_complete", F.lit(-1)).alias("capture_complete"))


@query(
    f"""WITH {V.ITEMS} SELECT video_id, CASE WHEN doc_id % 21 = 0 THEN 'FAILED' WHEN doc_id % 7 = 0 THEN 'COMPLETED' ELSE local_status END AS local_status, retry_count + CASE WHEN doc_id % 21 = 0 THEN 1 ELSE 0 END AS retry_count FROM items WHERE doc_id % 11 != 0
        UNION ALL SELECT 'new' || doc_id, 'DISCOVERED', 0 FROM items WHERE doc_id % 13 = 0"""
)
def merged_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog written once, then three batches of changes, new items and removals as deltas beside it, read back as one."""
    store = Snapshots(spark, _scratch(spark, "deltas"))
    i = F.col("video_id").cast("bigint")
    items, jobs = V.items(spark, sf_dir), V.jobs(spark, sf_dir)
    items, jobs = store.write(items, jobs, 0)
    items, jobs = store.write(items.withColumn("local_status", F.when(i % 7 == 0, "COMPLETED").otherwise(F.col("local_status"))), jobs, 1)
    worse = i % 21 == 0
    items, jobs = store.write(items.withColumns({"local_status": F.when(worse, "FAILED").otherwise(F.col("local_status")), "retry_count": F.col("retry_count") + F.when(worse, 1).otherwise(0)}), jobs, 2)
    fresh = V.items(spark, sf_dir).filter(i % 13 == 0).withColumns({"video_id": F.concat(F.lit("new"), "video_id"), "local_status": F.lit("DISCOVERED"), "retry_count": F.lit(0)})
    items, _ = store.write(items.filter(i % 11 != 0).unionByName(fresh), jobs, 3)
    return items.select("video_id", "local_status", "retry_count")


# ---- analysis ---------------------------------------------------------------------------------------------------


@query(
    """WITH s AS (SELECT vec_id::VARCHAR AS clip_id, vec_id % 3 AS part, round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, (embedding[1]::DOUBLE + 1) / 2)), 6) AS score FROM embeddings)
        SELECT clip_id, CASE WHEN part = 0 THEN 'new' ELSE 'cache' END AS origin, row_number() OVER (ORDER BY score DESC, clip_id) AS place FROM s"""
)
def incremental_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three clips come from the cache, the others are analysed; all are ranked together, here by their event score."""
    from .queries import _pool

    number = F.col("clip_id").cast("int")
    scored = _pool(spark, sf_dir).withColumns({"sha256": F.lit("s"), "ordinal": number, "visual_signature": F.lit("f"), "keyframe_timestamps": F.lit("[]"), "keyframe_reasons": F.lit("[]")})
    cache = scored.withColumns({"signal_status": F.lit("COMPUTED"), "analysis_sha256": F.when(number % 3 == 0, "old").otherwise("s"), "analysis_fingerprint": F.lit(fingerprint(analysis.SELECTION))})
    plain = scored.select("clip_id", "source_id", "sha256", "start_sec", "end_sec")
    out = analysis.run_analysis(plain, cache, lambda misses: misses.join(scored.drop("source_id", "sha256", "start_sec", "end_sec"), "clip_id").withColumn("signal_status", F.lit("COMPUTED")))
    return ranking.ranked(out.select("clip_id", "origin", "event_likelihood_score"), [F.desc("event_likelihood_score"), "clip_id"], "place").select("clip_id", "origin", "place")


@query(
    f"""{V.CHOICES} SELECT clip_id, CASE WHEN taken THEN 'REVIEW_POOL' ELSE 'NOT_SELECTED' END AS selection_status, CASE WHEN taken THEN 'REVIEWED' ELSE '' END AS manual_review_status, CASE WHEN taken THEN 'KEEP' ELSE '' END AS manual_review_label, redundant AND NOT taken AS redundant FROM chosen"""
)
def review_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool with earlier reviews, and rows that a chosen one makes redundant; a greedy choice is no SQL, the tests hold it against a plain loop."""
    from .queries import SELECTION, _pool

    settings = SELECTION | {"source_minimum": 5}
    rows = _pool(spark, sf_dir).withColumn("analysis_fingerprint", F.lit(fingerprint(settings)))
    reviews = analysis.earlier_reviews(rows.select("clip_id", F.lit("REVIEWED").alias("manual_review_status"), F.lit("KEEP").alias("manual_review_label"), F.lit("").alias("manual_review_notes")))
    pool, redundant = analysis.review_pool(rows, reviews, settings)
    return pool.join(redundant.select("clip_id", F.lit(True).alias("redundant")), "clip_id", "left").select("clip_id", "selection_status", "manual_review_status", "manual_review_label", F.coalesce("redundant", F.lit(False)).alias("redundant"))
