"""Views that give the benchmark tables the roles the operators work on, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import attach


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return attach(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as clips on the timelines of their users."""
    e = table(spark, sf_dir, "events")
    start = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return e.select(F.col("event_id").cast("string").alias("clip_id"), F.col("user_id").cast("string").alias("source_id"), start.alias("start_sec"), (start + 60.0 * F.col("value")).alias("end_sec"), (60.0 * F.col("value")).alias("duration_sec"), F.col("event_id").alias("ordinal"), "event_type", "props")


CLIPS = """clips AS (SELECT CAST(event_id AS VARCHAR) AS clip_id, CAST(user_id AS VARCHAR) AS source_id, epoch_us(ts)::DOUBLE / 1e6 AS start_sec,
    epoch_us(ts)::DOUBLE / 1e6 + 60.0::DOUBLE * value AS end_sec, 60.0::DOUBLE * value AS duration_sec, event_id AS ordinal, event_type, props FROM events)"""


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw items of their sources."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("video_id"), F.col("source").alias("source_video_id"), F.sha2("text", 256).alias("sha256"), F.col("n_chars").cast("double").alias("duration_sec"), F.concat(F.lit("raw/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("local_path"), F.col("doc_id").alias("ordinal"), "lang", "doc_id")


VIDEOS = """videos AS (SELECT CAST(doc_id AS VARCHAR) AS video_id, source AS source_video_id, sha256(text) AS sha256, n_chars::DOUBLE AS duration_sec,
    'raw/' || source || '/' || CAST(doc_id AS VARCHAR) || '.mp4' AS local_path, doc_id AS ordinal, lang, doc_id FROM documents)"""


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs of an embedding's 64 components as a signature."""
    e = table(spark, sf_dir, "embeddings")
    bits = F.aggregate(F.transform("embedding", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda a, v: a.bitwiseOR(v))
    return e.select(F.col("vec_id").cast("string").alias("clip_id"), F.col("label").cast("string").alias("source_id"), bits.alias("signature"), (F.col("vec_id") * 20.0).alias("start_sec"), (F.col("vec_id") * 20.0 + 30.0).alias("end_sec"), "vec_id", "embedding")


SIGNATURES = """signatures AS (SELECT CAST(vec_id AS VARCHAR) AS clip_id, CAST(label AS VARCHAR) AS source_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '')::BIT AS bits,
    vec_id * 20.0::DOUBLE AS start_sec, vec_id * 20.0::DOUBLE + 30.0::DOUBLE AS end_sec, vec_id FROM embeddings)"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as analysed clips: their figures scaled to signals."""
    x = table(spark, sf_dir, "lineitem")
    # Odd scales keep sums off the middle between two rounded values.
    q, d, t, p = F.col("l_quantity") / 50.31, F.col("l_discount") * 9.873, F.col("l_tax") * 12.179, F.col("l_extendedprice") / 104729.0
    return x.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("clip_id"),
        F.col("l_suppkey").cast("string").alias("source_id"),
        q.alias("foreground_occupancy_score"),
        d.alias("activity_score"),
        t.alias("persistence_score"),
        p.alias("visual_variation_score"),
        (1 - q).alias("small_far_score"),
        (q * d).alias("occlusion_score"),
        (1 - d).alias("boundary_edge_score"),
        (1 - t).alias("blur_score"),
        (q * t).alias("crowded_score"),
        (d * t).alias("fast_motion_score"),
        (1 - p).alias("low_light_score"),
        (q * q).alias("motion_variation_score"),
        (1 - p).alias("brightness_score"),
    )


SIGNALS = """signals AS (SELECT l_orderkey || '-' || l_linenumber AS clip_id, CAST(l_suppkey AS VARCHAR) AS source_id, q AS foreground_occupancy_score, d AS activity_score, t AS persistence_score, p AS visual_variation_score,
    1 - q AS small_far_score, q * d AS occlusion_score, 1 - d AS boundary_edge_score, 1 - t AS blur_score, q * t AS crowded_score, d * t AS fast_motion_score, 1 - p AS low_light_score, q * q AS motion_variation_score, 1 - p AS brightness_score
    FROM (SELECT *, l_quantity / 50.31::DOUBLE AS q, l_discount * 9.873::DOUBLE AS d, l_tax * 12.179::DOUBLE AS t, l_extendedprice / 104729.0::DOUBLE AS p FROM lineitem))"""

SCORED = (
    SIGNALS
    + """, summed AS (SELECT *, 0.34::DOUBLE * foreground_occupancy_score + 0.27::DOUBLE * activity_score + 0.21::DOUBLE * persistence_score + 0.18::DOUBLE * visual_variation_score AS event,
    0.18::DOUBLE * small_far_score + 0.14::DOUBLE * occlusion_score + 0.14::DOUBLE * boundary_edge_score + 0.16::DOUBLE * blur_score + 0.16::DOUBLE * crowded_score + 0.12::DOUBLE * fast_motion_score + 0.10::DOUBLE * low_light_score AS hard FROM signals),
    scored AS (SELECT *, round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, event)), 6) AS event_likelihood_score, round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, hard)), 6) AS hardcase_score,
    CASE WHEN event < 0.24::DOUBLE THEN 'LOW' WHEN event >= 0.36::DOUBLE THEN 'HIGH' ELSE 'MEDIUM' END AS event_likelihood_level,
    concat_ws('|', CASE WHEN small_far_score >= 0.65::DOUBLE THEN 'SMALL_FAR' END, CASE WHEN occlusion_score >= 0.65::DOUBLE THEN 'OCCLUSION' END, CASE WHEN boundary_edge_score >= 0.65::DOUBLE THEN 'BOUNDARY_EDGE' END,
        CASE WHEN blur_score >= 0.65::DOUBLE THEN 'BLUR' END, CASE WHEN crowded_score >= 0.65::DOUBLE THEN 'CROWDED' END, CASE WHEN fast_motion_score >= 0.65::DOUBLE THEN 'FAST_MOTION' END, CASE WHEN low_light_score >= 0.65::DOUBLE THEN 'LOW_LIGHT' END) AS hardcase_tags FROM summed)"""
)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an upsert log: the item is the user, and some values are missing."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(F.col("user_id").cast("string").alias("video_id"), "ts", "event_id", "event_type", F.nullif((k % 7).cast("double"), F.lit(0.0)).alias("payload"), k.alias("k"))


LOG = """log AS (SELECT CAST(user_id AS VARCHAR) AS video_id, ts, event_id, event_type, nullif((CAST(json_extract_string(props, '$.k') AS BIGINT) % 7)::DOUBLE, 0.0::DOUBLE) AS payload,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


LIVE = ("is_upcoming", "is_live", "was_live", "not_live", "unknown")
LOCAL = ("DISCOVERED", "WAITING", "QUEUED", "DOWNLOADING", "RECORDING", "VALIDATING", "COMPLETED", "FAILED", "RETRY")
KINDS = ("VOD_DOWNLOAD", "LIVE_RECORD", "REPLAY_RECOVERY")
JOB_STATES = ("DONE", "QUEUED", "RUNNING", "FAILED")
NOW = "2030-01-01 00:00:00"


def pick(values: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), (n % len(values) + 1).cast("int"))


def sql_pick(values: tuple[str, ...], n: str) -> str:
    return f"list_extract([{', '.join(repr(x) for x in values)}], (({n}) % {len(values)} + 1)::INT)"


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as catalog items in all combinations of states."""
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    null = lambda t: F.lit(None).cast(t)
    return d.select(
        i.cast("string").alias("video_id"), F.col("source").alias("channel_id"), null("string").alias("channel_name"), F.concat(F.lit("Title "), "lang").alias("title"), F.lit("u").alias("source_url"), F.lit("vod").alias("item_type"),
        pick(LIVE, i).alias("live_status"), pick(LOCAL, F.expr("doc_id div 5")).alias("local_status"), null("string").alias("scheduled_start"), F.lit("2029-12-31T23:59:50+00:00").alias("actual_start"), F.col("n_chars").cast("double").alias("duration_sec"),
        F.concat(F.lit("raw/"), "source", F.lit("/"), i.cast("string"), F.lit("/source.mp4")).alias("local_path"), F.octet_length("text").cast("bigint").alias("file_size_bytes"), F.sha2("text", 256).alias("sha256"), null("string").alias("capture_source"),
        F.nullif((F.expr("doc_id div 45") % 3).cast("int"), F.lit(2)).alias("capture_complete"), (i % 4).cast("int").alias("retry_count"), null("string").alias("last_error"), F.lit("2029-01-01").cast("timestamp").alias("discovered_at"), F.lit("2029-01-01").cast("timestamp").alias("updated_at"),
    )


ITEMS = f"""items AS (SELECT doc_id, doc_id::VARCHAR AS video_id, source AS channel_id, 'Title ' || lang AS title, {sql_pick(LIVE, "doc_id")} AS live_status, {sql_pick(LOCAL, "doc_id // 5")} AS local_status,
    n_chars::DOUBLE AS duration_sec, 'raw/' || source || '/' || doc_id || '/source.mp4' AS local_path, strlen(text)::BIGINT AS file_size_bytes, sha256(text) AS sha256, nullif(doc_id // 45 % 3, 2) AS capture_complete, doc_id % 4 AS retry_count FROM documents)"""


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as jobs: each user is an item, and of an item's jobs only the last may be active."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    last = e.groupBy(F.col("user_id").alias("_u")).agg(F.max("event_id").alias("_last"))
    state = pick(JOB_STATES, F.col("user_id"))
    rows = e.join(last, F.col("user_id") == F.col("_u"))
    return rows.select(
        i.cast("bigint").alias("id"), F.col("user_id").cast("string").alias("video_id"), pick(KINDS, i).alias("job_type"), F.when(i == F.col("_last"), state).otherwise(F.lit("DONE")).alias("status"), F.when(i % 2 == 0, "watcher").otherwise("manual").alias("origin"),
        (i % 3).cast("int").alias("attempts"), F.col("ts").cast("timestamp").alias("available_at"), F.lit(None).cast("string").alias("last_error"), F.col("ts").cast("timestamp").alias("created_at"), F.col("ts").cast("timestamp").alias("updated_at"),
    )


JOBS = f"""jobs AS (SELECT event_id AS id, user_id::VARCHAR AS video_id, {sql_pick(KINDS, "event_id")} AS job_type, CASE WHEN event_id = max(event_id) OVER (PARTITION BY user_id) THEN {sql_pick(JOB_STATES, "user_id")} ELSE 'DONE' END AS status,
    CASE WHEN event_id % 2 = 0 THEN 'watcher' ELSE 'manual' END AS origin, event_id % 3 AS attempts, ts AS available_at FROM events),
    last AS (SELECT video_id, arg_max(job_type, id) AS last_type, bool_or(status IN ('QUEUED', 'RUNNING')) AS active FROM jobs GROUP BY video_id)"""

#: The job an item calls for, and where an item may be queued from.
DESIRED = """CASE WHEN local_status IN ('QUEUED', 'DOWNLOADING', 'RECORDING', 'VALIDATING') OR live_status = 'is_upcoming' THEN NULL WHEN live_status = 'is_live' THEN CASE WHEN local_status != 'COMPLETED' THEN 'LIVE_RECORD' END
    WHEN live_status = 'was_live' AND capture_complete = 0 THEN 'REPLAY_RECOVERY' WHEN live_status = 'was_live' THEN CASE WHEN local_status != 'COMPLETED' THEN 'REPLAY_RECOVERY' END WHEN live_status = 'not_live' AND local_status != 'COMPLETED' THEN 'VOD_DOWNLOAD' END"""
MAY_QUEUE = "local_status IN ('DISCOVERED', 'WAITING', 'QUEUED', 'COMPLETED', 'FAILED', 'RETRY')"


#: The pool's candidates in SQL: signs of embeddings as signatures, components as features.
_POOL = (
    SIGNATURES
    + ", feat AS (SELECT vec_id, "
    + ", ".join(f"round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, (embedding[{i + 1}]::DOUBLE + 1) / 2)), 6) AS f{i}" for i in range(7))
    + " FROM embeddings), med AS (SELECT "
    + ", ".join(f"median(f{i}) AS m{i}" for i in range(7))
    + " FROM feat), spr AS (SELECT "
    + ", ".join(f"greatest(quantile_cont(abs(f{i} - m{i}), 0.75::DOUBLE), 0.05::DOUBLE) AS s{i}" for i in range(7))
    + " FROM feat, med), scored AS (SELECT s.*, "
    + ", ".join(f"f{i}" for i in range(7))
    + ", round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.42::DOUBLE * f0 + 0.28::DOUBLE * f1 + 0.18::DOUBLE * (("
    + " + ".join(f"least(abs(f{i} - m{i}) / (2.5::DOUBLE * s{i}), 1.0::DOUBLE)" for i in range(7))
    + """) / 7) + 0.12::DOUBLE * f2)), 6) AS score, vec_id % 3 = 0 AS hard, vec_id % 3 AS lev FROM signatures s JOIN feat USING (vec_id), med, spr),
    n AS (SELECT source_id, count(*) AS n FROM scored GROUP BY source_id), b AS (SELECT *, least(n, 5) AS f, least(n, 55) AS m FROM n), seats AS (SELECT source_id, n, unnest(range(f, m)) AS k FROM b),
    places AS (SELECT *, row_number() OVER (ORDER BY sqrt(n) / (k + 1) DESC, source_id DESC) AS r FROM seats), more AS (SELECT source_id, count(*) AS more FROM places WHERE r <= (SELECT 110 - sum(f) FROM b) GROUP BY source_id),
    quotas AS (SELECT source_id, f + coalesce(more, 0) AS quota, row_number() OVER (ORDER BY source_id) AS place FROM b LEFT JOIN more USING (source_id))"""
)

#: One step of the recursion is one choice: of the first phase that is short and has candidates, those not redundant first, the one of most use.
CHOICES = (
    f"WITH RECURSIVE {_POOL}, st AS (SELECT 0 AS step, s.clip_id, s.source_id, bits, start_sec, end_sec, "
    + ", ".join(f"f{i}" for i in range(7))
    + """, score, hard, lev, quota, place, false AS taken, NULL::BIGINT AS pick, 'infinity'::DOUBLE AS novelty, 0.0::DOUBLE AS sim, false AS beside, false AS redundant FROM scored s JOIN quotas q USING (source_id)
    UNION ALL SELECT step + 1, clip_id, source_id, bits, start_sec, end_sec, """
    + ", ".join(f"f{i}" for i in range(7))
    + """, score, hard, lev, quota, place, taken OR clip_id = p_id, CASE WHEN clip_id = p_id THEN step + 1 ELSE pick END, least(novelty, sqrt(("""
    + " + ".join(f"(f{i} - p_f{i}) * (f{i} - p_f{i})" for i in range(7))
    + """) / 7)), greatest(sim, alike), beside OR next_to, redundant OR (source_id = p_source AND alike >= 0.95::DOUBLE) OR (next_to AND alike >= 0.86::DOUBLE)
    FROM (SELECT *, 1 - bit_count(xor(bits, p_bits)) / 64.0::DOUBLE AS alike, source_id = p_source AND greatest(0.0::DOUBLE, greatest(start_sec, p_start) - least(end_sec, p_end)) <= 11.0::DOUBLE AS next_to
    FROM (SELECT *, first_value(clip_id) OVER w AS p_id, first_value(source_id) OVER w AS p_source, first_value(bits) OVER w AS p_bits, first_value(start_sec) OVER w AS p_start, first_value(end_sec) OVER w AS p_end, """
    + ", ".join(f"first_value(f{i}) OVER w AS p_f{i}" for i in range(7))
    + """ FROM (SELECT *, CASE WHEN step = 0 THEN score ELSE 0.68::DOUBLE * score + 0.24::DOUBLE * novelty + 0.08::DOUBLE * (1 - sim) - 0.08::DOUBLE * beside::INT END AS worth,
        CASE WHEN taken OR have >= quota THEN NULL WHEN hard AND hard_have < least(25, hard_all) THEN 1 WHEN NOT hard AND soft_have < least(25, soft_all) THEN 2 WHEN lev = 0 AND low_have < least(18, low_all) THEN 3 WHEN lev = 1 AND mid_have < least(30, mid_all) THEN 4
            WHEN lev = 2 AND high_have < least(18, high_all) THEN 5 ELSE 5 + place END AS phase
        FROM (SELECT *, count(*) FILTER (taken) OVER (PARTITION BY source_id) AS have, count(*) FILTER (taken) OVER () AS all_have, """
    + ", ".join(f"count(*) FILTER ({c}) OVER () AS {k}_all, count(*) FILTER (taken AND {c}) OVER () AS {k}_have" for k, c in (("hard", "hard"), ("soft", "NOT hard"), ("low", "lev = 0"), ("mid", "lev = 1"), ("high", "lev = 2")))
    + """ FROM st) WHERE all_have < 110) WINDOW w AS (ORDER BY phase NULLS LAST, redundant, worth DESC, clip_id)))), chosen AS (SELECT * FROM st WHERE step = (SELECT max(step) FROM st))"""
)
