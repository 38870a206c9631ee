"""The catalog of items and their jobs: each step is a function from tables to tables; ``now`` is passed in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import with_previous

# ---- fixed values: states and the moves between them ------------------------------------------------------------
BUSY = ("QUEUED", "DOWNLOADING", "RECORDING", "VALIDATING")
IN_FLIGHT = ("DOWNLOADING", "RECORDING", "VALIDATING")
TRANSITIONS = {
    "DISCOVERED": ("WAITING", "QUEUED", "FAILED"),
    "WAITING": ("QUEUED", "RECORDING", "RETRY", "FAILED"),
    "QUEUED": ("DOWNLOADING", "RECORDING", "RETRY", "FAILED"),
    "DOWNLOADING": ("VALIDATING", "RETRY", "FAILED"),
    "RECORDING": ("VALIDATING", "RETRY", "FAILED"),
    "VALIDATING": ("COMPLETED", "RETRY", "FAILED"),
    "COMPLETED": ("QUEUED",),
    "FAILED": ("RETRY", "QUEUED"),
    "RETRY": ("QUEUED", "WAITING", "FAILED"),
}
ITEMS = (
    "video_id string, channel_id string, channel_name string, title string, source_url string, item_type string, live_status string, local_status string, "
    "scheduled_start string, actual_start string, duration_sec double, local_path string, file_size_bytes bigint, sha256 string, capture_source string, "
    "capture_complete int, retry_count int, last_error string, discovered_at timestamp, updated_at timestamp"
)
JOBS = "id bigint, video_id string, job_type string, status string, origin string, attempts int, available_at timestamp, last_error string, created_at timestamp, updated_at timestamp"
MUTABLE = ("actual_start", "duration_sec", "capture_complete", "capture_source", "last_error", "retry_count")


def can_move(old: Column, new: Column) -> Column:
    """A state may stay, or go where the table says."""
    ok = old == new
    for a, to in TRANSITIONS.items():
        ok = ok | ((old == a) & new.isin(*to))
    return F.coalesce(ok, F.lit(False))


def fold_batch(discoveries: DataFrame, order: list[str]) -> DataFrame:
    """One row per item of a batch, as if its rows had been applied one after another: the last value that isn't empty.

    ``unknown`` never replaces a live status. The first row decides what an upsert doesn't touch.
    """
    o = F.struct(*order)
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c)
    known = F.when(F.col("live_status") != "unknown", F.col("live_status"))
    return discoveries.groupBy("video_id").agg(
        *[F.min_by(F.col(c), o).alias(c) for c in ("channel_id", "source_url", "item_type")],
        *[last(c) for c in ("channel_name", "title", "scheduled_start", "actual_start", "duration_sec")],
        F.coalesce(F.max_by(known, F.when(known.isNotNull(), o)), F.lit("unknown")).alias("live_status"),
    )


def upsert(items: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """The catalog after a folded batch: new items are DISCOVERED; known ones take new values where there are any."""
    old, new = items.alias("o"), batch.alias("n")
    o, n = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    fresh, touched = o("video_id").isNull(), n("video_id").isNotNull()
    kinds = dict(items.dtypes)
    out = []
    for c in items.columns:
        if c == "video_id":
            v = F.coalesce(o(c), n(c))
        elif c in ("channel_name", "title", "scheduled_start", "actual_start", "duration_sec"):
            v = F.coalesce(n(c), o(c))
        elif c == "live_status":
            v = F.when(touched & (fresh | (n(c) != "unknown")), n(c)).otherwise(o(c))
        elif c in ("channel_id", "source_url", "item_type"):
            v = F.when(fresh, n(c)).otherwise(o(c))
        elif c == "local_status":
            v = F.when(fresh, F.lit("DISCOVERED")).otherwise(o(c))
        elif c == "discovered_at":
            v = F.when(fresh, now).otherwise(o(c))
        elif c == "updated_at":
            v = F.when(touched, now).otherwise(o(c))
        elif c == "retry_count":
            v = F.when(fresh, F.lit(0)).otherwise(o(c))
        else:
            v = o(c)
        out.append(v.cast(kinds[c]).alias(c))
    return old.join(new, o("video_id") == n("video_id"), "full_outer").select(*out)


def desired_job(recovery_from_replay: bool = True) -> Column:
    """The job an item calls for, or NULL. An unknown completeness is not an incomplete one."""
    live, local = F.col("live_status"), F.col("local_status")
    done = local == "COMPLETED"
    replay, vod, none = F.lit("REPLAY_RECOVERY"), F.lit("VOD_DOWNLOAD"), F.lit(None).cast("string")
    return (
        F.when(local.isin(*BUSY) | (live == "is_upcoming"), none)
        .when(live == "is_live", F.when(~done, F.lit("LIVE_RECORD")))
        .when((live == "was_live") & F.lit(recovery_from_replay) & F.coalesce(F.col("capture_complete") == 0, F.lit(False)), replay)
        .when(live == "was_live", F.when(~done, replay if recovery_from_replay else vod))
        .when((live == "not_live") & ~done, vod)
    )


def latest_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("video_id").agg(F.max_by(F.struct(*[c for c in jobs.columns if c != "video_id"]), "id").alias("j")).select("video_id", "j.*")


def active(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.col("status").isin("QUEUED", "RUNNING"))


def _numbered(rows: DataFrame, jobs: DataFrame) -> DataFrame:
    """New jobs with ids that go on from the largest: numbered within ranges of the item's id and shifted, so no task sees all of them."""
    from .ranking import ranked

    start = jobs.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_max"))
    return ranked(rows, ["video_id"], "_k").crossJoin(F.broadcast(start)).withColumn("id", F.col("_max") + F.col("_k")).drop("_k", "_max")  # one row


def enqueue(items: DataFrame, jobs: DataFrame, wanted: DataFrame, now: Column, origin: str = "watcher", available_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, jobs) with a job of the wanted kind (video_id, job_type) for each item that may have one.

    An item with an active job, a completed one (unless its replay is wanted), and one that may not move to QUEUED are left as
    they are. Another kind of job than the last starts its count of retries again. An unknown item or origin is an error.
    """
    if origin not in ("watcher", "manual"):
        raise ValueError("unknown origin")
    if wanted.join(items, "video_id", "left_anti").limit(1).count():
        raise KeyError("unknown item")
    kinds = dict(items.dtypes)
    want = wanted.dropDuplicates(["video_id"]).select("video_id", F.col("job_type").alias("_want"))
    last = latest_jobs(jobs).select("video_id", F.col("job_type").alias("_last"))
    busy = active(jobs).select("video_id", F.lit(True).alias("_active")).distinct()
    rows = items.join(want, "video_id", "left").join(last, "video_id", "left").join(busy, "video_id", "left")
    local = F.col("local_status")
    go = F.col("_want").isNotNull() & F.col("_active").isNull() & ((local != "COMPLETED") | (F.col("_want") == "REPLAY_RECOVERY")) & can_move(local, F.lit("QUEUED"))
    rows = rows.withColumn("_go", F.coalesce(go, F.lit(False)))
    new_items = rows.withColumns(
        {
            "retry_count": F.when(F.col("_go") & F.col("_last").isNotNull() & (F.col("_last") != F.col("_want")), F.lit(0)).otherwise(F.col("retry_count")).cast(kinds["retry_count"]),
            "updated_at": F.when(F.col("_go"), now).otherwise(F.col("updated_at")),
            "local_status": F.when(F.col("_go"), "QUEUED").otherwise(local),
        }
    ).select(*items.columns)
    made = _numbered(rows.filter("_go").select("video_id", "_want"), jobs).select(
        "id", "video_id", F.col("_want").alias("job_type"), F.lit("QUEUED").alias("status"), F.lit(origin).alias("origin"), F.lit(0).alias("attempts"), (available_at if available_at is not None else now).alias("available_at"), F.lit(None).cast("string").alias("last_error"), now.alias("created_at"), now.alias("updated_at")
    )
    return new_items, jobs.unionByName(made)


def schedule(items: DataFrame, jobs: DataFrame, now: Column, recovery_from_replay: bool = True, origin: str = "watcher", only: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, jobs) with what can be queued queued: upcoming items that were just discovered wait, failed ones come back only for a replay that wasn't their last job.

    ``only`` has the video_id of the items to look at; without it all are.
    """
    mine = items if only is None else items.join(only.select("video_id").distinct(), "video_id", "left_semi")
    last = latest_jobs(jobs).select("video_id", F.col("job_type").alias("_last"))
    rows = mine.withColumn("job_type", desired_job(recovery_from_replay)).join(last, "video_id", "left")
    wait = (F.col("live_status") == "is_upcoming") & (F.col("local_status") == "DISCOVERED")
    comes_back = (F.col("local_status") != "FAILED") | ((F.col("job_type") == "REPLAY_RECOVERY") & ~F.col("_last").eqNullSafe(F.col("job_type")))
    wanted = rows.filter(F.col("job_type").isNotNull() & comes_back).select("video_id", "job_type")
    waiting = rows.filter(wait).select("video_id", F.lit(True).alias("_wait"))
    rows = items.join(waiting, "video_id", "left").withColumns({"updated_at": F.when(F.col("_wait"), now).otherwise(F.col("updated_at")), "local_status": F.when(F.col("_wait"), "WAITING").otherwise(F.col("local_status"))})
    return enqueue(rows.select(*items.columns), jobs, wanted, now, origin)


def claim(jobs: DataFrame, now: Column, workers: int = 1, video_id: str | None = None, origin: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(jobs after the claim, the claimed ones): the queued and due jobs with the smallest ids, as many as workers are free."""
    due = jobs.filter((F.col("status") == "QUEUED") & (F.col("available_at") <= now))
    if video_id is not None:
        due = due.filter(F.col("video_id") == video_id)
    if origin is not None:
        due = due.filter(F.col("origin") == origin)
    taken = due.orderBy("id").limit(workers)
    after = jobs.join(F.broadcast(taken.select("id", F.lit(True).alias("_t"))), "id", "left")  # as many rows as workers
    hit = F.col("_t").isNotNull()
    after = after.withColumns({"status": F.when(hit, "RUNNING").otherwise(F.col("status")), "attempts": F.col("attempts") + F.when(hit, 1).otherwise(0), "updated_at": F.when(hit, now).otherwise(F.col("updated_at"))})
    return after.select(*jobs.columns), taken


def cancel_outside(items: DataFrame, jobs: DataFrame, allowed: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Queued watcher jobs of items off the list are cancelled, and those items, if still queued, are as just discovered."""
    gone = jobs.filter("status = 'QUEUED' and origin = 'watcher'").join(allowed.select("video_id"), "video_id", "left_anti")
    hit = gone.select("id", F.lit(True).alias("_t"))
    new_jobs = jobs.join(hit, "id", "left").withColumns({"status": F.when(F.col("_t"), "CANCELLED").otherwise(F.col("status")), "updated_at": F.when(F.col("_t"), now).otherwise(F.col("updated_at"))}).select(*jobs.columns)
    of = gone.select("video_id", F.lit(True).alias("_t")).distinct()
    back = F.coalesce(F.col("_t") & (F.col("local_status") == "QUEUED"), F.lit(False))
    new_items = items.join(of, "video_id", "left").withColumns({"updated_at": F.when(back, now).otherwise(F.col("updated_at")), "local_status": F.when(back, "DISCOVERED").otherwise(F.col("local_status"))}).select(*items.columns)
    return new_items, new_jobs


def finish(items: DataFrame, jobs: DataFrame, outcomes: DataFrame, now: Column, max_attempts: int = 3, retry_delay_sec: int = 60) -> tuple[DataFrame, DataFrame]:
    """Apply job outcomes (id, video_id, error, path, size, sha256, duration_sec, source, complete).

    A success completes an item that is VALIDATING; anything else is an error of the caller. A failure counts, and goes
    back into the queue after a delay until the attempts are used up.
    """
    bad = outcomes.filter("error is null").join(items.filter("local_status != 'VALIDATING'"), "video_id", "left_semi")
    if bad.limit(1).count():
        raise ValueError("an item must be VALIDATING before completion")
    out = outcomes.select(F.col("id").alias("_job"), F.col("video_id").alias("_v"), "error", F.col("path").alias("_path"), F.col("size").alias("_size"), F.col("sha256").alias("_sha"), F.col("duration_sec").alias("_dur"), F.col("source").alias("_src"), F.col("complete").alias("_complete"))
    kinds = dict(items.dtypes)
    rows = items.join(out, F.col("video_id") == F.col("_v"), "left")
    ok, failed = F.col("_v").isNotNull() & F.col("error").isNull(), F.col("error").isNotNull()
    again = failed & (F.coalesce("retry_count", F.lit(0)) + 1 < max_attempts)
    values = {
        "local_status": F.when(ok, "COMPLETED").when(again, "QUEUED").when(failed, "FAILED").otherwise(F.col("local_status")),
        "local_path": F.when(ok, F.col("_path")).otherwise(F.col("local_path")),
        "file_size_bytes": F.when(ok, F.col("_size")).otherwise(F.col("file_size_bytes")),
        "sha256": F.when(ok, F.col("_sha")).otherwise(F.col("sha256")),
        "duration_sec": F.when(ok, F.coalesce("_dur", "duration_sec")).otherwise(F.col("duration_sec")),
        "capture_source": F.when(ok, F.col("_src")).otherwise(F.col("capture_source")),
        "capture_complete": F.when(ok, F.col("_complete").cast("int")).otherwise(F.col("capture_complete")),
        "retry_count": F.coalesce("retry_count", F.lit(0)) + F.when(failed, 1).otherwise(0),
        "last_error": F.when(ok, F.lit(None)).when(failed, F.substring("error", 1, 2000)).otherwise(F.col("last_error")),
        "updated_at": F.when(F.col("_v").isNotNull(), now).otherwise(F.col("updated_at")),
    }
    new_items = rows.withColumns({k: v.cast(kinds[k]) for k, v in values.items()}).select(*items.columns)
    retries = rows.filter(again).select("_job", F.lit(True).alias("_again"))
    done = out.select("_job", F.col("error").alias("_error")).join(retries, "_job", "left")
    j = jobs.join(done, F.col("id") == F.col("_job"), "left")
    hit = F.col("_job").isNotNull()
    new_jobs = j.withColumns(
        {
            "status": F.when(F.col("_again"), "QUEUED").when(hit & F.col("_error").isNotNull(), "FAILED").when(hit, "DONE").otherwise(F.col("status")),
            "available_at": F.when(F.col("_again"), now + F.make_dt_interval(secs=F.lit(retry_delay_sec))).otherwise(F.col("available_at")),
            "last_error": F.when(hit, F.col("_error")).otherwise(F.col("last_error")),
            "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
        }
    ).select(*jobs.columns)
    return new_items, new_jobs


def recover(items: DataFrame, jobs: DataFrame, now: Column, video_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """After a crash: running jobs are queued again; items under way follow their job, or wait for a retry without one."""
    mine = F.lit(True) if video_id is None else F.col("video_id") == video_id
    run = (F.col("status") == "RUNNING") & mine
    new_jobs = jobs.withColumns({"updated_at": F.when(run, now).otherwise(F.col("updated_at")), "status": F.when(run, "QUEUED").otherwise(F.col("status"))})
    state = new_jobs.groupBy("video_id").agg(F.max((F.col("status") == "QUEUED").cast("int")).alias("_q"), F.max(F.col("status").isin("QUEUED", "RUNNING").cast("int")).alias("_a"))
    rows = items.join(state, "video_id", "left")
    flight = F.col("local_status").isin(*IN_FLIGHT) & mine
    to = F.when(flight & (F.col("_q") == 1), "QUEUED").when(flight & (F.coalesce("_a", F.lit(0)) == 0), "RETRY")
    return rows.withColumns({"updated_at": F.when(to.isNotNull(), now).otherwise(F.col("updated_at")), "local_status": F.coalesce(to, F.col("local_status"))}).select(*items.columns), new_jobs


def set_fields(items: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """Set the fields that ``changes`` has, besides the id; only those that may be changed."""
    names = [c for c in changes.columns if c != "video_id"]
    if not set(names) <= set(MUTABLE):
        raise ValueError("unsupported catalog field")
    kinds = dict(items.dtypes)
    new = changes.select(F.col("video_id").alias("_v"), *[F.col(c).alias(f"_{c}") for c in names])
    hit = F.col("_v").isNotNull()
    return items.join(new, F.col("video_id") == F.col("_v"), "left").withColumns({c: F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)).cast(kinds[c]) for c in names} | {"updated_at": F.when(hit, now).otherwise(F.col("updated_at"))}).select(*items.columns)


def move(items: DataFrame, moves: DataFrame, now: Column) -> DataFrame:
    """Change local states by (video_id, to); a move the table doesn't allow, or an unknown item, is an error."""
    rows = items.join(moves.select(F.col("video_id").alias("_v"), F.col("to").alias("_to")), F.col("video_id") == F.col("_v"), "full_outer")
    if rows.filter(F.col("_v").isNotNull() & (F.col("video_id").isNull() | ~can_move(F.col("local_status"), F.col("_to")))).limit(1).count():
        raise ValueError("unknown item or forbidden transition")
    return rows.withColumns({"updated_at": F.when(F.col("_v").isNotNull(), now).otherwise(F.col("updated_at")), "local_status": F.coalesce("_to", "local_status")}).select(*items.columns)


def illegal_moves(log: DataFrame, key: str, order: list[str], state: str) -> DataFrame:
    """Rows of a state log whose step from the row before the table doesn't allow."""
    return with_previous(log, key, order, state, "previous_state").filter(F.col("previous_state").isNotNull() & ~can_move(F.col("previous_state"), F.col(state)))


def broken_uniqueness(jobs: DataFrame) -> DataFrame:
    """Items with more than one active job: there must be none."""
    return active(jobs).groupBy("video_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def list_items(items: DataFrame, local_status: str | None = None, live_status: str | None = None) -> DataFrame:
    out = items
    if local_status:
        out = out.filter(F.col("local_status") == local_status)
    if live_status:
        out = out.filter(F.col("live_status") == live_status)
    return out.orderBy(F.desc("discovered_at"))


def request_outcomes(requests: DataFrame, items: DataFrame, enabled_channels: int) -> DataFrame:
    """What a manual request (video_id, channel_hint) for each item comes to: ``failed`` where no channel follows or another one is named than the item's,
    ``skipped`` where it is complete, ``waiting`` where it is upcoming, ``retried`` where it had failed, else ``queued``."""
    known = items.select("video_id", F.col("channel_id").alias("_c"), "local_status", "live_status", "capture_complete")
    rows = requests.dropDuplicates(["video_id"]).join(known, "video_id", "left")
    channel = F.coalesce("channel_hint", "_c", F.when(F.lit(enabled_channels == 1), F.lit("only")))
    return rows.select(
        "video_id",
        F.when(channel.isNull() | (F.col("_c") != channel), "failed")
        .when((F.col("local_status") == "COMPLETED") & (F.col("capture_complete") == 1), "skipped")
        .when(F.col("live_status") == "is_upcoming", "waiting")
        .when(F.col("local_status") == "FAILED", "retried")
        .otherwise("queued")
        .alias("outcome"),
    )


def request(items: DataFrame, jobs: DataFrame, requests: DataFrame, now: Column, enabled_channels: int, recovery_from_replay: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, jobs, outcomes) after manual requests: failed items go to RETRY with their count reset, then what can be queued is, under the origin ``manual``.

    Items have to be in the catalog; what isn't there yet is upserted from its metadata first.
    """
    outcomes = request_outcomes(requests, items, enabled_channels)
    taken = outcomes.filter("outcome in ('queued', 'retried', 'waiting')").join(items.select("video_id"), "video_id", "left_semi")
    kinds = dict(items.dtypes)
    hit = taken.select("video_id", F.lit(True).alias("_t"))
    again = F.coalesce(F.col("_t") & (F.col("local_status") == "FAILED"), F.lit(False))
    rows = items.join(hit, "video_id", "left").withColumns({"retry_count": F.when(again, 0).otherwise(F.col("retry_count")).cast(kinds["retry_count"]), "updated_at": F.when(again, now).otherwise(F.col("updated_at")), "local_status": F.when(again, "RETRY").otherwise(F.col("local_status"))})
    new_items, new_jobs = schedule(rows.select(*items.columns), jobs, now, recovery_from_replay, "manual", taken)
    return new_items, new_jobs, outcomes


def explicit_then_found(explicit: DataFrame, found: DataFrame, order: str = "ordinal") -> DataFrame:
    """Items named by id, then those a search came upon; of one id the first counts. ``place`` tells the order."""
    rows = explicit.withColumn("_part", F.lit(0)).unionByName(found.withColumn("_part", F.lit(1)))
    place = F.struct("_part", order)
    first = rows.groupBy("video_id").agg(F.min_by(F.struct(*rows.columns), place).alias("r"))
    return first.select("r.*").withColumn("place", F.struct("_part", order)).drop("_part")


def scan_limit(found: DataFrame, channels: list[str], limit: int | None, order: str = "place") -> DataFrame:
    """The items a scan gets to: it stops within a channel once ``limit`` items are done, and a later channel still takes one, since the count is looked at after an item.

    Channels are few and their counts are one row each.
    """
    if limit is None:
        return found
    n = {r[0]: r[1] for r in found.groupBy("channel_id").agg(F.count(F.lit(1))).collect() if r[0] in channels}
    take, done = {}, 0
    for c in channels:
        take[c] = min(n.get(c, 0), max(1, limit - done))
        done += take[c]
    out = None
    for c in channels:
        rows = found.filter(F.col("channel_id") == c).orderBy(order).limit(take[c])
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else found.limit(0)


#: What a worker goes through with a claimed job, and the state that stands for each step. Fixed values.
STAGES = {"LIVE_RECORD": ("RECORDING", "VALIDATING"), "REPLAY_RECOVERY": ("DOWNLOADING", "VALIDATING"), "VOD_DOWNLOAD": ("DOWNLOADING", "VALIDATING")}
CAPTURE_SOURCE = {"LIVE_RECORD": "live_record", "REPLAY_RECOVERY": "replay_recovery", "VOD_DOWNLOAD": "vod_download"}


def start_jobs(items: DataFrame, claimed: DataFrame, step: int, now: Column) -> DataFrame:
    """Items of claimed jobs in the state of a step of their kind of job: 0 under way, 1 being validated."""
    states = F.create_map(*[F.lit(x) for k, v in STAGES.items() for x in (k, v[step])])
    return move(items, claimed.select("video_id", states[F.col("job_type")].alias("to")), now)


def results(claimed: DataFrame, files: DataFrame, items: DataFrame) -> DataFrame:
    """Outcomes of claimed jobs from what a provider left (id, started_at, path, size, sha256, duration_sec, error): a live
    recording is complete if it began at most some seconds after the broadcast, anything else always is."""
    from ..functions import scalars as S

    rows = claimed.select("id", "video_id", "job_type").join(files, "id").join(items.select("video_id", "actual_start"), "video_id", "left")
    source = F.create_map(*[F.lit(x) for k, v in CAPTURE_SOURCE.items() for x in (k, v)])
    complete = (F.col("job_type") != "LIVE_RECORD") | S.capture_complete("started_at", "actual_start")
    return rows.select("id", "video_id", "error", "path", "size", "sha256", "duration_sec", source[F.col("job_type")].alias("source"), complete.alias("complete"))
