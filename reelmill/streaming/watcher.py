"""The acquisition loop as a stream: discoveries in, versioned catalog tables out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import scalars as S
from ..journal import journal
from ..operators import catalog
from ..settings import Acquisition
from ..sources.tables import normalized_items
from ..storage import discard, stash
from .store import Snapshots

DISCOVERIES = "id string, channel_id string, channel_name string, title string, live_status string, release_timestamp bigint, timestamp bigint, duration double, ordinal bigint"


def selected(items: DataFrame, config: Acquisition) -> DataFrame:
    """Items that their channel's policy takes; in mode ``all`` all of enabled channels."""
    on = [c for c in config.channels if c.enabled]
    if config.mode == "all":
        return items.filter(F.col("channel_id").isin([c.id for c in on] or [""]))
    keep = F.lit(False)
    for c in on:
        keep = keep | ((F.col("channel_id") == c.id) & S.title_policy("video_id", "title", "live_status", c.video_ids, c.title_keywords, c.live_keywords, c.vod_keywords))
    return items.filter(keep)


def may_match(raw: DataFrame, config: Acquisition) -> DataFrame:
    """Cheap first sieve on flat entries, before details are fetched."""
    if config.mode == "all":
        return raw
    keep = F.lit(False)
    for c in config.channels:
        keep = keep | ((F.col("channel_id") == c.id) & (F.col("id").isin(list(c.video_ids) or [""]) | S.any_keyword("title", (*c.title_keywords, *c.live_keywords, *c.vod_keywords))))
    return raw.filter(F.coalesce(keep, F.lit(False)))


def apply_selection(items: DataFrame, jobs: DataFrame, config: Acquisition, now: Column) -> tuple[DataFrame, DataFrame]:
    """The list of what may be taken, applied to what is known: queued watcher jobs of other items are cancelled. Mode ``all`` leaves everything."""
    if config.mode != "allowlist":
        return items, jobs
    named = [v for c in config.channels if c.enabled for v in c.video_ids]
    allowed = selected(items, config).select("video_id").unionByName(items.filter(F.col("video_id").isin(named or [""])).select("video_id"))
    return catalog.cancel_outside(items, jobs, allowed, now)


def resume(items: DataFrame, jobs: DataFrame, config: Acquisition, now: Column) -> tuple[DataFrame, DataFrame]:
    """The start of a watcher: what a crash left is recovered, the list applied, and items named by id (in mode ``all`` every item) are scheduled."""
    items, jobs = catalog.recover(items, jobs, now)
    items, jobs = apply_selection(items, jobs, config, now)
    mine = F.lit(False)
    for c in config.channels:
        if c.enabled:
            mine = mine | ((F.col("channel_id") == c.id) & (F.lit(True) if config.mode == "all" else F.col("video_id").isin(list(c.video_ids) or [""])))
    return catalog.schedule(items, jobs, now, config.recovery_from_replay, only=items.filter(mine).select("video_id"))


def tick(items: DataFrame, jobs: DataFrame, raw: DataFrame, config: Acquisition, now: Column, limit: int | None = None, dispatch: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, jobs, dead letters) after one batch: the list is applied, then entries are sieved, normalised, selected, folded, upserted and scheduled.

    Entries named by id come before those a search came upon, and of one id the first decides whether it is taken. A bad row
    is a dead letter and disturbs no other. Without ``dispatch`` items are stored, and jobs queued, all the same; it is the caller
    who claims them. ``limit`` bounds the items of a scan.
    """
    items, jobs = apply_selection(items, jobs, config, now)
    bad = raw.filter(~F.coalesce(F.col("id").rlike(S.VIDEO_ID), F.lit(False)))
    named = [v for c in config.channels for v in c.video_ids]
    is_named = F.col("id").isin(named or [""])
    sieved = raw.filter(is_named).unionByName(may_match(raw.filter(~is_named), config))
    found = selected(normalized_items(sieved), config)
    order = sieved.groupBy(F.col("id").alias("video_id")).agg(F.max("ordinal").alias("ordinal"))
    rows = found.join(order, "video_id")
    if limit is not None:
        one = catalog.explicit_then_found(rows.filter(F.col("video_id").isin(named or [""])), rows.filter(~F.col("video_id").isin(named or [""])))
        taken = catalog.scan_limit(one.select("video_id", "channel_id", "place"), [c.id for c in config.channels if c.enabled], limit)
        rows = rows.join(taken.select("video_id"), "video_id", "left_semi")
    batch = catalog.fold_batch(rows, ["ordinal"])
    items = catalog.upsert(items, batch, now)
    items, jobs = catalog.schedule(items, jobs, now, config.recovery_from_replay, only=batch.select("video_id"))
    return items, jobs, bad


#: Takes claimed jobs with their items, and returns (id, started_at, path, size, sha256, duration_sec, error), a row for each.
Provider = Callable[[DataFrame], DataFrame]


def work(store: Snapshots, provider: Provider, config: Acquisition, now: Column, workers: int = 4, video_id: str | None = None, origin: str | None = "watcher") -> int:
    """Claim as many due jobs as there are workers, have the provider do them, and store what came of each; returns how many were claimed.

    The claim is stored before the work begins, so that a crash leaves running jobs that ``recover`` finds. One job's
    failure is its own row and stops no other.
    """
    items, jobs = store.read()
    jobs, taken = catalog.claim(jobs, now, workers, video_id, origin)
    claimed = stash(taken, "claimed")
    n = claimed.count()
    if not n:
        return 0
    items, jobs = store.write(catalog.start_jobs(items, claimed, 0, now), jobs)
    files = stash(provider(claimed.join(items.select("video_id", "channel_id", "source_url"), "video_id")), "provided")
    fine = claimed.join(files.filter("error is null").select("id"), "id", "left_semi")
    items, jobs = store.write(catalog.start_jobs(items, fine, 1, now), jobs)
    store.write(*catalog.finish(items, jobs, stash(catalog.results(claimed, files, items), "outcomes"), now, config.max_attempts, config.retry_delay_sec))
    return n


def run_item(store: Snapshots, video_id: str, provider: Provider, config: Acquisition, clock: Callable[[], datetime], sleep: Callable[[float], None]) -> str:
    """Do one item's queued job, retries included, waiting until each is due; returns the item's state then."""
    while True:
        work(store, provider, config, F.lit(clock()).cast("timestamp"), 1, video_id, None)
        items, jobs = store.read()
        row = items.filter(F.col("video_id") == video_id).first()
        if row is None:
            raise KeyError(video_id)
        last = jobs.filter(F.col("video_id") == video_id).orderBy(F.desc("id")).first()
        if row.local_status in ("COMPLETED", "FAILED", "WAITING") or last is None or last.status != "QUEUED":
            return row.local_status
        due = jobs.filter(F.col("id") == last.id).select(F.unix_micros("available_at")).first()[0] / 1e6
        sleep(max(0.0, due - clock().replace(tzinfo=timezone.utc).timestamp()))


def watch(spark: SparkSession, source: str, root: str, checkpoint: str, config: Acquisition, now: datetime | None = None, once: bool = True, provider: Provider | None = None, workers: int = 4, limit: int | None = None) -> StreamingQuery:
    """Follow a folder of discovery logs. What a crash left is recovered first; a batch that comes again after a failure changes nothing a second time.

    Dead letters are written before the batch counts as done, under its number, so a failure between the two loses none.
    With a provider the due jobs are done after each batch, a pool's worth at a time.
    """
    store = Snapshots(spark, root)
    at = lambda: F.lit(now).cast("timestamp") if now else F.current_timestamp()
    store.write(*resume(*store.read(), config, at()))
    if provider is not None:
        while work(store, provider, config, at(), workers):
            pass

    def each(raw: DataFrame, batch: int) -> None:
        if batch <= store.last_batch:
            return
        rows = stash(raw, "batch")
        items, jobs, bad = tick(*store.read(), rows, config, at(), limit)
        if bad.limit(1).count():
            bad.write.mode("overwrite").json(f"{str(root).rstrip('/')}/dead/batch={batch}")
        store.write(items, jobs, batch)
        discard(rows)
        journal(action="CHANNEL_SCAN").info("batch %d stored", batch)
        if provider is not None:
            while work(store, provider, config, at(), workers):
                pass

    stream = spark.readStream.schema(DISCOVERIES).json(source)
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{config.poll_interval_sec} seconds")
    return writer.start()


class StateMachine(StatefulProcessor):
    """Per item, its state; a transition that the table doesn't allow is reported and changes nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "state string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timer_values: Any) -> Iterator[pd.DataFrame]:
        now = self.state.get()[0] if self.state.exists() else "DISCOVERED"
        out = []
        # Rows of a batch come in any order.
        for r in sorted((r for pdf in rows for r in pdf.itertuples()), key=lambda r: r.ordinal):
            ok = r.to == now or r.to in catalog.TRANSITIONS.get(now, ())
            out.append((key[0], int(r.ordinal), now, r.to, bool(ok)))
            now = r.to if ok else now
        self.state.update((now,))
        yield pd.DataFrame(out, columns=["video_id", "ordinal", "from", "to", "accepted"])

    def close(self) -> None:
        pass


def follow_states(moves: DataFrame) -> DataFrame:
    """A stream of (video_id, ordinal, to) with each move's outcome; state is kept per item across batches."""
    return moves.groupBy("video_id").transformWithStateInPandas(StateMachine(), outputStructType="video_id string, ordinal long, from string, to string, accepted boolean", outputMode="append", timeMode="none")
