"""Retries by timers, over restarts of the stream, and the state machine as a stream."""

import json
import time
from datetime import datetime, timedelta

import pytest

from reelmill.streaming import retries, watcher

START = datetime(2030, 1, 1)


@pytest.fixture
def timers(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(key)


class Run:
    """A stream that is started anew for each file it is given."""

    def __init__(self, spark, folder, schema, make):
        self.spark, self.folder, self.schema, self.make, self.n = spark, folder, schema, make, 0
        (folder / "in").mkdir()

    def __call__(self, *rows):
        (self.folder / "in" / f"{self.n:03}.json").write_text("\n".join(json.dumps(r) for r in rows))
        self.n += 1
        got = []
        stream = self.make(self.spark.readStream.schema(self.schema).json(str(self.folder / "in")))
        keep = lambda df, _: got.extend(df.collect())
        stream.writeStream.foreachBatch(keep).outputMode("append").option("checkpointLocation", str(self.folder / "check")).trigger(availableNow=True).start().awaitTermination()
        return got


def outcome(video, job, sec, error):
    return {"video_id": video, "job_id": job, "at": (START + timedelta(seconds=sec)).isoformat(), "error": error}


def events(rows):
    return sorted((r.video_id, r.job_id, r.event, r.attempts, None if r.due is None else (r.due - START).total_seconds()) for r in rows)


def test_a_failed_job_comes_back_when_it_is_due(spark, tmp_path, timers):
    run = Run(spark, tmp_path, retries.OUTCOMES, lambda rows: retries.retry_events(rows, 3, 60, by_event_time=True))
    tick = lambda sec: outcome("clock", None, sec, None)
    assert events(run(outcome("a", 1, 0, "no network"), outcome("b", 2, 5, "no network"), outcome("c", 3, 6, None))) == [("a", 1, "WAITING", 1, 60.0), ("b", 2, "WAITING", 1, 65.0), ("c", 3, "DONE", 0, None)]
    assert events(run(tick(30))) == []  # the stream was started anew between failure and due time; nothing is due yet
    assert events(run(outcome("b", 4, 40, None))) == [("b", 4, "DONE", 0, None)]
    assert events(run(tick(120))) == [("a", 1, "DUE", 1, 60.0)]  # and of b, which was done meanwhile, nothing
    assert events(run(outcome("a", 5, 130, "no network"))) == [("a", 5, "WAITING", 2, 190.0)]
    assert events(run(tick(300))) == [("a", 5, "DUE", 2, 190.0)]
    assert events(run(outcome("a", 6, 310, "no network"))) == [("a", 6, "FAILED", 3, None)]
    assert events(run(tick(900))) == []
    assert events(run(outcome("b", 7, 910, "x"), {"video_id": None, "job_id": 8, "at": START.isoformat(), "error": "x"})) == [("b", 7, "WAITING", 1, 970.0)]


def test_timers_by_the_clock(spark, tmp_path, timers):
    """Such a stream goes on, since time does; it is stopped once it has told what it should."""
    (tmp_path / "in").mkdir()
    got = []

    def until(kind):
        stream = retries.retry_events(spark.readStream.schema(retries.OUTCOMES).json(str(tmp_path / "in")), 2, 1.0)
        query = stream.writeStream.foreachBatch(lambda df, _: got.extend(df.collect())).outputMode("append").option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="500 milliseconds").start()
        end = time.time() + 60
        while time.time() < end and kind not in [r.event for r in got]:
            time.sleep(0.2)
        query.stop()
        return list(dict.fromkeys((r.video_id, r.event, r.attempts) for r in got))  # a batch that was stopped is told again

    (tmp_path / "in" / "0.json").write_text(json.dumps(outcome("a", 1, (datetime.now() - START).total_seconds(), "no network")))
    assert until("WAITING")[0] == ("a", "WAITING", 1)
    (tmp_path / "in" / "tick.json").write_text(json.dumps(outcome("clock", None, 0, None)))  # the first row after the restart
    assert until("DUE") == [("a", "WAITING", 1), ("a", "DUE", 1)]
    (tmp_path / "in" / "1.json").write_text(json.dumps(outcome("a", 2, (datetime.now() - START).total_seconds(), "no network")))
    assert until("FAILED")[2:] == [("a", "FAILED", 2)]


def test_states_are_kept_over_batches(spark, tmp_path, timers):
    run = Run(spark, tmp_path, "video_id string, ordinal bigint, to string", watcher.follow_states)
    move = lambda v, i, to: {"video_id": v, "ordinal": i, "to": to}
    told = lambda rows: sorted((r.video_id, r.ordinal, r["from"], r.to, r.accepted) for r in rows)
    assert told(run(move("a", 2, "DOWNLOADING"), move("a", 1, "QUEUED"), move("b", 1, "COMPLETED"))) == [("a", 1, "DISCOVERED", "QUEUED", True), ("a", 2, "QUEUED", "DOWNLOADING", True), ("b", 1, "DISCOVERED", "COMPLETED", False)]
    assert told(run(move("a", 3, "VALIDATING"), move("a", 4, "QUEUED"), move("b", 2, "QUEUED"))) == [("a", 3, "DOWNLOADING", "VALIDATING", True), ("a", 4, "VALIDATING", "QUEUED", False), ("b", 2, "DISCOVERED", "QUEUED", True)]
