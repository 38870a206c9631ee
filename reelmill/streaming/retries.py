"""Failed jobs that come back when they are due, by timers: no scan over all jobs asks which of them are."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTCOMES = "video_id string, job_id bigint, at timestamp, error string"
EVENTS = "video_id string, job_id bigint, event string, attempts int, due timestamp"


class RetryTimers(StatefulProcessor):
    """Of each item how often it failed, and what is due when; both outlive a restart of the stream.

    A failure is WAITING for its delay, with a timer, or FAILED where the attempts are used up. When its timer expires, a job
    is DUE. A success is DONE and takes the item's count and timers with it.
    """

    def __init__(self, max_attempts: int, delay_sec: float):
        self.max_attempts, self.delay_ms = max_attempts, int(delay_sec * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.attempts = handle.getValueState("attempts", "n int")
        self.waiting = handle.getListState("waiting", "job_id long, due_ms long")

    def _count(self) -> int:
        return int(self.attempts.get()[0]) if self.attempts.exists() else 0

    def _waiting(self) -> list[tuple[int, int]]:
        return [(int(j), int(t)) for j, t in self.waiting.get()] if self.waiting.exists() else []

    def _wait(self, rows: list[tuple[int, int]]) -> None:
        if rows:
            self.waiting.put(rows)
        else:
            self.waiting.clear()

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        n, waiting, out = self._count(), self._waiting(), []
        # Rows of a batch come in any order. A row without a job only tells the time.
        given = [r for pdf in rows for r in pdf.itertuples() if pd.notna(r.job_id)]
        for r in sorted(given, key=lambda r: (r.at, r.job_id)):
            job = int(r.job_id)
            if pd.isna(r.error):
                for _, due in waiting:
                    self.handle.deleteTimer(due)
                n, waiting = 0, []
                out.append((key[0], job, "DONE", 0, pd.NaT))
                continue
            n += 1
            if n >= self.max_attempts:
                out.append((key[0], job, "FAILED", n, pd.NaT))
                continue
            due = int(r.at.timestamp() * 1000) + self.delay_ms
            self.handle.registerTimer(due)
            waiting.append((job, due))
            out.append((key[0], job, "WAITING", n, pd.Timestamp(due, unit="ms")))
        if n:
            self.attempts.update((n,))
        else:
            self.attempts.clear()
        self._wait(waiting)
        yield self._events(out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now, waiting, n = expiredTimerInfo.getExpiryTimeInMs(), self._waiting(), self._count()
        self._wait([(j, t) for j, t in waiting if t > now])
        yield self._events([(key[0], j, "DUE", n, pd.Timestamp(t, unit="ms")) for j, t in waiting if t <= now])

    @staticmethod
    def _events(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in EVENTS.split(", ")])
        return out.astype({"job_id": "int64", "attempts": "int32", "due": "datetime64[ns]"})

    def close(self) -> None:
        pass


def retry_events(outcomes: DataFrame, max_attempts: int = 3, delay_sec: float = 60, by_event_time: bool = False) -> DataFrame:
    """A stream of job outcomes (video_id, job_id, at, error; null where the job was done) as the events of its retries.

    Timers go by the clock of the machine, or by the stream's own times: then rows without a job move the time on. A stream that
    is started again looks at its timers from its first rows on, for which one without a job is enough. State is
    kept per item, so memory and work go with the items that have failed, not with the catalog. Needs a state store that
    knows timers (RocksDB). Rows without an item are left out.
    """
    rows = outcomes.select("video_id", "job_id", "at", "error").filter("video_id is not null and at is not null")
    if by_event_time:
        rows = rows.withWatermark("at", "0 seconds")
    mode = "EventTime" if by_event_time else "ProcessingTime"
    return rows.groupBy("video_id").transformWithStateInPandas(RetryTimers(max_attempts, delay_sec), outputStructType=EVENTS, outputMode="Append", timeMode=mode)
