"""The catalog's store: bases, deltas and versions."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_operators import catalog_tables, item

from reelmill.streaming import store as S


def tables(spark, state):
    return catalog_tables(spark, [item(v, s) for v, s in state.items()], [{"id": i, "video_id": v, "status": "DONE", "attempts": len(s)} for i, (v, s) in enumerate(state.items())])


def read(store, version=None):
    items, jobs = store.read(version)
    return {r.video_id: r.local_status for r in items.collect()}, {r.video_id: r.attempts for r in jobs.collect()}


def bytes_below(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("share, deltas", [(0.5, 32), (100.0, 2)])
def test_reads_what_was_written(spark, tmp_path, monkeypatch, share, deltas):
    monkeypatch.setattr(S, "COMPACT_SHARE", share)
    monkeypatch.setattr(S, "COMPACT_DELTAS", deltas)
    rng = random.Random(deltas)
    store = S.Snapshots(spark, str(tmp_path / "s"))
    assert read(store) == ({}, {}) and store.version == 0 and store.last_batch == -1
    state, before = {}, {}
    for batch in range(4):
        before = dict(state)
        for v in rng.sample(range(30), 6):
            state[f"v{v:02}"] = rng.choice(["QUEUED", "WAITING", "COMPLETED"])
        for v in rng.sample(sorted(state), min(2, len(state) - 1)):
            del state[v]
        pinned = store.read()
        store.write(*tables(spark, state), batch)
        assert read(store)[0] == state and read(store)[1] == {v: len(s) for v, s in state.items()}
        assert store.version == batch + 1 and store.last_batch == batch
        # Who read before goes on reading what was there then, and the version before can be asked for.
        assert {r.video_id: r.local_status for r in pinned[0].collect()} == before
        if batch:
            assert read(store, batch)[0] == before
    assert len(os.listdir(tmp_path / "s" / "manifests")) - sum(f.endswith(".crc") for f in os.listdir(tmp_path / "s" / "manifests")) == S.KEPT_VERSIONS


def test_a_batch_writes_what_it_changes(spark, tmp_path):
    """Ten times the catalog, the same batch: about the same bytes."""
    grown = []
    for n in (200, 2000):
        store = S.Snapshots(spark, str(tmp_path / f"s{n}"))
        state = {f"v{i:05}": "QUEUED" for i in range(n)}
        store.write(*tables(spark, state), 0)
        size = bytes_below(tmp_path / f"s{n}")
        store.write(*tables(spark, state | {"v00007": "COMPLETED", "new": "WAITING"}), 1)
        grown.append(bytes_below(tmp_path / f"s{n}") - size)
        assert read(store)[0] == state | {"v00007": "COMPLETED", "new": "WAITING"}
        (entry,) = S.Snapshots(spark, str(tmp_path / f"s{n}"))._manifest(2)["items"]["deltas"]
        assert entry["rows"] == 2
    assert grown[1] < 2 * grown[0]


def test_a_value_that_changes_its_column_is_a_change(spark, tmp_path):
    store = S.Snapshots(spark, str(tmp_path / "s"))
    items, jobs = tables(spark, {"a": "QUEUED"})
    store.write(items.withColumn("scheduled_start", F.lit("x")), jobs)
    store.write(items.withColumn("actual_start", F.lit("x")), jobs)
    row = store.read()[0].first()
    assert row.scheduled_start is None and row.actual_start == "x"


@pytest.mark.parametrize("step, share", [("_delta", 0.5), ("_grown", 0.0), ("write_text", 0.5), ("_vacuum", 0.0)])
def test_a_crash_at_each_step(spark, tmp_path, monkeypatch, step, share):
    """What a write that broke off leaves behind changes nothing, and is gone after the next one."""
    monkeypatch.setattr(S, "COMPACT_SHARE", share)
    store = S.Snapshots(spark, str(tmp_path / "s"))
    store.write(*tables(spark, {"a": "QUEUED", "b": "QUEUED"}), 0)
    owner = S if step == "write_text" else S.Snapshots
    whole, calls = getattr(owner, step), []

    def broken(*args):
        calls.append(1)
        if step in ("_delta", "_grown"):
            whole(*args)  # its files are there, but not what comes after
            if len(calls) < 2:
                return whole(*args)
        raise OSError("lost")

    monkeypatch.setattr(owner, step, broken)
    with pytest.raises(OSError, match="lost"):
        store.write(*tables(spark, {"a": "COMPLETED", "b": "QUEUED"}), 1)
    monkeypatch.setattr(owner, step, whole)
    again = S.Snapshots(spark, str(tmp_path / "s"))
    done = step == "_vacuum"  # the version counts once its manifest is there
    assert read(again)[0]["a"] == ("COMPLETED" if done else "QUEUED") and again.last_batch == int(done)
    again.write(*tables(spark, {"a": "FAILED", "b": "WAITING"}), 2)
    assert read(again)[0] == {"a": "FAILED", "b": "WAITING"}
    named = set()
    for v in (again.version, again.version - 1):
        for t in S.TABLES:
            entry = again._manifest(v)[t]
            named |= {p.split("/")[1] for p in (entry["base"], *(d["path"] for d in entry["deltas"])) if p}
    assert {n for f in ("bases", "deltas") for n in again._names(f)} <= named


def test_two_active_jobs_are_refused(spark, tmp_path):
    store = S.Snapshots(spark, str(tmp_path / "s"))
    items, jobs = catalog_tables(spark, [item("a", "QUEUED")], [{"id": 1, "video_id": "a", "status": "QUEUED"}])
    store.write(items, jobs)
    _, two = catalog_tables(spark, [], [{"id": 1, "video_id": "a", "status": "QUEUED"}, {"id": 2, "video_id": "a", "status": "RUNNING"}])
    with pytest.raises(ValueError, match="two active jobs"):
        store.write(items, two)
    assert store.read()[1].count() == 1 and store.version == 1
