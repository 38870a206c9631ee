"""Cutting with a marker for each finished clip: ended runs, twins, cancelled runs and folded logs."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from reelmill.sources import cutting


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "clips"), str(tmp_path / "log")


def jobs(spark, ids):
    return spark.createDataFrame([(i, f"content of {i}") for i in ids], "clip_id string, content string").repartition(3)


def told(calls: str, fails=lambda i: False):
    """A provider that notes each call in a folder, and fails half-way for some ids."""

    def cutter(job, out, cancelled):
        os.makedirs(calls, exist_ok=True)
        name = hashlib.sha256(job["clip_id"].encode()).hexdigest()
        with open(f"{calls}/{name}", "a") as f:
            f.write("x")
        out.write(job["content"][:3].encode())
        if fails(job["clip_id"]):
            raise OSError("no room")
        out.write(job["content"][3:].encode())

    return cutter


def calls_of(folder):
    return sum(len(open(f"{folder}/{n}").read()) for n in os.listdir(folder)) if os.path.isdir(folder) else 0


def check(spark, log, ids):
    rows = {r.clip_id: r for r in cutting.finished(spark, log).collect()}
    assert set(rows) == set(ids)
    for i, r in rows.items():
        content = open(r.path, "rb").read()
        assert content == f"content of {i}".encode() and (len(content), hashlib.sha256(content).hexdigest()) == (r.file_size_bytes, r.sha256)


def test_a_run_that_ended_early_goes_on(spark, places, tmp_path):
    folder, log = places
    ids = [f"c{i}" for i in range(20)] + ["../odd name", "ünï", ""]
    first = cutting.cut_clips(jobs(spark, ids), folder, log, told(f"{tmp_path}/a", lambda i: i in ("c3", "c4", "ünï"))).collect()
    assert sorted(r.clip_id for r in first if r.outcome == "failed") == ["c3", "c4", "ünï"] and {r.error for r in first} == {None, "OSError: no room"}
    check(spark, log, set(ids) - {"c3", "c4", "ünï"})
    assert not [n for n in os.listdir(folder) if "staged" in n] and len(os.listdir(folder)) == 20
    again = cutting.cut_clips(jobs(spark, ids), folder, log, told(f"{tmp_path}/b")).collect()
    assert sorted((r.clip_id, r.outcome) for r in again) == [("c3", "cut"), ("c4", "cut"), ("ünï", "cut")] and calls_of(f"{tmp_path}/b") == 3
    check(spark, log, ids)
    assert cutting.cut_clips(jobs(spark, ids), folder, log, told(f"{tmp_path}/c")).count() == 0 and calls_of(f"{tmp_path}/c") == 0


def test_a_twin_accepts_what_it_finds_and_a_lost_file_is_cut_again(spark, places, tmp_path):
    folder, log = places
    table = cutting.cut_clips(jobs(spark, ["a", "b", "c"]), folder, log, told(f"{tmp_path}/a"))
    assert {r.outcome for r in table.collect()} == {"cut"}
    # The same plan again, as a second attempt of its tasks would run it.
    assert {r.outcome for r in table.collect()} == {"found"} and calls_of(f"{tmp_path}/a") == 3
    lost = cutting.finished(spark, log).filter("clip_id = 'b'").first().path
    os.remove(lost)
    assert sorted((r.clip_id, r.outcome) for r in table.collect()) == [("a", "found"), ("b", "cut"), ("c", "found")]
    check(spark, log, "abc")


def test_attempts_that_write_different_bytes_leave_a_true_marker(spark, places):
    folder, log = places
    for text in ("one", "two"):
        job = {"clip_id": "a"}
        os.makedirs(f"{log}/markers", exist_ok=True)
        for n in os.listdir(f"{log}/markers"):  # both began before either had finished
            os.remove(f"{log}/markers/{n}")
        assert cutting._cut_one(job, folder, log, lambda j, out, c, text=text: out.write(text.encode()) and None, ".mp4")[4] == "cut"
    r = cutting.finished(spark, log).first()
    assert open(r.path).read() == "two" and r.sha256 == hashlib.sha256(b"two").hexdigest() and len(os.listdir(folder)) == 2


def test_a_cancelled_run_stops_and_leaves_no_part(spark, places, tmp_path):
    folder, log = places

    def cutter(job, out, cancelled):
        out.write(b"content of ")
        if job["clip_id"] == "c2":  # someone cancels while this one is being cut
            open(f"{log}/cancel", "w").close()
        if cancelled():
            raise cutting.Cancelled
        out.write(job["clip_id"].encode())

    ids = [f"c{i}" for i in range(6)]
    rows = [r for r in cutting.cut_clips(jobs(spark, ids).coalesce(1).sortWithinPartitions("clip_id"), folder, log, cutter).collect()]
    assert [(r.clip_id, r.outcome) for r in rows] == [(i, "cut" if i < "c2" else "cancelled") for i in ids]
    assert len(os.listdir(folder)) == 2
    check(spark, log, ["c0", "c1"])
    cutting.resume(spark, log)
    assert {r.outcome for r in cutting.cut_clips(jobs(spark, ids), folder, log, told(f"{tmp_path}/a")).collect()} == {"cut"}
    check(spark, log, ids)
    cutting.cancel(spark, log)
    assert {r.outcome for r in cutting.cut_clips(jobs(spark, ["new"]), folder, log, told(f"{tmp_path}/b")).collect()} == {"cancelled"}


def test_folded_logs(spark, places, tmp_path):
    folder, log = places
    cutting.fold(spark, log)
    for ids in (["a", "b"], ["c"]):
        cutting.cut_clips(jobs(spark, ids), folder, log, told(f"{tmp_path}/x")).collect()
        cutting.fold(spark, log)
    assert not os.path.exists(f"{log}/markers")
    check(spark, log, "abc")
    # Folded, but the markers were not deleted: they count once.
    cutting.cut_clips(jobs(spark, ["d"]), folder, log, told(f"{tmp_path}/x")).collect()
    spark.read.schema(cutting.MARKER).json(f"{log}/markers").write.mode("append").parquet(f"{log}/folded")
    check(spark, log, "abcd")
    assert cutting.cut_clips(jobs(spark, "abcd"), folder, log, told(f"{tmp_path}/y")).count() == 0


def test_no_jobs_and_no_ids(spark, places):
    folder, log = places
    table = spark.createDataFrame([(None, "x")], "clip_id string, content string")
    for t in (table, table.limit(0)):
        assert cutting.cut_clips(t, folder, log, lambda j, o, c: None).select(F.col("clip_id")).count() == 0
    assert cutting.finished(spark, log).count() == 0


def test_short_clips_share_a_file_of_markers(spark, places, tmp_path):
    folder, log = places
    ids = [f"c{i}" for i in range(90)]
    table = cutting.cut_clips(jobs(spark, ids), folder, log, told(f"{tmp_path}/a"))
    assert {r.outcome for r in table.collect()} == {"cut"} and len(os.listdir(folder)) == 90
    assert len(os.listdir(f"{log}/markers")) <= 3
    check(spark, log, ids)
    assert {r.outcome for r in table.collect()} == {"found"} and calls_of(f"{tmp_path}/a") == 90


def test_a_slice_that_is_lost_keeps_what_it_had_cut(spark, places, monkeypatch):
    folder, log = places
    monkeypatch.setattr(cutting, "FLUSH_SEC", 0.0)
    slice_ = [{"clip_id": c} for c in "abcd"]

    def cutter(job, out, cancelled):
        if job["clip_id"] == "c":
            raise KeyboardInterrupt
        out.write(f"content of {job['clip_id']}".encode())

    with pytest.raises(KeyboardInterrupt):
        cutting._cut_slice(slice_, folder, log, cutter, ".mp4")
    check(spark, log, "ab")
    assert len(os.listdir(folder)) == 2

    def twin(job, out, cancelled):  # while this attempt cuts d, another one has cut c
        if job["clip_id"] == "c":
            raise OSError("no room")
        if job["clip_id"] == "d":
            cutting._cut_slice(slice_, folder, log, lambda j, o, c: o.write(f"content of {j['clip_id']}".encode()) and None, ".mp4")
        out.write(f"content of {job['clip_id']}".encode())

    assert [r[4] for r in cutting._cut_slice(slice_, folder, log, twin, ".mp4")] == ["found", "found", "failed", "cut"]
    check(spark, log, "abcd")
