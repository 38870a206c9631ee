"""Commands from files to files, and the package without the training-data folder."""

import json
import subprocess
import sys
from pathlib import Path

from reelmill.cli import main, parser
from reelmill.streaming.watcher import Snapshots

ROOT = Path(__file__).resolve().parents[1]


def test_segment_and_split(spark, tmp_path):
    items = spark.createDataFrame([("v", "s", 240.0), ("w", "t", 20.0), ("x", "u", 100.0)], "video_id string, source_video_id string, duration_sec double")
    items.write.parquet(str(tmp_path / "items"))
    assert main(["segment", "--items", str(tmp_path / "items"), "--out", str(tmp_path / "cut")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "cut")).count() == 3
    assert main(["assign-split", "--clips", str(tmp_path / "cut"), "--out", str(tmp_path / "split.csv")], spark) == 0
    rows = spark.read.option("header", True).csv(str(tmp_path / "split.csv"))
    assert rows.select("source_video_id", "split").distinct().count() == 2


def test_bad_settings_fail(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("clip: {min_duration_sec: 30, target_duration_sec: 200}\n")
    spark.createDataFrame([("v", 240.0)], "video_id string, duration_sec double").write.parquet(str(tmp_path / "items"))
    assert main(["segment", "--items", str(tmp_path / "items"), "--config", str(tmp_path / "c.yaml"), "--out", str(tmp_path / "o")], spark) == 1


def test_every_command_parses():
    assert len(parser()._subparsers._group_actions[0].choices) == 29


def test_catalog_commands(spark, tmp_path, capsys):
    config = tmp_path / "c.yaml"
    config.write_text(
        "poll_interval_sec: 180\noutput: {root_dir: data/raw}\ndownload: {max_height: 1080, merge_format: mp4}\nlive: {try_from_start: true, recovery_from_replay: true}\n"
        "retry: {max_attempts: 3, retry_delay_sec: 60}\nchannels: [{id: c, url: 'https://www.youtube.com/@x', title_keywords: [cau]}]\n"
    )
    state, found = str(tmp_path / "state"), tmp_path / "found"
    found.mkdir()
    rows = [{"id": "AAAAAAAAAAA", "channel_id": "c", "title": "Cầu", "live_status": "not_live", "ordinal": 1}, {"id": "BBBBBBBBBBB", "channel_id": "c", "title": "x", "live_status": "not_live", "ordinal": 2}]
    (found / "a.json").write_text("\n".join(map(json.dumps, rows)))
    assert main(["init-catalog", "--state", state], spark) == 0
    assert main(["scan", "--discoveries", str(found), "--state", state, "--config", str(config), "--discover"], spark) == 0
    assert "AAAAAAAAAAA" in (said := capsys.readouterr().out) and "BBBBBBBBBBB" not in said
    assert main(["scan", "--discoveries", str(found), "--state", state, "--config", str(config)], spark) == 0
    (tmp_path / "list.txt").write_text("# wanted\nhttps://youtu.be/AAAAAAAAAAA\nAAAAAAAAAAA\n")
    assert main(["request", "--references", str(tmp_path / "list.txt"), "--state", state, "--config", str(config)], spark) == 0
    assert "queued=1" in capsys.readouterr().out
    items, jobs = Snapshots(spark, state).read()
    assert [(r.video_id, r.local_status) for r in items.collect()] == [("AAAAAAAAAAA", "QUEUED")] and jobs.count() == 1
    assert main(["backup", "--state", state, "--out", str(tmp_path / "b")], spark) == 0
    assert main(["restore", "--backup", str(tmp_path / "b"), "--state", state, "--root", str(tmp_path / "raw")], spark) == 1
    assert main(["restore", "--backup", str(tmp_path / "b"), "--state", str(tmp_path / "state2"), "--root", str(tmp_path / "raw")], spark) == 0
    assert Snapshots(spark, str(tmp_path / "state2")).read()[0].count() == 1


def test_validate_command(spark, tmp_path):
    from test_operators import annotation_set

    s = annotation_set(spark)
    options = []
    for name in ("clips", "cameras", "scenarios", "events", "splits", "sources", "labels"):
        s[name].write.parquet(str(tmp_path / name))
        options += [f"--{name}", str(tmp_path / name)]
    s["zone_documents"].write.parquet(str(tmp_path / "zones"))
    options += ["--zones", str(tmp_path / "zones")]
    assert main(["validate", *options, "--out", str(tmp_path / "issues")], spark) == 0
    options[options.index("--splits") + 1] = str(tmp_path / "none")
    s["splits"].limit(0).write.parquet(str(tmp_path / "none"))
    assert main(["validate", *options, "--out", str(tmp_path / "issues2")], spark) == 1


def test_analyse_command(spark, tmp_path):
    import numpy as np

    from reelmill.operators.analysis import REQUIRED, SIGNALS

    x = np.random.default_rng(0).integers(0, 255, (8, 16, 16, 3)).astype(np.uint8)
    candidates = spark.createDataFrame([(c, "s", "h", 0.0, 1.0) for c in "ab"], "clip_id string, source_id string, sha256 string, start_sec double, end_sec double")
    candidates.write.parquet(str(tmp_path / "candidates"))
    spark.createDataFrame([("a", bytearray(x.tobytes()), 8, 16, 16), ("b", bytearray(x[:7].tobytes()), 7, 16, 16)], "clip_id string, frames binary, n int, height int, width int").write.parquet(str(tmp_path / "frames"))
    names = dict.fromkeys([*REQUIRED, *SIGNALS, "event_likelihood_level", "hardcase_tags", "signal_status", "analysis_sha256", "analysis_fingerprint"])
    spark.createDataFrame([], ", ".join(["clip_id string", "ordinal int", *(f"{n} {'double' if n.endswith('_score') else 'string'}" for n in names)])).write.parquet(str(tmp_path / "cache"))
    args = [f"--{n}={tmp_path / n}" for n in ("candidates", "cache", "frames")]
    assert main(["analyse", *args, "--out", str(tmp_path / "out")], spark) == 1  # one clip has too few frames
    got = {r.clip_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["a"].global_rank == 1 and got["a"].signal_status == "COMPUTED" and got["b"].signal_status == "FAILED"


def test_the_rest_imports_without_the_llm_folder(tmp_path):
    import shutil

    shutil.copytree(ROOT / "reelmill", tmp_path / "reelmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'overlap_groups' in q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONDONTWRITEBYTECODE": "1"})
