"""Command line: each command reads tables, applies operators and writes a table. ``python -m reelmill.cli COMMAND --help``.

Tables are Parquet folders or, with the suffix .csv, text tables. The exit code is 1 where a check fails.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import analysis, annotations, catalog, dedupe, registry, release, rules, segmentation, selection, split, summaries
from .operators import intervals as intervals_
from .session import attach, build
from .settings import channel_registry, merged, quality_settings, read_settings, video_id_of
from .sources import sinks, tables

Run = Callable[[SparkSession, argparse.Namespace], int]
COMMANDS: dict[str, tuple[Run, list[str]]] = {}


def command(*tables_: str) -> Callable[[Run], Run]:
    def add(f: Run) -> Run:
        COMMANDS[f.__name__.replace("_", "-")] = (f, list(tables_))
        return f

    return add


def read(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", True).csv(path)
    return spark.read.parquet(path)


def write(df: DataFrame, path: str) -> None:
    if path.endswith(".csv"):
        sinks.write_csv(df, path, df.columns)
    else:
        sinks.write_table(df, path)


def settings(args: argparse.Namespace) -> dict:
    return read_settings(args.config) if args.config else {}


@command("items")
def segment(spark: SparkSession, args: argparse.Namespace) -> int:
    """Cut items into intervals, without looking at reviews."""
    c = settings(args).get("clip", {})
    write(intervals_.segment(read(spark, args.items), c.get("min_duration_sec", 30), c.get("max_duration_sec", 180), c.get("target_duration_sec", 120), c.get("overlap_sec", 10)), args.out)
    return 0


@command("items")
def filter_sources(spark: SparkSession, args: argparse.Namespace) -> int:
    """Review reasons of raw items."""
    v = settings(args).get("validation", {})
    write(dedupe.review_reasons(read(spark, args.items), settings(args).get("clip", {}).get("min_duration_sec", 30), v.get("min_width", 320), v.get("min_height", 240)), args.out)
    return 0


@command("media")
def inventory(spark: SparkSession, args: argparse.Namespace) -> int:
    """Media below a folder with size and hash."""
    write(tables.media_files(spark, args.media), args.out)
    return 0


@command("clips")
def quality(spark: SparkSession, args: argparse.Namespace) -> int:
    """Technical quality of clips: status and notes."""
    rows, q = read(spark, args.clips), quality_settings(settings(args))
    found = rules.technical_issues(rows, q["expected_overlap_sec"], q["overlap_tolerance_sec"], min_sec=q["min_duration_sec"], max_sec=q["max_duration_sec"])
    out = rules.roll_up(rows, found, "clip_id")
    write(out, args.out)
    print(sinks.summary_text(summaries.quality_summary(out, found).first().asDict()))
    return 0


@command("manifest", "inventory", "registry")
def metadata(spark: SparkSession, args: argparse.Namespace) -> int:
    """Issues between manifest, inventory and registry."""
    found = rules.metadata_issues(read(spark, args.manifest), read(spark, args.inventory), read(spark, args.registry))
    write(rules.ordered_issues(found, ["source_id", "clip_id", "field", "code"]), args.out)
    return int(bool(found.filter("severity = 'FAIL'").limit(1).count()))


@command("candidates")
def select(spark: SparkSession, args: argparse.Namespace) -> int:
    """A review pool from scored candidates."""
    write(selection.select_pool(read(spark, args.candidates), merged(settings(args).get("selection"))), args.out)
    return 0


@command("pool")
def finalize(spark: SparkSession, args: argparse.Namespace) -> int:
    """The final shortlist from a reviewed pool."""
    s = merged(settings(args).get("selection"))
    write(selection.finalize(read(spark, args.pool), s["final_shortlist_min"], s["final_shortlist_max"]), args.out)
    return 0


@command("clips")
def assign_split(spark: SparkSession, args: argparse.Namespace) -> int:
    """A dev and test split by groups."""
    s = settings(args).get("split", {})
    write(split.assign_split(read(spark, args.clips), s.get("grouping_key", "source_video_id"), s.get("dev_ratio", 0.7), s.get("seed", 42)), args.out)
    return 0


@command("clips", "splits", "scenarios")
def inspect(spark: SparkSession, args: argparse.Namespace) -> int:
    """What a set holds."""
    print(json.dumps(split.summary(read(spark, args.clips), read(spark, args.splits), read(spark, args.scenarios)).first().asDict(), indent=2))
    return 0


@command("items")
def list_items(spark: SparkSession, args: argparse.Namespace) -> int:
    """Catalog items, newest first; all of them, or as many as --limit asks for."""
    rows = catalog.list_items(read(spark, args.items), args.status, args.live_status)
    for r in (rows.limit(args.limit) if args.limit else rows).toLocalIterator():
        print("\t".join(str(x) for x in (r.video_id, r.live_status, r.local_status, r.title)))
    return 0


@command("clips", "cameras", "zones", "scenarios", "events", "splits", "sources", "labels")
def validate(spark: SparkSession, args: argparse.Namespace) -> int:
    """What the tables of an annotated set say against each other; exit code 1 with any error."""
    names = ("clips", "cameras", "scenarios", "events", "splits", "sources", "labels")
    c = settings(args)
    found = rules.cross_issues(**{n: read(spark, getattr(args, n)) for n in names}, zone_documents=read(spark, args.zones), classes=c.get("object_classes", []), grouping=c.get("split", {}).get("grouping_key", "source_video_id"))
    write(found, args.out)
    status = rules.report_status(read(spark, args.out)).first()
    print(f"{status.status}\t{status.issues}")
    return int(status.status == "ERROR")


@command("files", "probes")
def verdicts(spark: SparkSession, args: argparse.Namespace) -> int:
    """What is wrong with raw files, by their probes: the first thing counts."""
    v = settings(args).get("validation", {})
    probes = read(spark, args.probes).select("path", tables.probed("probe").alias("p"))
    rows = read(spark, args.files).join(probes, "path", "left").select("*", "p.duration_sec", "p.fps", "p.width", "p.height", "p.reason").withColumns({"exists": F.lit(True), "probe_error": F.coalesce("reason", F.lit(""))})
    if "expected_sha256" not in rows.columns:
        rows = rows.withColumn("expected_sha256", F.lit(""))
    out = rows.select("path", rules.file_verdict(v.get("min_duration_sec", 0.0), v.get("min_fps", 5), v.get("min_width", 320), v.get("min_height", 240)).alias("v")).select("path", "v.status", "v.reason")
    write(out, args.out)
    return 0


@command("review", "items", "validation", "existing")
def candidates(spark: SparkSession, args: argparse.Namespace) -> int:
    """Clip candidates of eligible sources; what people decided about them stays."""
    c = settings(args).get("clip", {})
    made = segmentation.generate(*(read(spark, getattr(args, n)) for n in ("review", "items", "validation", "existing")), c.get("min_duration_sec", 30), c.get("max_duration_sec", 180), c.get("target_duration_sec", 120), c.get("overlap_sec", 10))
    write(segmentation.ordered(made), args.out)
    return 0


@command("clips", "cameras")
def source_registry(spark: SparkSession, args: argparse.Namespace) -> int:
    """A row for each source, with its totals and its camera."""
    write(registry.source_registry(read(spark, args.clips), read(spark, args.cameras), settings(args).get("clip", {}).get("overlap_sec", 0.0)), args.out)
    return 0


@command("manifest", "files")
def check_files(spark: SparkSession, args: argparse.Namespace) -> int:
    """Manifest rows without a file, with another content or a path that leaves the root, and files that no row names."""
    write(rules.file_issues(read(spark, args.manifest), read(spark, args.files)), args.out)
    return int(bool(read(spark, args.out).limit(1).count()))


@command("metadata")
def candidate_table(spark: SparkSession, args: argparse.Namespace) -> int:
    """Canonical metadata as candidates, nothing computed."""
    write(analysis.candidate_table(read(spark, args.metadata)), args.out)
    return 0


@command("candidates", "cache", "frames")
def analyse(spark: SparkSession, args: argparse.Namespace) -> int:
    """Candidates with signals, from the cache or from frames, scored and ranked together; exit code 1 if an analysis failed."""
    from .functions.frames import analyse_clips
    from .operators.scoring import score_signals

    s = merged(settings(args).get("selection"))
    given = read(spark, args.frames)

    def fresh(misses: DataFrame) -> DataFrame:
        made = analyse_clips(given.join(misses.select("clip_id"), "clip_id", "left_semi"), s["keyframes_per_clip"], s["sample_frames"])
        rows = score_signals(made, s).withColumns({"keyframe_timestamps": F.to_json("keyframes"), "keyframe_reasons": F.array_join("keyframe_reasons", ";")})
        keep = [c for c in rows.columns if c not in ("keyframes",)]
        return misses.join(rows.select(*keep), "clip_id", "left").withColumn("signal_status", F.coalesce("signal_status", F.lit("FAILED")))

    write(analysis.run_analysis(read(spark, args.candidates), read(spark, args.cache), fresh, s), args.out)
    summary = summaries.analysis_summary(read(spark, args.out)).first().asDict()
    print(sinks.summary_text(summary))
    return int(summary["failed"] > 0)


@command("jobs", "files", "prior")
def reconcile(spark: SparkSession, args: argparse.Namespace) -> int:
    """The manifest rebuilt from verified files; incomplete ones are named."""
    manifest, incomplete = release.reconcile(*(read(spark, getattr(args, n)) for n in ("jobs", "files", "prior")))
    write(manifest, args.out)
    for r in incomplete.toLocalIterator():
        print(r.clip_id)
    return 0


@command("cameras", "clips")
def register_camera(spark: SparkSession, args: argparse.Namespace) -> int:
    """Assign the clip --clip to the camera view --camera/--view of --size WxH."""
    width, height = map(int, args.size.split("x"))
    cameras, clips = annotations.register_camera(read(spark, args.cameras), read(spark, args.clips), args.clip, args.camera, args.view, width, height)
    write(cameras, f"{args.out}/cameras")
    write(clips, f"{args.out}/clips")
    return 0


@command("scenarios", "new", "clips", "labels")
def label_scenarios(spark: SparkSession, args: argparse.Namespace) -> int:
    """Scenarios after new labels, which replace those of the same clip and scenario."""
    write(annotations.label_scenarios(*(read(spark, getattr(args, n)) for n in ("scenarios", "new", "clips", "labels"))), args.out)
    return 0


@command("events", "new", "clips", "zones")
def append_events(spark: SparkSession, args: argparse.Namespace) -> int:
    """Events after new ones, all of which have to be valid."""
    write(annotations.append_events(*(read(spark, getattr(args, n)) for n in ("events", "new", "clips", "zones")), settings(args).get("object_classes", [])), args.out)
    return 0


@command("state")
def init_catalog(spark: SparkSession, args: argparse.Namespace) -> int:
    """An empty catalog, unless there is one."""
    from .streaming.watcher import Snapshots

    store = Snapshots(spark, args.state)
    if not Snapshots(spark, args.state).version:
        store.write(*store.read())
    print(args.state)
    return 0


@command("discoveries", "state")
def scan(spark: SparkSession, args: argparse.Namespace) -> int:
    """One scan of discovery logs into the catalog; with --discover nothing is queued and the items are only printed."""
    from pathlib import Path

    from .streaming import watcher

    config = channel_registry(settings(args), Path(".").resolve())
    raw = spark.read.schema(watcher.DISCOVERIES).json(args.discoveries)
    if args.discover:
        found = watcher.selected(tables.normalized_items(watcher.may_match(raw, config)), config)
        for r in (found.limit(args.limit) if args.limit else found).toLocalIterator():
            print("\t".join(str(x) for x in (r.video_id, r.live_status, r.title)))
        return 0
    store = watcher.Snapshots(spark, args.state)
    items, jobs, bad = watcher.tick(*store.read(), raw, config, F.current_timestamp(), args.limit)
    store.write(items, jobs)
    return int(bool(bad.limit(1).count()))


@command("references", "state")
def request(spark: SparkSession, args: argparse.Namespace) -> int:
    """Queue the items of a list of ids or links; exit code 1 if one of them can't be."""
    from pathlib import Path

    from .streaming.watcher import Snapshots

    config = channel_registry(settings(args), Path(".").resolve())
    given = [video_id_of(r.reference) for r in tables.read_list(spark, args.references).toLocalIterator()]
    asked = spark.createDataFrame([(v, args.channel) for v in dict.fromkeys(given)], "video_id string, channel_hint string")
    store = Snapshots(spark, args.state)
    items, jobs, outcomes = catalog.request(*store.read(), asked, F.current_timestamp(), sum(c.enabled for c in config.channels), config.recovery_from_replay)
    done = {r.outcome: r["n"] for r in outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
    store.write(items, jobs)
    print(", ".join(f"{k}={v}" for k, v in sorted(done.items())))
    return int(done.get("failed", 0) > 0)


@command("issues", "clips", "splits", "scenarios", "events", "sources")
def freeze(spark: SparkSession, args: argparse.Namespace) -> int:
    """A release of a validated set."""
    print(sinks.summary_text(release.freeze(args.out, *[read(spark, getattr(args, n)) for n in ("issues", "clips", "splits", "scenarios", "events", "sources")])))
    return 0


@command("release")
def verify(spark: SparkSession, args: argparse.Namespace) -> int:
    """Files of a release against its checksums."""
    bad = release.verify(spark, args.release).collect()
    for r in bad:
        print(f"{r.problem}\t{r.path}")
    return int(bool(bad))


@command("discoveries", "state", "checkpoint")
def watch(spark: SparkSession, args: argparse.Namespace) -> int:
    """Follow discovery logs into the catalog."""
    from pathlib import Path

    from .streaming.watcher import watch as run

    run(spark, args.discoveries, args.state, args.checkpoint, channel_registry(settings(args), Path(".").resolve()), once=args.once).awaitTermination()
    return 0


@command("state")
def backup(spark: SparkSession, args: argparse.Namespace) -> int:
    """The catalog and the media of completed items, copied and verified."""
    from .streaming.watcher import Snapshots

    print(json.dumps(release.backup(*Snapshots(spark, args.state).read(), args.out, args.project)))
    return 0


@command("backup", "state")
def restore(spark: SparkSession, args: argparse.Namespace) -> int:
    """A backup's media below --root and its catalog in --state, both of which have to be empty."""
    from .streaming.watcher import Snapshots

    store = Snapshots(spark, args.state)
    store.write(*release.restore(spark, args.backup, store.read()[0], args.root, args.project))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="reelmill", description=__doc__)
    subs = top.add_subparsers(dest="command", required=True)
    for name, (f, tables_) in COMMANDS.items():
        p = subs.add_parser(name, help=f.__doc__)
        for t in tables_:
            p.add_argument(f"--{t}", required=True)
        p.add_argument("--config")
        p.add_argument("--out")
        p.add_argument("--status")
        p.add_argument("--live-status")
        p.add_argument("--root", default="data/raw")
        p.add_argument("--project")
        p.add_argument("--limit", type=int)
        p.add_argument("--once", action="store_true")
        p.add_argument("--discover", action="store_true")
        for option in ("--clip", "--camera", "--view", "--size", "--channel"):
            p.add_argument(option)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = attach(spark or build())
    try:
        return COMMANDS[args.command][0](spark, args)
    except (ValueError, OSError) as e:
        print(f"{args.command}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
