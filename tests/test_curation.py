"""Runs over files and catalogs, and operators against plain versions of themselves."""

import hashlib
import json
import logging
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_operators import ACQUISITION, catalog_tables, item, now

from reelmill.functions import frames
from reelmill.journal import configure, journal
from reelmill.operators import analysis, catalog, dedupe, intervals, pool, ranking, release, rules, scoring, segmentation, selection
from reelmill.settings import SELECTION, channel_registry, fingerprint
from reelmill.sources import media, sinks, tables
from reelmill.streaming import watcher


# ---- numbers in order, quantiles, pairs -------------------------------------------------------------------------


def test_ranked(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([1.0, 2.0, None, -5.0])) for i in range(300)]
    got = {r.i: r.k for r in ranking.ranked(spark.createDataFrame(rows, "i int, x double").repartition(5), [F.desc("x"), "i"], "k").collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [got[i] for i, _ in want] == list(range(1, 301))
    assert ranking.ranked(spark.createDataFrame([], "i int"), ["i"], "k").count() == 0


@pytest.mark.parametrize("kind", ["normal", "few", "one", "wide", "empty", "two"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(5)
    x = {"normal": rng.normal(size=5001), "few": rng.integers(0, 3, 1000).astype(float), "one": np.full(50, 0.1), "wide": np.concatenate([rng.normal(size=50) * 1e300, rng.normal(size=51), [5e-324, 0.0, -1.7e308, 1.7e308]]), "empty": np.zeros(0), "two": np.array([1.0, 2.0])}[kind]
    df = spark.createDataFrame(pd.DataFrame({"a": x, "b": -x}), "a double, b double").unionByName(spark.createDataFrame([(None, None)], "a double, b double"))
    got = ranking.exact_quantiles(df, ["a", "b"], [0.5, 0.75, 0.0, 1.0])
    for name, v in (("a", np.sort(x)), ("b", np.sort(-x))):
        if not len(v):
            assert all(np.isnan(y) for y in got[name])
            continue
        for q, y in zip([0.5, 0.75, 0.0, 1.0], got[name], strict=True):
            at = q * (len(v) - 1)
            lo, hi = v[int(at)], v[min(int(at) + 1, len(v) - 1)]
            assert y == lo + (hi - lo) * (at - int(at))


@pytest.mark.parametrize("accuracy, gather", [(10_000, 100_000), (200, 300), (50, 20)])
def test_exact_quantiles_of_more_rows_than_are_gathered(spark, monkeypatch, accuracy, gather):
    monkeypatch.setattr(ranking, "ACCURACY", accuracy)
    monkeypatch.setattr(ranking, "GATHER", gather)
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=20_000), np.full(9_000, 0.25), rng.exponential(size=11_001) * 1e6])
    got = ranking.exact_quantiles(spark.createDataFrame(pd.DataFrame({"a": x, "b": np.round(x, 1)})).repartition(5), ["a", "b"], [0.5, 0.75, 0.001, 0.9999])
    for name, v in (("a", x), ("b", np.round(x, 1))):
        assert got[name] == pytest.approx(np.quantile(v, [0.5, 0.75, 0.001, 0.9999]).tolist(), rel=1e-12)


def test_diversity_is_the_plain_one(spark):
    rng = np.random.default_rng(0)
    x = pd.DataFrame(rng.random((301, 7)), columns=list(scoring.FEATURES))
    got = scoring.with_diversity(spark.createDataFrame(x.assign(i=range(301)))).toPandas().sort_values("i").diversity.to_numpy()
    away = (x - x.median()).abs()
    assert got == pytest.approx(np.minimum(away / (2.5 * np.maximum(away.quantile(0.75), 0.05)), 1).mean(axis=1).to_numpy())


def test_overlaps_of_clips_of_any_length(spark):
    rng = random.Random(1)
    rows = [(f"c{i}", rng.choice("st"), s := rng.uniform(-5000, 5000), s + rng.choice([0.5, 20, 700, 3000, 20000])) for i in range(150)]
    rows += [("endless", "s", 0.0, 1e13), ("far", "s", 9e12, 9.5e12), ("huge", "t", -1e300, 1e300), ("point", "s", 5.0, 5.0)]
    got = {(r.left_id, r.right_id) for r in intervals.overlap_pairs(spark.createDataFrame(rows, "clip_id string, source_id string, start_sec double, end_sec double")).collect()}
    want = set()
    for a in rows:
        for b in rows:
            if a[1] == b[1] and a[3] > a[2] and b[3] > b[2] and (a[2], a[3], a[0]) < (b[2], b[3], b[0]) and min(a[3], b[3]) - max(a[2], b[2]) > 1e-9:
                want.add((a[0], b[0]))
    assert got == want


def test_one_long_timeline_over_many_stretches(spark):
    """Islands, neighbours and numbers of a source with nearly all clips, against a plain walk."""
    rng = random.Random(9)
    rows, at = [], 0.0
    for i in range(400):
        at += rng.choice([0.0, 5.0, 20.0, 100.0])
        rows.append((f"c{i:03}", "hot" if i % 40 else f"s{i}", at, at + rng.choice([4.0, 30.0, 250.0])))
    df = spark.createDataFrame(rows, "clip_id string, source_id string, start_sec double, end_sec double").repartition(7)
    groups, gaps = {}, {}
    for s in {r[1] for r in rows}:
        reach, prev, members = None, None, []
        for r in sorted((r for r in rows if r[1] == s), key=lambda r: (r[2], r[3], r[0])):
            if prev is not None and not 0 <= (o := prev[3] - r[2]) <= 10:
                gaps[r[0]] = (prev[0], "EXCESS_TEMPORAL_OVERLAP" if o > 10 else "TIMELINE_GAP")
            if reach is None or reach - r[2] <= 1e-9:
                members = []
            members.append(r[0])
            groups[r[0]] = members
            reach, prev = max(r[3], reach or r[3]), r
    got = {r.clip_id: (r.overlap_group, r.members) for r in intervals.overlap_groups(df).collect()}
    assert {c: n for c, (_, n) in got.items()} == {c: len(m) for c, m in groups.items() if len(m) > 1}
    assert all(got[a][0] == got[b][0] for m in groups.values() for a in m for b in m if len(m) > 1)
    assert {r.clip_id: (r.previous_id, r.issue_code) for r in intervals.timeline_issues(df, 10.0, 0.0).collect()} == {c: v for c, v in gaps.items()}
    jobs = intervals.trim_jobs(df.select(F.col("source_id").alias("source_video_id"), "start_sec", "end_sec", F.col("clip_id").alias("clip_candidate_id"), F.lit("keep").alias("status")))
    order = [r[0] for r in sorted((r for r in rows if r[1] == "hot"), key=lambda r: (r[2], r[3], r[0]))]
    assert {r.clip_candidate_id: r.clip_number for r in jobs.filter("source_video_id = 'hot'").collect()} == {c: i + 1 for i, c in enumerate(order)}


@pytest.mark.parametrize("distance", [0, 3, 7, 9, 11, 12, 22, 40])
def test_signature_pairs(spark, distance, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_ROWS", 16)
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(4)]
    rows = [(f"c{i}", rng.choice("st"), base[i % 4] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9)))) for i in range(80)]
    df = spark.createDataFrame([(c, s, x - (1 << 64) if x >> 63 else x) for c, s, x in rows], "clip_id string, source_id string, signature long")
    got = {(r.left_id, r.right_id, r.distance) for r in scoring.signature_pairs(df, distance).collect()}
    assert got == {(a[0], b[0], d) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and (d := (a[2] ^ b[2]).bit_count()) <= distance}


@pytest.mark.parametrize("distance", [7, 9])
def test_signature_pairs_of_one_hot_cell(spark, distance, monkeypatch):
    """A third of all rows share a band and differ elsewhere; copies are paired once, NULL signatures with nothing."""
    monkeypatch.setattr(scoring, "BLOCK_ROWS", 8)
    rng = random.Random(5)
    hot = [0x1FFF | (rng.getrandbits(9) << 30) for _ in range(40)]
    rows = [(f"c{i:03d}", "s", x) for i, x in enumerate([*hot, *hot[:3], *(rng.getrandbits(62) for _ in range(60))])] + [("n1", "s", None), ("n2", None, hot[0])]
    df = spark.createDataFrame(rows, "clip_id string, source_id string, signature long").repartition(5)
    got = sorted((r.left_id, r.right_id, r.distance) for r in scoring.signature_pairs(df, distance).collect())
    real = [r for r in rows if None not in r]
    assert got == sorted((a[0], b[0], d) for a in real for b in real if a[0] < b[0] and (d := (a[2] ^ b[2]).bit_count()) <= distance)


@pytest.mark.parametrize("most", [0, 100])
def test_redundant_on_both_sides_of_its_bound(spark, most, monkeypatch):
    monkeypatch.setattr(scoring, "MOST_CHOSEN", most)
    rng = random.Random(6)
    rows = [(f"c{i}", rng.choice("st"), rng.getrandbits(8), float(i * 10), float(i * 10 + 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "clip_id string, source_id string, signature long, start_sec double, end_sec double")
    chosen = df.filter("clip_id in ('c1', 'c7', 'c20')")
    alike = lambda a, b: 1 - (a[2] ^ b[2]).bit_count() / 64
    near = lambda a, b: max(0.0, max(a[3], b[3]) - min(a[4], b[4])) <= 11
    picked = [r for r in rows if r[0] in ("c1", "c7", "c20")]
    want = {a[0] for a in rows if a not in picked for b in picked if a[1] == b[1] and (alike(a, b) >= 0.97 or near(a, b) and alike(a, b) >= 0.95)}
    assert {r.clip_id for r in scoring.redundant(df, chosen, 0.97, 0.95).collect()} == want


def test_numbers_and_previous_values_within_hot_keys(spark):
    """One key holds most rows and goes on over several stretches; NULL is a key, and NULL values are carried as they are."""
    rng = random.Random(7)
    rows = [("hot", i, rng.choice(["x", "y", None])) for i in range(200)] + [(k, i, "z") for k in ("a", "b", None) for i in range(3)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "k string, at int, v string")
    place, before = {}, {}
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        place |= {(k, r[1]): n + 1 for n, r in enumerate(mine)}
        before |= {(k, r[1]): mine[n - 1][2] if n else None for n, r in enumerate(mine)}
    assert {(r.k, r.at): r.n for r in ranking.ranked_within(df, ["k"], ["at"], "n").collect()} == place
    out = ranking.with_previous(df, "k", ["at"], "v", "was")
    assert {(r.k, r.at): r.was for r in out.collect()} == before and out.columns == ["k", "at", "v", "was"]
    assert ranking.with_previous(df.limit(0), "k", ["at"], "v", "was").count() == 0


def test_taken_ids_and_repeated_zones(spark):
    files = spark.createDataFrame([("a", "p2"), ("a", "p1"), ("a", "p1"), ("b", "p3"), (None, "p4"), ("c", None), ("c", "p5")], "clip_id string, path string")
    tail = lambda p: hashlib.sha256(p.encode()).hexdigest()[:8]
    got = sorted((r.clip_id or "", r.path or "") for r in dedupe.collision_suffix(files).collect())
    assert got == sorted([(f"a-{tail('p2')}", "p2"), ("a", "p1"), ("a", "p1"), ("b", "p3"), ("", "p4"), ("c", ""), (f"c-{tail('p5')}", "p5")])
    square = [[0.0, 0.0], [5.0, 0.0], [5.0, 5.0]]
    zone = "camera_id string, view_id string, resolution array<int>, zones array<struct<zone_id:string,zone_type:string,polygon:array<array<double>>>>"
    z = spark.createDataFrame([("c", "v", [10, 10], [("1", "SIDEWALK", square), ("1", "SIDEWALK", square), (None, "SIDEWALK", square), ("2", "X", square)]), (None, "v", [10, 10], [("1", "ALLOWED", square)] * 3), ("e", "v", None, [])], zone)
    assert sorted((r.camera_id or "", r.zone_id or "", r.times) for r in rules.zone_rows(z).collect()) == [("", "1", 3)] * 3 + [("c", "", 0), ("c", "1", 2), ("c", "1", 2), ("c", "2", 1), ("e", "", 0)]


def test_first_rows_are_picked_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id < 900, 0, id) k", "id")
    out = dedupe.first_per_key(df, ["k"], [F.desc("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")
    assert {(r.k, r.id) for r in out.collect()} == {(0, 899)} | {(i, i) for i in range(900, 1000)}


def test_preferred_sources_without_names(spark):
    rows = [(f"v{i}", "", "", "valid", "x.mp4", f"p{i}") for i in range(20)] + [("a", "s", "h", "valid", "copy.mp4", "q"), ("b", "s", "h", "valid", "source.mp4", "r"), ("c", "t", "h", "invalid", "source.mp4", "a"), ("d", None, "h", "valid", "source.mp4", "z")]
    got = {r.video_id: (r.duplicate_source, r.duplicate_checksum) for r in dedupe.preferred_sources(spark.createDataFrame(rows, "video_id string, source_video_id string, sha256 string, status string, filename string, local_path string")).collect()}
    assert all(got[f"v{i}"] == (False, False) for i in range(20))
    assert got["a"] == (True, False) and got["b"] == (False, False) and got["c"] == (False, True) and got["d"] == (False, True)


def test_quotas_of_nothing(spark):
    assert scoring.source_quotas(spark.createDataFrame([], "source_id string, n long"), 110, 20, 0.5).count() == 0


# ---- the greedy pool, and frame signals, as plain loops ---------------------------------------------------------


def plain_pool(rows, quotas, s):
    """The rules of the choice, looked up anew for each pick."""
    feature = lambda r: [r[f] for f in scoring.FEATURES]
    alike = lambda a, b: 1 - (a["signature"] ^ b["signature"]).bit_count() / 64
    gap = lambda a, b: max(0, max(a["start_sec"], b["start_sec"]) - min(a["end_sec"], b["end_sec"])) if a["source_id"] == b["source_id"] else float("inf")
    near = lambda a, b: gap(a, b) <= s["temporal_adjacency_sec"]
    picks = []

    def redundant(r):
        return any(r["source_id"] == c["source_id"] and (alike(r, c) >= s["content_similarity_threshold"] or (near(r, c) and alike(r, c) >= s["adjacent_similarity_threshold"])) for c in picks)

    def utility(r):
        if not picks:
            return r["candidate_score"]
        far = min(np.sqrt(np.mean([(x - y) ** 2 for x, y in zip(feature(r), feature(c), strict=True)])) for c in picks)
        return 0.68 * r["candidate_score"] + 0.24 * far + 0.08 * (1 - max(alike(r, c) for c in picks)) - (0.08 if any(near(r, c) for c in picks) else 0)

    def pick(allowed):
        free = [r for r in allowed if r not in picks]
        for among in ([r for r in free if not redundant(r)], free):
            if among:
                best = max(round(utility(r), 12) for r in among)
                picks.append(min((r for r in among if round(utility(r), 12) == best), key=lambda r: r["clip_id"]))
                return True
        return False

    open_ = lambda: [r for r in rows if sum(c["source_id"] == r["source_id"] for c in picks) < quotas[r["source_id"]]]
    kinds = [(lambda r: r["hardcase_tags"] != "", s["selected_hardcase_minimum"]), (lambda r: r["hardcase_tags"] == "", s["selected_normal_minimum"])]
    kinds += [(lambda r, x=x: r["event_likelihood_level"] == x, s["selection_level_minimums"][x]) for x in ("LOW", "MEDIUM", "HIGH")]
    for kind, least in kinds:
        while sum(map(kind, picks)) < min(least, sum(map(kind, rows))) and pick([r for r in open_() if kind(r)]):
            pass
    for source in sorted(quotas):
        while sum(c["source_id"] == source for c in picks) < quotas[source]:
            pick([r for r in rows if r["source_id"] == source])
    while len(picks) < s["candidate_pool_size"]:
        pick(open_())
    return [r["clip_id"] for r in picks]


SMALL_POOL = SELECTION | {"candidate_pool_size": 40, "selected_hardcase_minimum": 9, "selected_normal_minimum": 9, "selection_level_minimums": {"LOW": 6, "MEDIUM": 10, "HIGH": 6}}


def pool_rows(seed, n):
    rng = random.Random(seed)
    base = [rng.getrandbits(63) for _ in range(12)]
    return [
        {"clip_id": f"c{i:03}", "source_id": rng.choice("abc"), "start_sec": float(10 * i), "end_sec": 10.0 * i + 15, "candidate_score": round(rng.random(), 3), "signature": base[i % 12] ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 6))), "hardcase_tags": rng.choice(["", "BLUR"]), "event_likelihood_level": rng.choice(["LOW", "MEDIUM", "HIGH"])}
        | {f: round(rng.random(), 3) for f in scoring.FEATURES}
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, n, frontier, least", [(4, 70, 2048, 8), (5, 70, 1, 1), (6, 400, 1, 2)])
def test_pool_is_the_plain_one(spark, monkeypatch, seed, n, frontier, least):
    """With a frontier of one row for each stratum the tasks are asked again and again, with a large one hardly; the choices are the same."""
    monkeypatch.setattr(pool, "FRONTIER", frontier)
    monkeypatch.setattr(pool, "LEAST", least)
    rows, quotas = pool_rows(seed, n), {"a": 14, "b": 13, "c": 13}
    ids, asked = pool.choose(spark.createDataFrame(pd.DataFrame(rows)).repartition(5), quotas, SMALL_POOL)
    assert ids == plain_pool(rows, quotas, SMALL_POOL)
    assert asked <= 3 if frontier > n else asked > 3


def test_pool_of_many_is_asked_for_a_few_times(spark):
    """Ten thousand candidates, most of them alike: the bounds spare most rounds."""
    rows, quotas = pool_rows(7, 10_000), {"a": 14, "b": 13, "c": 13}
    ids, asked = pool.choose(spark.createDataFrame(pd.DataFrame(rows)).repartition(4), quotas, SMALL_POOL)
    assert len(set(ids)) == 40 and asked < 12


def test_pool_with_nulls_and_too_little(spark):
    rows = pool_rows(8, 60)
    table = spark.createDataFrame(pd.DataFrame(rows)).withColumn("signature", F.expr("nullif(signature, signature)")).withColumn("brightness_score", F.lit(None).cast("double"))
    quotas = {"a": 14, "b": 13, "c": 13}
    blank = [r | {"signature": 0, "brightness_score": 0.0} for r in rows]
    ids, _ = pool.choose(table, quotas, SMALL_POOL | {"content_similarity_threshold": 2.0, "adjacent_similarity_threshold": 2.0})
    assert len(ids) == 40 and set(ids) <= {r["clip_id"] for r in blank}
    with pytest.raises(pool.SelectionError, match="quota of a"):
        pool.choose(table.filter("clip_id < 'c020'"), quotas, SMALL_POOL)
    with pytest.raises(pool.SelectionError, match="overfill"):
        pool.choose(table, {"a": 50}, SMALL_POOL)
    with pytest.raises(pool.SelectionError, match="filled"):
        pool.choose(table, {"a": 0}, SMALL_POOL)


def test_frame_signals_are_the_plain_ones():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 256, size=(4, 12, 14, 3)).astype(np.uint8)
    x[1:, 3:9, 4:11] = 240
    got = frames.analyse(x)
    h, w = 12, 14
    g = [[[int(np.rint(0.114 * float(p[0]) + 0.587 * float(p[1]) + 0.299 * float(p[2]))) for p in row] for row in f] for f in x]
    mean = lambda f: sum(map(sum, f)) / (h * w)
    bright = sum(mean(f) for f in g) / 4 / 255
    mirror = lambda i, n: -i if i < 0 else 2 * n - 2 - i if i >= n else i

    def variance(f):
        v = [f[mirror(i - 1, h)][j] + f[mirror(i + 1, h)][j] + f[i][mirror(j - 1, w)] + f[i][mirror(j + 1, w)] - 4 * f[i][j] for i in range(h) for j in range(w)]
        m = sum(v) / len(v)
        return sum((y - m) ** 2 for y in v) / len(v)

    clip = lambda v: min(1.0, max(0.0, v))
    delta = [[[abs(b[i][j] - a[i][j]) for j in range(w)] for i in range(h)] for a, b in zip(g, g[1:], strict=False)]
    moves = [mean(d) / 42 for d in delta]

    def around(m, take, beyond):
        return [[take(m[i + a][j + b] if 0 <= i + a < h and 0 <= j + b < w else beyond for a in (-1, 0, 1) for b in (-1, 0, 1)) for j in range(w)] for i in range(h)]

    masks = [[[y >= 24 for y in row] for row in d] for d in delta]
    masks = [around(around(around(around(m, all, True), any, False), any, False), all, True) for m in masks]
    shares = [mean(m) for m in masks]
    assert got["brightness_score"] == pytest.approx(bright)
    assert got["low_light_score"] == pytest.approx(clip((0.38 - bright) / 0.30))
    assert got["blur_score"] == pytest.approx(clip(1 - sum(map(variance, g)) / 4 / 180))
    assert got["activity_score"] == pytest.approx(clip(sum(moves) / 3))
    assert got["motion_variation_score"] == pytest.approx(clip(2.5 * (sum((m - sum(moves) / 3) ** 2 for m in moves) / 3) ** 0.5))
    assert got["foreground_occupancy_score"] == pytest.approx(clip(2 * sum(shares) / 3))
    assert got["persistence_score"] == pytest.approx(sum(s >= 0.015 for s in shares) / 3)


# ---- files ------------------------------------------------------------------------------------------------------


def stored(spark, root, videos):
    """A catalog of completed items whose files are below a folder."""
    rows = []
    for v in videos:
        d = root / "c" / v
        d.mkdir(parents=True)
        (d / "source.mp4").write_bytes(v.encode() * 1000)
        (d / "metadata.json").write_text(json.dumps({"video_id": v, "title": f"t {v}"}))
        size, sha = media.file_hash(str(d / "source.mp4"))
        rows.append(item(v, "COMPLETED") | {"local_path": str(d / "source.mp4"), "file_size_bytes": size, "sha256": sha})
    return catalog_tables(spark, [*rows, item("new")])


def test_backup_and_restore(spark, tmp_path):
    items, jobs = stored(spark, tmp_path / "raw", ["va", "vb"])
    target = str(tmp_path / "backup")
    assert release.backup(items, jobs, target) == {"format": 1, "items": 2, "bytes": 4000}
    none = items.limit(0)
    with pytest.raises(release.ReleaseError, match="isn't empty"):
        release.restore(spark, target, items, str(tmp_path / "new"))
    with pytest.raises(release.ReleaseError, match="isn't empty"):
        release.restore(spark, target, none, str(tmp_path / "raw"))
    with pytest.raises(release.ReleaseError, match="no backup"):
        release.restore(spark, str(tmp_path / "raw"), none, str(tmp_path / "new"))
    back, _ = release.restore(spark, target, none, str(tmp_path / "new"))
    got = {r.video_id: r.local_path for r in back.collect()}
    assert got["va"] == str(tmp_path / "new" / "c" / "va" / "source.mp4") and got["new"] is None
    assert (tmp_path / "new" / "c" / "vb" / "source.mp4").read_bytes() == b"vb" * 1000 and (tmp_path / "new" / "c" / "vb" / "metadata.json").exists()
    # A changed file in the backup leaves nothing behind.
    (tmp_path / "backup" / "media" / "c" / "va" / "source.mp4").write_bytes(b"other")
    with pytest.raises(release.ReleaseError, match="not copied"):
        release.restore(spark, target, none, str(tmp_path / "third"))
    assert not (tmp_path / "third").exists()


def test_backup_refuses(spark, tmp_path):
    items, jobs = stored(spark, tmp_path / "raw", ["va"])
    with pytest.raises(release.ReleaseError, match="outside"):
        release.backup(items, jobs, str(tmp_path / "b"), str(tmp_path))
    running = catalog_tables(spark, [], [{"id": 1, "video_id": "va", "status": "RUNNING"}])[1]
    with pytest.raises(release.ReleaseError, match="running"):
        release.backup(items, running, str(tmp_path / "b"))
    with pytest.raises(release.ReleaseError, match="not copied"):
        release.backup(items.withColumn("sha256", F.when(F.col("sha256").isNotNull(), "0")), jobs, str(tmp_path / "b"))
    assert not (tmp_path / "b").exists()
    with pytest.raises(release.ReleaseError, match="invalid completed"):
        release.backup(items.withColumn("file_size_bytes", F.lit(None).cast("bigint")), jobs, str(tmp_path / "b"))


def test_hashes_of_files(spark, tmp_path):
    big = b"0123456789abcdef" * 200_000
    (tmp_path / "big.mp4").write_bytes(big)
    import hashlib

    rows = {r.path: r for r in media.hashed_files(spark.createDataFrame([(str(tmp_path / "big.mp4"),), (str(tmp_path / "none"),)], "path string")).collect()}
    assert rows[str(tmp_path / "big.mp4")].sha256 == hashlib.sha256(big).hexdigest() and rows[str(tmp_path / "big.mp4")].file_size_bytes == len(big)
    assert rows[str(tmp_path / "none")].sha256 is None and rows[str(tmp_path / "none")].error


def test_sidecars_beside_files(spark, tmp_path):
    stored(spark, tmp_path / "raw", ["va", "vb"])
    (tmp_path / "raw" / "c" / "vb" / "metadata.json").write_text("broken")
    got = {r.path.rsplit("/", 2)[1]: r.title for r in tables.read_sidecars(spark, str(tmp_path / "raw"), ["title"]).collect()}
    assert got == {"va": "t va", "vb": None}
    assert tables.read_sidecars(spark, str(tmp_path / "none"), ["title"]).count() == 0


def test_checkpoints_of_trims(spark, tmp_path):
    path, row = str(tmp_path / "manifest"), lambda c, d: spark.createDataFrame([(c, d)], "clip_id string, duration_sec double")
    for c, d in (("a", 1.0), ("b", 2.0), ("a", 3.0)):
        out = sinks.append_checkpoint(spark, row(c, d), path)
    assert {r.clip_id: r.duration_sec for r in out.collect()} == {"a": 3.0, "b": 2.0}


def test_small_documents(spark, tmp_path):
    for s in (None, spark):
        for v in ({"a": "é"}, {"b": 1}):
            sinks.write_json(v, str(tmp_path / "x" / "y.json"), s)
            assert json.loads((tmp_path / "x" / "y.json").read_text()) == v
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith(".")] == ["y.json"]


def test_journal(caplog):
    configure()
    configure()
    assert len(logging.getLogger("reelmill").handlers) == 1
    with caplog.at_level(logging.INFO, "reelmill"):
        journal("v", "c", "SCAN").info("done %d", 3)
    assert (caplog.records[0].video_id, caplog.records[0].channel_id, caplog.records[0].action, caplog.records[0].getMessage()) == ("v", "c", "SCAN", "done 3")


# ---- the watcher ------------------------------------------------------------------------------------------------


def config(tmp_path, **more):
    return channel_registry(ACQUISITION | {"channels": [{"id": "c", "url": "https://www.youtube.com/@x", "video_ids": ["AAAAAAAAAAA"]}]} | more, tmp_path)


def queued(i, video, origin="watcher", status="QUEUED"):
    return {"id": i, "video_id": video, "job_type": "VOD_DOWNLOAD", "status": status, "origin": origin, "attempts": 0, "available_at": datetime(2029, 1, 1)}


def test_an_empty_list_cancels_the_queue(spark, tmp_path):
    items, jobs = catalog_tables(spark, [item("BBBBBBBBBBB", "QUEUED"), item("CCCCCCCCCCC", "QUEUED"), item("AAAAAAAAAAA", "QUEUED")], [queued(1, "BBBBBBBBBBB"), queued(2, "CCCCCCCCCCC", "manual"), queued(3, "AAAAAAAAAAA")])
    empty = config(tmp_path, channels=[{"id": "c", "url": "https://www.youtube.com/@x"}])
    after, left = watcher.apply_selection(items, jobs, empty, now())
    assert {r.id: r.status for r in left.collect()} == {1: "CANCELLED", 2: "QUEUED", 3: "CANCELLED"}
    assert {r.video_id: r.local_status for r in after.collect()} == {"BBBBBBBBBBB": "DISCOVERED", "CCCCCCCCCCC": "QUEUED", "AAAAAAAAAAA": "DISCOVERED"}
    assert {r.id for r in catalog.active(watcher.apply_selection(items, jobs, config(tmp_path), now())[1]).collect()} == {2, 3}
    assert watcher.apply_selection(items, jobs, config(tmp_path, selection={"mode": "all"}), now())[1].filter("status = 'CANCELLED'").count() == 0


def provided(fail=()):
    def provider(claimed):
        bad = F.col("video_id").isin(list(fail) or [""])
        return claimed.select("id", F.lit(datetime(2030, 1, 1)).alias("started_at"), F.lit("p").alias("path"), F.lit(5).cast("bigint").alias("size"), F.lit("s").alias("sha256"), F.lit(1.0).alias("duration_sec"), F.when(bad, "no network").alias("error"))

    return provider


def test_work_and_retries(spark, tmp_path):
    store = watcher.Snapshots(spark, str(tmp_path / "state"))
    store.write(*catalog_tables(spark, [item("AAAAAAAAAAA", "QUEUED", retry=0), item("BBBBBBBBBBB", "QUEUED", retry=0)], [queued(1, "AAAAAAAAAAA"), queued(2, "BBBBBBBBBBB")]))
    assert watcher.work(store, provided(["BBBBBBBBBBB"]), config(tmp_path), now()) == 2
    assert {r.video_id: (r.local_status, r.retry_count) for r in store.read()[0].collect()} == {"AAAAAAAAAAA": ("COMPLETED", 0), "BBBBBBBBBBB": ("QUEUED", 1)}
    assert watcher.work(store, provided(), config(tmp_path), now()) == 0  # not due yet
    clock = iter(datetime(2030, 1, 1) + timedelta(seconds=61 * i) for i in range(1, 50))
    slept = []
    assert watcher.run_item(store, "BBBBBBBBBBB", provided(["BBBBBBBBBBB"]), config(tmp_path), lambda: next(clock), slept.append) == "FAILED"
    items, jobs = store.read()
    assert items.filter("video_id = 'BBBBBBBBBBB'").first().retry_count == 3 and jobs.filter("id = 2").first().status == "FAILED" and slept
    with pytest.raises(KeyError):
        watcher.run_item(store, "ZZZZZZZZZZZ", provided(), config(tmp_path), lambda: datetime(2030, 1, 1), slept.append)


def test_watch_recovers_and_works(spark, tmp_path):
    state, src = str(tmp_path / "state"), tmp_path / "in"
    src.mkdir()
    watcher.Snapshots(spark, state).write(*catalog_tables(spark, [item("AAAAAAAAAAA", "DOWNLOADING", retry=0), item("CCCCCCCCCCC", "QUEUED")], [queued(1, "AAAAAAAAAAA", status="RUNNING"), queued(2, "CCCCCCCCCCC")]))
    row = {"id": "AAAAAAAAAAA", "channel_id": "c", "title": "t", "live_status": "not_live", "ordinal": 1}
    (src / "a.json").write_text(json.dumps(row) + "\n" + json.dumps(row | {"id": "?", "ordinal": 2}))
    watcher.watch(spark, str(src), state, str(tmp_path / "ck"), config(tmp_path), datetime(2030, 1, 1), provider=provided()).awaitTermination(120)
    items, jobs = watcher.Snapshots(spark, state).read()
    assert {r.video_id: r.local_status for r in items.collect()} == {"AAAAAAAAAAA": "COMPLETED", "CCCCCCCCCCC": "DISCOVERED"}
    assert {r.id: r.status for r in jobs.collect()} == {1: "DONE", 2: "CANCELLED"}
    assert list((tmp_path / "state" / "dead").rglob("*.json"))


def test_a_catalog_of_fewer_columns_is_read(spark, tmp_path):
    """Columns that were added since a version was written are NULL in it."""
    store = watcher.Snapshots(spark, str(tmp_path / "state"))
    items, jobs = catalog_tables(spark, [item("a")], [queued(1, "a")])
    store.write(items.drop("capture_source", "last_error"), jobs.drop("origin"))
    got, more = store.read()
    assert got.columns == items.columns and got.first().capture_source is None and more.first().origin is None


def test_requests(spark, tmp_path):
    items, jobs = catalog_tables(spark, [item("a", "FAILED", retry=3), item("b", "COMPLETED", complete=1), item("u", live="is_upcoming")], [queued(1, "a", status="FAILED")])
    asked = spark.createDataFrame([("a", None), ("b", None), ("u", None), ("z", "c"), ("a", None)], "video_id string, channel_hint string")
    after, more, outcomes = catalog.request(items, jobs, asked, now(), 2)
    assert {r.video_id: r.outcome for r in outcomes.collect()} == {"a": "retried", "b": "skipped", "u": "waiting", "z": "queued"}
    assert {r.video_id: (r.local_status, r.retry_count) for r in after.collect()} == {"a": ("QUEUED", 0), "b": ("COMPLETED", 0), "u": ("WAITING", 0)}
    assert [(r.video_id, r.origin) for r in catalog.active(more).collect()] == [("a", "manual")]
    with pytest.raises(KeyError):
        catalog.enqueue(items, jobs, spark.createDataFrame([("nobody", "VOD_DOWNLOAD")], "video_id string, job_type string"), now())
    with pytest.raises(ValueError):
        catalog.enqueue(items, jobs, items.select("video_id", F.lit("VOD_DOWNLOAD").alias("job_type")), now(), "someone")


# ---- segmentation and analysis ----------------------------------------------------------------------------------


def test_segmentation_refuses(spark):
    review = spark.createDataFrame([("a", "", ""), ("b", "", "")], "video_id string, review_reason string, review_status string")
    items = spark.createDataFrame([("a", "s", 100.0, "p"), ("b", "s", 100.0, "p")], "video_id string, source_video_id string, duration_sec double, local_path string")
    valid = spark.createDataFrame([("a", "valid"), ("b", "valid")], "video_id string, status string")
    with pytest.raises(segmentation.SegmentationError, match="several"):
        segmentation.eligible_sources(review, items, valid)
    with pytest.raises(segmentation.SegmentationError, match="unknown"):
        segmentation.eligible_sources(review, items.filter("video_id = 'a'"), valid, strict=True)
    one = segmentation.eligible_sources(review.filter("video_id = 'a'"), items, valid)
    kept = spark.createDataFrame([("x", "s", 0.0, 50.0, "keep"), ("y", "t", 0.0, 50.0, "keep")], "clip_candidate_id string, source_video_id string, start_sec double, end_sec double, status string")
    with pytest.raises(segmentation.SegmentationError, match="unknown sources"):
        segmentation.jobs(kept, one, 30, 180)
    with pytest.raises(segmentation.SegmentationError, match="invalid interval"):
        segmentation.jobs(kept.filter("source_video_id = 's'").withColumn("end_sec", F.lit(101.0)), one, 30, 180)
    assert segmentation.jobs(kept.filter("source_video_id = 's'"), one, 30, 180).count() == 1


def test_stale_analysis_is_refused(spark):
    rows = spark.createDataFrame([("a", "COMPUTED", "old"), ("b", "FAILED", "old")], "clip_id string, signal_status string, analysis_fingerprint string")
    with pytest.raises(selection.SelectionError, match="1 candidates"):
        analysis.guard_fingerprint(rows)
    analysis.guard_fingerprint(rows.withColumn("analysis_fingerprint", F.lit(fingerprint(SELECTION))))


def test_failed_analyses_keep_their_rows(spark):
    fields = [*analysis.REQUIRED, *analysis.SIGNALS, "event_likelihood_level", "hardcase_tags"]
    double = [f for f in dict.fromkeys(fields) if f.endswith("_score")]
    plain = spark.createDataFrame([(c, "s", "h", 0.0, 1.0) for c in "abcd"], "clip_id string, source_id string, sha256 string, start_sec double, end_sec double")
    full = plain.withColumns({f: F.lit(0.5) if f in double else F.lit("x") for f in dict.fromkeys(fields)})
    now_ = fingerprint(SELECTION)
    cache = full.filter("clip_id in ('a', 'b')").withColumns({"signal_status": F.when(F.col("clip_id") == "a", "COMPUTED").otherwise("FAILED"), "analysis_sha256": F.lit("h"), "analysis_fingerprint": F.lit(now_), "ordinal": F.lit(1)})
    seen = []

    def analyse(misses):
        seen.extend(r.clip_id for r in misses.collect())
        return misses.join(full.drop("source_id", "sha256", "start_sec", "end_sec"), "clip_id").withColumn("signal_status", F.when(F.col("clip_id") == "d", "FAILED").otherwise("COMPUTED"))

    got = {r.clip_id: r for r in analysis.run_analysis(plain, cache, analyse).collect()}
    assert sorted(seen) == ["b", "c", "d"]
    assert {c: (r.origin, r.signal_status) for c, r in got.items()} == {"a": ("cache", "COMPUTED"), "b": ("new", "COMPUTED"), "c": ("new", "COMPUTED"), "d": ("new", "FAILED")}
    assert sorted(r.global_rank for r in got.values() if r.global_rank) == [1, 2, 3] and got["d"].candidate_score is None and got["a"].selection_status == ""


def test_roi_files(spark):
    from test_operators import annotation_set, codes

    good = annotation_set(spark)
    empty = good["zone_documents"].withColumn("zones", F.when(F.lit(False), F.col("zones")))
    assert "invalid_roi_file" in codes(rules.cross_issues(**good | {"zone_documents": empty}))
    assert "missing_roi" in codes(rules.cross_issues(**good | {"zone_documents": good["zone_documents"].limit(0)}))
