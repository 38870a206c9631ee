"""Signals of made-up frames."""

import numpy as np
import pandas as pd
import pytest

from reelmill.functions import frames as V
from reelmill.operators import frame_rows


def moving_square(n=12, size=64):
    x = np.full((n, size, size, 3), 120, np.uint8)
    for i in range(n):
        x[i, 20:30, 4 * i : 4 * i + 10] = 250
    return x


def test_still_and_moving():
    still = V.analyse(np.full((4, 40, 60, 3), 30, np.uint8))
    assert still["activity_score"] == 0 and still["foreground_occupancy_score"] == 0 and still["blur_score"] == 1
    assert still["low_light_score"] == pytest.approx((0.38 - 30 / 255) / 0.30)
    move = V.analyse(moving_square())
    assert move["activity_score"] > 0 and move["persistence_score"] == 1 and move["object_count_estimate"] >= 1
    with pytest.raises(ValueError):
        V.analyse(moving_square(1))


def test_regions():
    m = np.zeros((40, 40), bool)
    m[5:9, 5:9] = m[9:12, 9:12] = True  # they touch at a corner
    m[20:30, 38:] = True
    m[33, 33] = True  # too small
    assert sorted(V.regions(m)) == sorted([(25 / 1600, False), (20 / 1600, True)])


def test_key_frames():
    at, why = V.key_frames(moving_square(), 5)
    assert len(at) == 5 and at == sorted(at) and any("OVERVIEW" in w for w in why)
    assert V.key_frames(moving_square(2), 5)[0] == [0, 1]


def test_hash_and_samples(spark):
    g = np.tile(np.arange(90, dtype=np.uint8), (16, 1))
    assert V.difference_hash(g) == 2**64 - 1 and V.difference_hash(g[:, ::-1]) == 0
    assert spark.range(1).select(V.sample_timestamps(V.F.lit(12.0), 3).alias("t")).first().t == [2.0, 6.0, 10.0]


def test_clips(spark):
    x = moving_square()
    rows = spark.createDataFrame([("a", bytearray(x.tobytes()), 12, 64, 64), ("b", bytearray(b"xx"), 12, 64, 64)], "clip_id string, frames binary, n int, height int, width int")
    got = {r.clip_id: r for r in V.analyse_clips(rows).collect()}
    assert got["a"].signal_status == "COMPUTED" and len(got["a"].visual_signature) == 16 and len(got["a"].keyframes) == 5
    assert got["b"].signal_status == "FAILED" and got["b"].activity_score is None


def test_clips_of_one_batch_are_measured_together(monkeypatch):
    """Clips of several sizes and lengths, bad ones among them: each has the signals it has alone, and masks are made for stacks."""
    rng = np.random.default_rng(4)
    clips = {f"c{i}": made_up(rng, 2 + i % 3, *((9, 12) if i % 2 else (16, 10))) for i in range(40)}
    rows = [(c, x.tobytes(), *x.shape[:3]) for c, x in clips.items()] + [("short", b"xx", 3, 8, 8), ("none", None, 3, 8, 8), ("one", bytes(192), 1, 8, 8)]
    calls, plain = [], V.motion_mask
    monkeypatch.setattr(V, "motion_mask", lambda d: calls.append(len(d)) or plain(d))
    (out,) = V._each(5, None)(iter([pd.DataFrame(rows, columns=["clip_id", "frames", "n", "height", "width"])]))
    assert len(calls) == 6
    got = out.set_index("clip_id")
    assert set(got.index[got.signal_status == "FAILED"]) == {"short", "none", "one"}
    for c, x in clips.items():
        assert {**V.analyse(x)} == {k: got.loc[c, k] for k in (*V.SIGNALS, "visual_signature")}
        assert V.key_frames(x) == (got.loc[c, "keyframes"], got.loc[c, "keyframe_reasons"])


def frame_table(spark, clips):
    rows = [(c, n, *f.shape[:2], bytearray(f.tobytes())) for c, fs in clips.items() for n, f in fs]
    return spark.createDataFrame(rows, "clip_id string, frame_no long, height int, width int, pixels binary").repartition(3)


def made_up(rng, n, h, w):
    x = rng.integers(0, 256, size=(n, h, w, 3)).astype(np.uint8) // 4
    for i in range(n):
        a = int(rng.integers(0, max(1, w - 6)))
        x[i, 2:8, a : a + 6] = 230
    return x


@pytest.mark.parametrize("chunk", [4, 256])
def test_frames_as_rows_measure_as_whole_clips(spark, monkeypatch, chunk):
    """Wherever chunks begin and end, and with gaps between numbers, the signals are those of the clip as one value."""
    monkeypatch.setattr(frame_rows, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    whole = {f"c{i}": made_up(rng, n, h, w) for i, (n, h, w) in enumerate([(2, 12, 14), (3, 9, 30), (4, 20, 20), (9, 16, 18), (23, 12, 12)])}
    whole["still"] = np.full((6, 10, 10, 3), 30, np.uint8)
    clips = {c: list(enumerate(x)) for c, x in whole.items()}
    clips["c3"] = [(n * n + 5, f) for n, f in clips["c3"]]
    clips["one"] = [(0, whole["c0"][0])]
    clips["sizes"] = [(0, whole["c0"][0]), (1, whole["c1"][0])]
    table = frame_table(spark, clips).unionByName(spark.createDataFrame([("short", 0, 4, 4, bytearray(b"xx")), ("short", 1, 4, 4, None), (None, 0, 4, 4, None), ("nameless", None, 4, 4, bytearray(48))], "clip_id string, frame_no long, height int, width int, pixels binary"))
    got = {r.clip_id: r for r in frame_rows.frame_signals(table).collect()}
    assert {c for c, r in got.items() if r.signal_status == "FAILED"} == {"one", "sizes", "short", "nameless"} and len(got) == len(whole) + 4
    for c, x in whole.items():
        want, (at, why) = V.analyse(x), V.key_frames(x)
        r = got[c]
        assert r.visual_signature == want.pop("visual_signature")
        assert {s: r[s] for s in V.SIGNALS} == pytest.approx(want)
        assert (r.keyframes, r.keyframe_reasons) == (at, why)
    least = {r.clip_id: r.signal_status for r in frame_rows.frame_signals(table, wanted=12).collect()}
    assert [c for c, s in sorted(least.items()) if s == "COMPUTED"] == ["c3", "c4"]


def test_a_long_clip_in_constant_memory():
    """The pass over frames keeps two of them, however many come."""
    import tracemalloc

    import pyarrow as pa

    f = made_up(np.random.default_rng(1), 8, 16, 16)

    def batches(n):
        for k in range(0, n, 50):
            rows = [("a", (k + i) // 256, k + i, 16, 16, f[(k + i) % 8].tobytes()) for i in range(50)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows, strict=True)], ["clip_id", "chunk", "frame_no", "height", "width", "pixels"])

    peaks = []
    for n in (500, 4000):
        tracemalloc.start()
        assert sum(b.num_rows for b in frame_rows._measured(batches(n))) == n
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.3 * peaks[0]


def test_no_frames(spark):
    assert frame_rows.frame_signals(frame_table(spark, {})).count() == 0
