"""Image and motion signals of decoded frames, in numpy, and the choice of frames to show a reviewer.

Decoding is left to a provider: these functions take frames as arrays of shape (n, height, width, 3), blue first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: scales and thresholds of the signals -----------------------------------------------------------
SHARP, MOVING, MASK_STEP, BUSY_SHARE = 180.0, 42.0, 24, 0.015
LEAST_REGION, MOST_REGION, SMALL_REGION, BORDER, CROWD = 0.0008, 0.35, 0.012, 2, 12.0

#: So many frames of a clip are enough, however many were asked for.
LEAST_FRAMES = 8
#: Clips of one size are measured together, so many bytes of pixels at a time; a larger clip is measured alone.
TOGETHER = 1 << 20

SIGNALS = (
    "activity_score motion_variation_score brightness_score low_light_score visual_variation_score foreground_occupancy_score persistence_score "
    "object_count_estimate small_far_score occlusion_score boundary_edge_score blur_score crowded_score fast_motion_score"
).split()


def sample_timestamps(duration: Column | str, n: int) -> Column:
    """Middles of n equal parts of a duration."""
    d = F.col(duration) if isinstance(duration, str) else duration
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: d * (i + 0.5) / n)


def unit(x: float) -> float:
    return float(min(1.0, max(0.0, x))) if x == x else 0.0


def gray(frames: np.ndarray) -> np.ndarray:
    return np.rint(frames @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)


def sharpness(g: np.ndarray) -> float:
    """Variance of the Laplacian; beyond the edge the image is mirrored about its outer row."""
    p = np.pad(g.astype(float), 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def _around(x: np.ndarray, fill: bool | int = 0) -> Iterator[np.ndarray]:
    """Each of nine neighbours of every pixel; ``x`` is one image or a stack of them."""
    p = np.pad(x, [(0, 0)] * (x.ndim - 2) + [(1, 1), (1, 1)], constant_values=fill)
    h, w = x.shape[-2:]
    for i in range(3):
        for j in range(3):
            yield p[..., i : i + h, j : j + w]


def erode(mask: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce(list(_around(mask, True)))


def dilate(mask: np.ndarray) -> np.ndarray:
    return np.logical_or.reduce(list(_around(mask, False)))


def motion_mask(delta: np.ndarray) -> np.ndarray:
    opened = dilate(erode(delta >= MASK_STEP))
    return erode(dilate(opened))


def regions(mask: np.ndarray) -> list[tuple[float, bool]]:
    """(share of the image, whether it reaches the border) of the connected regions of moderate size; corners connect."""
    _, share, edge = _regions(mask[None])
    return [(float(x), bool(e)) for x, e in zip(share, edge, strict=True)]


def _regions(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every region in a stack of masks: the image it is in, its share, and whether it reaches the border."""
    k, h, w = masks.shape
    label = np.where(masks, np.arange(1, k * h * w + 1).reshape(k, h, w), 0)
    while True:  # labels spread by a pixel, then jump to their label's label
        spread = np.where(masks, np.maximum.reduce(list(_around(label))), 0)
        flat = np.concatenate(([0], spread.ravel()))
        spread = np.where(masks, flat[spread], 0)
        if (spread == label).all():
            break
        label = spread
    at, y, x = np.nonzero(masks)
    found, of, size = np.unique(label[masks], return_inverse=True, return_counts=True)
    edge = np.zeros(len(found), bool)
    edge[of[(x <= BORDER) | (y <= BORDER) | (x + 1 >= w - BORDER) | (y + 1 >= h - BORDER)]] = True
    share, image = size / (h * w), (found - 1) // (h * w)
    kept = (share >= LEAST_REGION) & (share <= MOST_REGION)
    return image[kept], share[kept], edge[kept]


@lru_cache(64)
def _shares(n: int, parts: int) -> np.ndarray:
    """How much of each of n pixels falls to each of ``parts`` equal stretches."""
    edge = np.linspace(0, n, parts + 1)
    at = np.arange(n)
    return np.clip(np.minimum(edge[1:, None], at + 1) - np.maximum(edge[:-1, None], at), 0, None) * parts / n


def difference_hash(g: np.ndarray) -> int:
    """64 bits: whether each cell of an 8 by 9 grid of averages is brighter than the one to its left."""
    small = np.rint(_shares(g.shape[0], 8) @ g.astype(float) @ _shares(g.shape[1], 9).T).astype(np.int64)
    bits = (small[:, 1:] > small[:, :-1]).ravel()
    return int("".join("1" if b else "0" for b in bits), 2)


def histogram_distance(a: np.ndarray, b: np.ndarray) -> float:
    x, y = (np.bincount(v.ravel() >> 3, minlength=32).astype(float) for v in (a, b))
    return float(np.sqrt(max(0.0, 1 - np.sqrt(x * y).sum() / np.sqrt(x.sum() * y.sum()))))


def _measures(frames: np.ndarray) -> list[dict]:
    """What signals and key frames are made of, for each of a stack of clips: (clip, n, height, width, 3)."""
    c, n, h, w = frames.shape[:4]
    g = gray(frames)
    flat = g.reshape(c * n, h, w)
    p = np.pad(flat.astype(float), [(0, 0), (1, 1), (1, 1)], mode="reflect")
    sharp = (p[:, :-2, 1:-1] + p[:, 2:, 1:-1] + p[:, 1:-1, :-2] + p[:, 1:-1, 2:] - 4 * p[:, 1:-1, 1:-1]).reshape(c * n, -1).var(1).reshape(c, n)
    bright = flat.reshape(c * n, -1).mean(1).reshape(c, n)
    delta = np.abs(g[:, :-1].astype(int) - g[:, 1:]).reshape(-1, h, w)
    mask = motion_mask(delta) if len(delta) else delta > 0
    image, share, edge = _regions(mask)
    k = len(delta)
    count = lambda which: np.bincount(image[which], minlength=k).reshape(c, n - 1)
    by = lambda x: x.reshape(k, h * w).mean(1).reshape(c, n - 1)
    pairs = {"delta": by(delta), "share": by(mask), "regions": count(slice(None)), "small": count(share <= SMALL_REGION), "edge": count(edge)}
    return [{"gray": g[i], "sharp": sharp[i], "bright": bright[i], **{x: v[i] for x, v in pairs.items()}} for i in range(c)]


def analyse(frames: np.ndarray) -> dict[str, float | str]:
    """The signals of one clip's frames, two at least."""
    if len(frames) < 2:
        raise ValueError("at least two frames are needed")
    return _signals(_measures(frames[None])[0])


def _signals(m: dict) -> dict[str, float | str]:
    g = m["gray"]
    bright = float(np.mean(m["bright"] / 255.0))
    moves, shares, counts = m["delta"] / MOVING, m["share"], m["regions"]
    least = np.maximum(1, counts)
    levels = (g >> 3).reshape(len(g), -1).astype(np.int64) + 32 * np.arange(len(g))[:, None]
    tone = np.bincount(levels.ravel(), minlength=32 * len(g)).reshape(len(g), 32).astype(float)
    x, y = tone[:-1], tone[1:]
    changes = np.sqrt(np.maximum(0.0, 1 - np.sqrt(x * y).sum(1) / np.sqrt(x.sum(1) * y.sum(1))))
    crowd, occupied = unit(np.mean(counts) / CROWD), unit(np.mean(shares) * 2.0)
    values = [
        unit(np.mean(moves)), unit(np.std(moves) * 2.5), bright, unit((0.38 - bright) / 0.30), unit(np.mean(changes) * 2.2), occupied, unit((shares >= BUSY_SHARE).sum() / len(shares)),
        float(np.mean(counts)), unit(np.mean(m["small"] / least)), unit(0.55 * crowd + 0.45 * occupied), unit(np.mean(m["edge"] / least)), unit(1.0 - np.mean(m["sharp"]) / SHARP), crowd, unit(np.percentile(moves, 90)),
    ]
    return dict(zip(SIGNALS, values, strict=True)) | {"visual_signature": f"{difference_hash(g.astype(np.float32).mean(0).astype(np.uint8)):016x}"}


def key_frames(frames: np.ndarray, count: int = 5) -> tuple[list[int], list[str]]:
    """Three to five frames in order with why each was taken: the middle, the liveliest, the hardest, then the most unlike."""
    if not len(frames):
        raise ValueError("there are no frames")
    return _chosen(_measures(frames[None])[0], count)


def _chosen(m: dict, count: int) -> tuple[list[int], list[str]]:
    g = m["gray"]
    wanted = min(len(g), max(3, min(5, int(count))))
    hashes = [difference_hash(x) for x in g]
    event, hard = [], []
    for i in range(len(g)):
        active = occupied = edge = crowd = 0.0
        if i:
            found = int(m["regions"][i - 1])
            active, occupied = unit(m["delta"][i - 1] / MOVING), unit(m["share"][i - 1] * 2.0)
            edge, crowd = unit(m["edge"][i - 1] / max(1, found)), unit(found / CROWD)
        event.append(0.55 * occupied + 0.45 * active)
        hard.append(max(unit(1.0 - m["sharp"][i] / SHARP), unit((0.38 - m["bright"][i] / 255.0) / 0.30), edge, crowd))
    why: dict[int, list[str]] = {}
    for i, reason in (((len(g) - 1) // 2, "OVERVIEW"), (int(np.argmax(event)), "EVENT_LIKELIHOOD"), (int(np.argmax(hard)), "HARD_CASE")):
        why.setdefault(i, []).append(reason)
    while len(why) < wanted:
        rest = [i for i in range(len(g)) if i not in why]
        why[max(rest, key=lambda i: (min((hashes[i] ^ hashes[j]).bit_count() for j in why), -i))] = ["SCENE_DIVERSITY"]
    order = sorted(why)
    return order, ["+".join(why[i]) for i in order]


def _stacks(pdf: pd.DataFrame, wanted: int | None) -> Iterator[tuple[list[str], np.ndarray | None]]:
    """Clips of one shape with their frames, (clip, n, height, width, 3), and those that can't be analysed with None."""
    open_: dict[tuple, tuple[list[str], list[np.ndarray]]] = {}
    for r in pdf.itertuples():
        try:
            x = np.frombuffer(r.frames, np.uint8).reshape(r.n, r.height, r.width, 3)
        except (ValueError, TypeError):  # one clip's bad frames are that clip's failure
            yield [r.clip_id], None
            continue
        if len(x) < 2 or not x.size or (wanted is not None and len(x) < min(LEAST_FRAMES, wanted)):
            yield [r.clip_id], None
            continue
        ids, clips = open_.setdefault(x.shape, ([], []))
        ids.append(r.clip_id)
        clips.append(x)
        if len(clips) * x.nbytes >= TOGETHER:
            yield ids, np.stack(clips)
            del open_[x.shape]
    for ids, clips in open_.values():
        yield ids, np.stack(clips)


def _each(keyframes: int, wanted: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for ids, clips in _stacks(pdf, wanted):
                if clips is None:
                    rows += [{"clip_id": i, "signal_status": "FAILED"} for i in ids]
                    continue
                for i, m in zip(ids, _measures(clips), strict=True):
                    at, why = _chosen(m, keyframes)
                    rows.append({"clip_id": i, "signal_status": "COMPUTED", "keyframes": at, "keyframe_reasons": why, **_signals(m)})
            out = pd.DataFrame(rows).reindex(columns=["clip_id", "signal_status", *SIGNALS, "visual_signature", "keyframes", "keyframe_reasons"])
            for c in ("visual_signature", "keyframes", "keyframe_reasons"):
                out[c] = pd.Series([None if isinstance(x, float) else x for x in out[c]], index=out.index, dtype=object)
            yield out

    return run


def analyse_clips(frames: DataFrame, keyframes: int = 5, wanted: int | None = None) -> DataFrame:
    """Signals and key frames of clips given as (clip_id, frames binary, n, height, width).

    Where so many frames were ``wanted`` of a clip, it needs as many, or LEAST_FRAMES if that is less; otherwise two. A clip
    that can't be analysed is a FAILED row.
    """
    schema = "clip_id string, signal_status string, " + ", ".join(f"{s} double" for s in SIGNALS) + ", visual_signature string, keyframes array<int>, keyframe_reasons array<string>"
    return frames.select("clip_id", "frames", "n", "height", "width").mapInPandas(_each(keyframes, wanted), schema)
