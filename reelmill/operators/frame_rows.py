"""Signals of clips whose frames are rows: a clip may have any number of frames, and no task holds more than two of them.

A clip's frames are dealt to tasks in chunks of consecutive ones and measured there, each against the one before. A
chunk's first and last frame meet those of the neighbouring chunks in a second, small pass. What a frame measures is a
narrow row, and everything about a clip is an aggregate of such rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import frames as V
from ..storage import discard, stash

#: Frame numbers of one chunk.
CHUNK = 256
PAIR = "move double, share double, regions int, small double, edge double, change double"
MEASURES = f"clip_id string, chunk long, frame_no long, place int, ok boolean, bright double, sharp double, hash long, {PAIR}"
BORDER = "first boolean, height int, width int, gray binary, total binary"
PAIR_NAMES = [c.split()[0] for c in PAIR.split(", ")]


def _pair(before: np.ndarray, now: np.ndarray) -> list:
    """What two neighbouring frames measure: in the order of PAIR."""
    delta = np.abs(before.astype(int) - now)
    mask = V.motion_mask(delta)
    found = V.regions(mask)
    n = max(1, len(found))
    return [float(delta.mean() / V.MOVING), float(mask.mean()), len(found), sum(r <= V.SMALL_REGION for r, _ in found) / n, sum(e for _, e in found) / n, V.histogram_distance(before, now)]


def _table(rows: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], [n for n, _ in names])


def _frame(height: int | None, width: int | None, pixels: bytes | None) -> np.ndarray | None:
    if not height or not width or height < 1 or width < 1 or pixels is None or len(pixels) != 3 * height * width:
        return None
    return V.gray(np.frombuffer(pixels, np.uint8).reshape(height, width, 3))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each frame, sorted by clip, chunk and number; those at a chunk's ends keep their picture, the last one the sum of all."""
    at, before, total, place = None, None, None, 0
    held: list | None = None
    picture: list = []

    def ended() -> list:
        """The held row as the last of its chunk."""
        row = held + [place == 1, *picture, None if total is None else total.astype(np.int32).tobytes()]
        return row

    for whole in batches:
        for lo in range(0, whole.num_rows, 32):
            out = []
            for r in whole.slice(lo, 32).to_pylist():
                key = (r["clip_id"], r["chunk"])
                if key != at:
                    if held is not None:
                        out.append(ended())
                    at, before, total, place, held = key, None, None, 0, None
                elif held is not None:
                    out.append(held + [place == 1, *(picture if place == 1 else (None, None, None)), None])
                g = _frame(r["height"], r["width"], r["pixels"])
                ok = g is not None and r["frame_no"] is not None and (before is None or before.shape == g.shape)
                row = [r["clip_id"], r["chunk"], r["frame_no"], place, ok]
                if ok:
                    row += [float(g.mean() / 255.0), V.sharpness(g), np.uint64(V.difference_hash(g)).astype(np.int64).item()]
                    row += [None] * len(PAIR_NAMES) if before is None else _pair(before, g)
                    before = g
                    total = g.astype(np.int64) if total is None else total + g
                    picture = [*g.shape, g.tobytes()]
                else:
                    row += [None] * (3 + len(PAIR_NAMES))
                    picture = [None, None, None]
                place += 1
                held = row
            if out:
                yield _table(out, f"{MEASURES}, {BORDER}")
    if held is not None:
        yield _table([ended()], f"{MEASURES}, {BORDER}")


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First frames of chunks, measured against the last frame of the chunk before; borders come sorted by clip and chunk."""
    clip, before = None, None
    names = [c.split()[0] for c in MEASURES.split(", ")]
    for whole in batches:
        for lo in range(0, whole.num_rows, 32):
            out = []
            for r in whole.slice(lo, 32).to_pylist():
                if r["clip_id"] != clip:
                    clip, before = r["clip_id"], None
                g = np.frombuffer(r["gray"], np.uint8).reshape(r["height"], r["width"])
                if r["first"]:
                    if before is not None:
                        if before.shape == g.shape:
                            r.update(zip(PAIR_NAMES, _pair(before, g), strict=True))
                        else:
                            r["ok"] = False
                    out.append([r[c] for c in names])
                before = g
            if out:
                yield _table(out, MEASURES)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The signature of each clip's mean picture, from the sums of its chunks, which come sorted by clip."""
    clip, total, shape, n = None, None, None, 0

    def signature() -> list:
        if total is None or None in shape:  # a clip with a frame that could not be read
            return [clip, None]
        mean = (total // n).astype(np.uint8).reshape(shape)
        return [clip, f"{V.difference_hash(mean):016x}"]

    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["clip_id"] != clip:
                if n:
                    out.append(signature())
                clip, total, shape, n = r["clip_id"], None, (r["height"], r["width"]), 0
            part = np.frombuffer(r["total"], np.int32).astype(np.int64)
            if (r["height"], r["width"]) == shape:
                total = part if total is None else total + part
            n += r["frames"]
        if out:
            yield _table(out, "clip_id string, visual_signature string")
    if n:
        yield _table([signature()], "clip_id string, visual_signature string")


def measure_frames(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(measures, signatures) of frames given as (clip_id, frame_no, height, width, pixels binary, blue first).

    Measures: a row for each frame with its ``index`` in its clip from 0, brightness, sharpness, hash, and what it measures
    against the frame before it. Both are read from tables in the shared folder; ``frame_signals`` deletes the first.
    """
    rows = frames.select("clip_id", F.floor(F.col("frame_no") / CHUNK).cast("long").alias("chunk"), F.col("frame_no").cast("long").alias("frame_no"), "height", "width", "pixels").filter("clip_id is not null")
    dealt = rows.repartition("clip_id", "chunk").sortWithinPartitions("clip_id", "chunk", "frame_no", F.xxhash64("pixels"))
    first = stash(dealt.mapInArrow(_measured, f"{MEASURES}, {BORDER}"), "frames-measured")
    names = [c.split()[0] for c in MEASURES.split(", ")]
    borders = first.filter("gray is not null").repartition("clip_id").sortWithinPartitions("clip_id", "chunk", "place")
    # A frame that can't be read has no picture; it is kept as it is.
    measures = first.filter("not first or gray is null").select(*names).unionByName(borders.mapInArrow(_stitched, MEASURES))
    # A frame's place in its clip: the frames of the chunks before, one row for each chunk, and its place in its own.
    per_chunk = first.groupBy("clip_id", "chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.coalesce(F.sum("_n").over(Window.partitionBy("clip_id").orderBy(F.asc_nulls_first("chunk")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = per_chunk.select(F.col("clip_id").alias("_clip"), F.col("chunk").alias("_chunk"), earlier.alias("_before"))
    on = (F.col("clip_id") == F.col("_clip")) & F.col("chunk").eqNullSafe(F.col("_chunk"))
    indexed = stash(measures.join(before, on).withColumn("index", F.col("_before") + F.col("place")).drop("_clip", "_chunk", "_before", "chunk", "place"), "frames-indexed")
    totals = first.filter("total is not null").join(per_chunk.select(F.col("clip_id").alias("_clip"), F.col("chunk").alias("_chunk"), F.col("_n").alias("frames")), on)
    totals = totals.select("clip_id", "chunk", "height", "width", "total", "frames").repartition("clip_id").sortWithinPartitions("clip_id", "chunk")
    signatures = stash(totals.mapInArrow(_summed, "clip_id string, visual_signature string"), "frames-signed")
    discard(first)
    return indexed, signatures


def _unit(x: Column) -> Column:
    return F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.nanvl(x, F.lit(0.0)))), F.lit(0.0))


def key_frames(measures: DataFrame, wanted: int = 5) -> DataFrame:
    """(clip_id, keyframes, keyframe_reasons): three to five frames of each clip in order, by their index.

    The middle, the liveliest and the hardest, then one at a time the frame whose hash is farthest from those of the
    frames taken so far. Each of these rounds reads the narrow rows; a clip's taken frames are at most five.
    """
    event = 0.55 * _unit(F.col("share") * 2.0) + 0.45 * _unit(F.col("move"))
    hard = F.greatest(_unit(1.0 - F.col("sharp") / V.SHARP), _unit((0.38 - F.col("bright")) / 0.30), _unit(F.col("edge")), _unit(F.col("regions") / V.CROWD))
    frame = F.struct("index", "hash")
    rows = measures.select("clip_id", "index", "hash", event.alias("event"), hard.alias("hard"))
    n = rows.groupBy("clip_id").agg(F.count(F.lit(1)).alias("n"), F.max_by(frame, F.struct("event", -F.col("index"))).alias("e"), F.max_by(frame, F.struct("hard", -F.col("index"))).alias("h"))
    middle = rows.join(n.select(F.col("clip_id").alias("_c"), F.floor((F.col("n") - 1) / 2).alias("_m")), (F.col("clip_id") == F.col("_c")) & (F.col("index") == F.col("_m"))).select(F.col("clip_id").alias("_c"), frame.alias("o"))
    three = n.join(middle, F.col("clip_id") == F.col("_c")).drop("_c")
    same = lambda a, b: F.col(f"{a}.index") == F.col(f"{b}.index")
    why = lambda f, *reasons: F.struct(F.col(f"{f}.index").alias("index"), F.col(f"{f}.hash").alias("hash"), F.concat_ws("+", *reasons).alias("why"))
    over = why("o", F.lit("OVERVIEW"), F.when(same("e", "o"), "EVENT_LIKELIHOOD"), F.when(same("h", "o"), "HARD_CASE"))
    lively = F.when(~same("e", "o"), why("e", F.lit("EVENT_LIKELIHOOD"), F.when(same("h", "e"), "HARD_CASE")))
    hardest = F.when(~same("h", "o") & ~same("h", "e"), why("h", F.lit("HARD_CASE")))
    taken = three.select("clip_id", F.least(F.col("n"), F.lit(max(3, min(5, int(wanted))))).alias("wanted"), F.array_compact(F.array(over, lively, hardest)).alias("taken"))
    for _ in range(4):
        mine = taken.select(F.col("clip_id").alias("_c"), "wanted", "taken").filter(F.size("taken") < F.col("wanted"))
        open_ = rows.join(mine, F.col("clip_id") == F.col("_c")).filter(~F.exists("taken", lambda t: t["index"] == F.col("index")))
        apart = F.array_min(F.transform("taken", lambda t: F.bit_count(t["hash"].bitwiseXOR(F.col("hash")))))
        farthest = open_.groupBy("clip_id").agg(F.max_by(F.struct("index", "hash", F.lit("SCENE_DIVERSITY").alias("why")), F.struct(apart, -F.col("index"))).alias("_f")).withColumnRenamed("clip_id", "_c")
        taken = taken.join(farthest, F.col("clip_id") == F.col("_c"), "left").select("clip_id", "wanted", F.when(F.col("_f").isNull(), F.col("taken")).otherwise(F.array_append("taken", F.col("_f"))).alias("taken"))
    order = F.array_sort("taken")
    return taken.select("clip_id", F.transform(order, lambda t: t["index"].cast("int")).alias("keyframes"), F.transform(order, lambda t: t["why"]).alias("keyframe_reasons"))


def frame_signals(frames: DataFrame, keyframes: int = 5, wanted: int | None = None) -> DataFrame:
    """Signals and key frames of clips whose frames are rows (clip_id, frame_no, height, width, pixels), one row for each clip.

    The same columns and values as of clips that are one value each. Where so many frames were ``wanted`` of a clip, it
    needs as many, or LEAST_FRAMES if that is less; otherwise two. A clip with a frame that can't be read or has another size is
    FAILED. Frame numbers say the order and may have gaps; rows without a clip are left out; frames of one number
    stand in the order of a hash. The rows are read from tables in the shared folder.
    """
    measures, signatures = measure_frames(frames)
    a = lambda c: F.avg(c)
    per = measures.groupBy("clip_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("bad"), a("bright").alias("bright"), a("move").alias("move"), F.stddev_pop("move").alias("sway"), a("share").alias("share"), F.try_divide(F.count_if(F.col("share") >= V.BUSY_SHARE), F.count("share")).alias("busy"),
        a("regions").alias("regions"), a("small").alias("small"), a("edge").alias("edge"), a("change").alias("change"), a("sharp").alias("sharp"), F.percentile("move", F.lit(0.9)).alias("fast"),
    )
    x = F.col
    crowd, occupied = _unit(x("regions") / V.CROWD), _unit(x("share") * 2.0)
    values = [
        _unit(x("move")), _unit(x("sway") * 2.5), x("bright"), _unit((0.38 - x("bright")) / 0.30), _unit(x("change") * 2.2), occupied, _unit(x("busy")),
        x("regions"), _unit(x("small")), _unit(0.55 * crowd + 0.45 * occupied), _unit(x("edge")), _unit(1.0 - x("sharp") / V.SHARP), crowd, _unit(x("fast")),
    ]
    least = 2 if wanted is None else min(V.LEAST_FRAMES, wanted)
    good = (x("bad") == 0) & (x("n") >= max(2, least))
    scored = per.select("clip_id", F.when(good, "COMPUTED").otherwise("FAILED").alias("signal_status"), *[F.when(good, v).alias(s) for s, v in zip(V.SIGNALS, values, strict=True)])
    # Frames of failed clips have no part in the rounds below.
    of_good = measures.join(scored.filter("signal_status = 'COMPUTED'").select("clip_id"), "clip_id", "left_semi")
    shown = signatures.join(key_frames(of_good, keyframes), "clip_id")
    return scored.join(shown, "clip_id", "left").select("clip_id", "signal_status", *V.SIGNALS, "visual_signature", "keyframes", "keyframe_reasons")
