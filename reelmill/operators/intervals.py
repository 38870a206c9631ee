"""Intervals on a source's timeline: cutting, overlaps, islands, neighbours."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..storage import stash
from .ranking import ranked

EPSILON = 1e-9


def check_policy(minimum: float, maximum: float, target: float, overlap: float) -> None:
    if not (0 < minimum <= target <= maximum and 0 <= overlap < target):
        raise ValueError("intervals need 0 < minimum <= target <= maximum and 0 <= overlap < target")


def cut_points(duration: Column, minimum: float, maximum: float, target: float, overlap: float) -> Column:
    """array<struct<start, end>> that covers a duration: one interval up to the maximum, else steps of target - overlap.

    The last interval takes in a remainder that would be too short, where the maximum allows it.
    The number of steps has a closed form, so no loop runs.
    """
    check_policy(minimum, maximum, target, overlap)
    d = F.floor(duration * 1000) / 1000
    step = target - overlap
    reach = F.ceil((d - target) / step)
    # The first step whose remainder is too short to stand alone and that may stretch to the end.
    joined = F.greatest(F.ceil((d - maximum) / step), F.floor((d - target + overlap - minimum) / step) + 1)
    last = F.greatest(F.lit(0), F.least(reach, joined)).cast("int")
    many = F.transform(
        F.sequence(F.lit(0), last),
        lambda k: F.struct(F.round(k * F.lit(float(step)), 3).alias("start"), F.round(F.when(k == last, d).otherwise(k * F.lit(float(step)) + target), 3).alias("end")),
    )
    one = F.array(F.struct(F.lit(0.0).alias("start"), F.round(d, 3).alias("end")))
    none = F.filter(one, lambda x: F.lit(False))
    return F.when(d.isNull() | (d < minimum), none).when(d <= maximum, one).otherwise(many)


def segment(items: DataFrame, minimum: float = 30, maximum: float = 180, target: float = 120, overlap: float = 10, id_col: str = "video_id", duration_col: str = "duration_sec") -> DataFrame:
    """A row for each interval of each item, with its stable candidate id."""
    points = cut_points(F.col(duration_col).cast("double"), minimum, maximum, target, overlap)
    rows = items.select("*", F.posexplode(points).alias("interval_number", "_i"))
    return rows.select(
        *[c for c in items.columns],
        "interval_number",
        F.col("_i.start").alias("start_sec"),
        F.col("_i.end").alias("end_sec"),
        F.round(F.col("_i.end") - F.col("_i.start"), 3).alias("length_sec"),
        S.candidate_id(F.col(id_col), F.col("_i.start"), F.col("_i.end")).alias("clip_candidate_id"),
    )


def valid_interval(start: Column, end: Column, duration: Column, minimum: float, maximum: float) -> Column:
    e = 1e-6
    return (start >= -e) & (start < end) & (end <= duration + e) & (end - start >= minimum - e) & (end - start <= maximum + e)


def trim_jobs(candidates: DataFrame, source_col: str = "source_video_id") -> DataFrame:
    """Kept candidates with clip ids. Numbers count all of a source's candidates, rejected ones too, so that they never move."""
    placed = ranked(candidates, [source_col, "start_sec", "end_sec", "clip_candidate_id"], "_place")
    first = placed.groupBy(F.col(source_col).alias("_s")).agg(F.min("_place").alias("_from"))
    numbered = placed.join(first, F.col(source_col).eqNullSafe(F.col("_s"))).withColumn("clip_number", (F.col("_place") - F.col("_from") + 1).cast("int"))
    return numbered.drop("_s", "_place", "_from").filter("status = 'keep'").withColumn("clip_id", S.clip_name(source_col, "clip_number"))


#: The order of a timeline.
ORDER = ("start_sec", "end_sec", "clip_id")


def _stretches(clips: DataFrame) -> DataFrame:
    """Usable clips in the order of their timelines, dealt to stretches ``_p``: a source with very many clips goes on over several."""
    parts = max(1, int(clips.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = _usable(clips).repartitionByRange(parts, "source_id", *ORDER)
    return stash(dealt.withColumn("_p", F.spark_partition_id()), "timeline")


def _inside() -> WindowSpec:
    return Window.partitionBy("_p", "source_id").orderBy(*ORDER)


def _before(rows: DataFrame, **carried: tuple[Column, Callable[[Column], Column]]) -> DataFrame:
    """``rows`` with what the stretches before theirs leave them: each name has an aggregate over a stretch, and what is made of those before.

    There is one row for each source and stretch, so nothing here grows with a source's clips.
    """
    per = rows.groupBy("_p", "source_id").agg(*[agg.alias(name) for name, (agg, _) in carried.items()])
    w = Window.partitionBy("source_id").orderBy("_p")
    left = per.select("_p", "source_id", *[fold(F.col(name)).over(w if fold is F.lag else w.rowsBetween(Window.unboundedPreceding, -1)).alias(name) for name, (_, fold) in carried.items()])
    return rows.join(left, ["_p", "source_id"])


def _neighbours(clips: DataFrame) -> DataFrame:
    """Usable clips with ``_end`` and ``_id`` of the one before them on their timeline."""
    rows = _before(_stretches(clips), _last=(F.max_by(F.struct("end_sec", "clip_id"), F.struct(*ORDER)), F.lag))
    w = _inside()
    return rows.withColumns({"_end": F.coalesce(F.lag("end_sec").over(w), F.col("_last.end_sec")), "_id": F.coalesce(F.lag("clip_id").over(w), F.col("_last.clip_id"))})


def _usable(clips: DataFrame) -> DataFrame:
    return clips.filter("source_id is not null and source_id != '' and start_sec is not null and end_sec is not null and end_sec > start_sec")


def _cell(at: Column, width: Column) -> Column:
    """The number of the cell a time lies in; times beyond all numbers share the last one."""
    return F.floor(F.least(F.greatest(at / width, F.lit(-9e18)), F.lit(9e18)))


def overlap_pairs(clips: DataFrame, expected: float = 0.0, tolerance: float = 0.5, bucket_sec: float = 600.0) -> DataFrame:
    """Pairs of clips of one source that overlap: left starts first. Contact is no overlap.

    A range join on cells of time: a clip lies in one or two cells of a width at least twice its length, and the later
    clip of a pair starts in one of them, so it looks in the one cell of each width that it starts in. There are as
    many widths as powers of two among the lengths that occur, so a long clip costs no more than a short one, and a
    source with very many clips is dealt to many tasks.
    """
    rows = _usable(clips).select("clip_id", "source_id", "start_sec", "end_sec")
    length = F.col("end_sec") - F.col("start_sec")
    level = F.least(F.greatest(F.ceil(F.log2(F.least(length, F.lit(1e300)) * 2 / bucket_sec)), F.lit(0)), F.lit(1000)).cast("int")
    sized = rows.withColumn("_l", level)
    levels = sorted(r[0] for r in sized.select("_l").distinct().collect())  # at most a thousand, and mostly one or two
    width = F.pow(F.lit(2.0), F.col("_l")) * bucket_sec
    left = sized.withColumn("_b", F.explode(F.array_distinct(F.array(_cell(F.col("start_sec"), width), _cell(F.col("end_sec"), width))))).alias("a")
    right = rows.withColumn("_l", F.explode(F.array(*[F.lit(x) for x in levels] or [F.lit(0)]))).withColumn("_b", _cell(F.col("start_sec"), width)).alias("b")
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    before = F.struct(a("start_sec"), a("end_sec"), a("clip_id")) < F.struct(b("start_sec"), b("end_sec"), b("clip_id"))
    over = S.overlap_seconds(a("start_sec"), a("end_sec"), b("start_sec"), b("end_sec"))
    return left.join(right, (a("source_id") == b("source_id")) & (a("_l") == b("_l")) & (a("_b") == b("_b")) & before & (over > EPSILON)).select(
        a("source_id").alias("source_id"),
        a("clip_id").alias("left_id"),
        b("clip_id").alias("right_id"),
        over.alias("overlap_sec"),
        S.overlap_ratio(a("start_sec"), a("end_sec"), b("start_sec"), b("end_sec")).alias("overlap_ratio"),
        F.when(over > expected + tolerance, "WARNING").otherwise("INFO").alias("severity"),
    )


def overlap_groups(clips: DataFrame) -> DataFrame:
    """Clips that overlap others, directly or through others, with the group's label: two passes over each timeline.

    Connected components of an overlap graph on a line are islands: a clip starts a new one when it starts at or
    after the end of all before it. Groups are labelled in the order of their smallest member. A timeline is
    cut into stretches, which only hand on how far they reach and how many islands they begin.
    """
    rows = _before(_stretches(clips).select("clip_id", "source_id", "start_sec", "end_sec", "_p"), _most=(F.max("end_sec"), F.max))
    w = _inside()
    reach = F.greatest(F.max("end_sec").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_most"))
    marked = stash(rows.withColumn("_new", F.when(reach - F.col("start_sec") > EPSILON, 0).otherwise(1)).drop("_most"), "islands")
    islands = _before(marked, _so_far=(F.sum("_new"), F.sum)).withColumn("_island", F.coalesce("_so_far", F.lit(0)) + F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    groups = islands.groupBy("source_id", "_island").agg(F.count(F.lit(1)).alias("members"), F.min("clip_id").alias("_least")).filter("members > 1")
    labelled = ranked(groups, ["_least"], "_rank").withColumn("overlap_group", F.format_string("OVL%03d", F.col("_rank")))
    return islands.join(labelled, ["source_id", "_island"]).select("clip_id", "source_id", "overlap_group", "members")


def overlap_status(clips: DataFrame, expected: float = 0.0, tolerance: float = 0.5) -> DataFrame:
    """Each clip's largest overlap in seconds and as a ratio, and whether it could be checked."""
    pairs = overlap_pairs(clips, expected, tolerance)
    sides = pairs.select(F.explode(F.array("left_id", "right_id")).alias("clip_id"), "overlap_sec", "overlap_ratio")
    most = sides.groupBy("clip_id").agg(F.max("overlap_sec").alias("overlap_max_sec"), F.max("overlap_ratio").alias("overlap_max_ratio"))
    checked = F.coalesce((F.col("source_id") != "") & (F.col("end_sec") > F.col("start_sec")), F.lit(False))
    return clips.join(most, "clip_id", "left").select(
        "clip_id",
        F.when(~checked, "NOT_CHECKED").when(F.col("overlap_max_sec").isNotNull(), "CHECKED_OVERLAP").otherwise("CHECKED_NO_OVERLAP").alias("overlap_status"),
        "overlap_max_sec",
        "overlap_max_ratio",
    )


def timeline_issues(clips: DataFrame, expected: float, tolerance: float) -> DataFrame:
    """Neighbours on a timeline that overlap by more than expected, or leave a gap."""
    rows = _neighbours(clips).withColumns({"previous_id": F.col("_id"), "overlap_sec": F.col("_end") - F.col("start_sec")})
    code = F.when(F.col("overlap_sec") > expected + tolerance, "EXCESS_TEMPORAL_OVERLAP").when(F.col("overlap_sec") < -tolerance, "TIMELINE_GAP")
    return rows.withColumn("issue_code", code).filter("issue_code is not null").select("source_id", "clip_id", "previous_id", "issue_code", "overlap_sec")


def timeline_counts(clips: DataFrame, expected: float, tolerance: float) -> DataFrame:
    """Per source, neighbours at the expected overlap and irregular ones; what lies between is neither."""
    rows = _neighbours(clips).withColumn("o", F.col("_end") - F.col("start_sec"))
    near = F.abs(F.col("o") - expected) <= tolerance
    odd = ~near & ((F.col("o") > expected + tolerance) | (F.col("o") < -tolerance))
    return rows.groupBy("source_id").agg(F.count_if(near).alias("expected_pairs"), F.count_if(odd).alias("irregular_pairs"))
