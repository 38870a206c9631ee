"""Signals to levels, tags, diversity, scores, ranks, quotas and redundancy."""

from __future__ import annotations

from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..settings import SELECTION
from .ranking import exact_quantiles, ranked

FEATURES = ("event_likelihood_score", "hardcase_score", "activity_score", "motion_variation_score", "brightness_score", "visual_variation_score", "foreground_occupancy_score")


def weighted(weights: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for name, w in weights.items():
        total = total + F.lit(float(w)) * F.col(f"{name}_score")
    return total


def score_signals(rows: DataFrame, settings: dict[str, Any] = SELECTION) -> DataFrame:
    """Event and hard-case scores, the level of the unclipped event sum, and the tags of signals above the threshold."""
    event, low, high = weighted(settings["event_weights"]), settings["event_thresholds"]["low_max"], settings["event_thresholds"]["high_min"]
    tags = [F.when(F.col(f"{n}_score") >= settings["hardcase_tag_threshold"], F.lit(n.upper())) for n in settings["hardcase_weights"]]
    return rows.withColumns(
        {
            "event_likelihood_score": S.score6(event),
            "event_likelihood_level": F.when(event < low, "LOW").when(event >= high, "HIGH").otherwise("MEDIUM"),
            "hardcase_score": S.score6(weighted(settings["hardcase_weights"])),
            "hardcase_tags": F.array_join(F.filter(F.array(*tags), lambda x: x.isNotNull()), "|"),
        }
    )


def with_diversity(rows: DataFrame, features: tuple[str, ...] = FEATURES, floor: float = 0.05) -> DataFrame:
    """``diversity``: the mean over features of the distance from the median, in robust units, up to one.

    Medians and then the third quartiles of the distances are exact and global, each from a sketch and one more pass, so no
    task gathers the values of a feature; they enter the plan as numbers.
    """
    number = {f: F.coalesce(S.number_in(rows, f), F.lit(0.0)) for f in features}
    values = rows.select(*[number[f].alias(f) for f in features])
    medians = exact_quantiles(values, list(features), [0.5])
    away = values.select(*[F.abs(F.col(f) - F.lit(medians[f][0])).alias(f) for f in features])
    spread = exact_quantiles(away, list(features), [0.75])
    total = F.lit(0.0)
    for f in features:
        total = total + F.least(F.abs(number[f] - F.lit(medians[f][0])) / (2.5 * F.lit(max(spread[f][0], floor))), F.lit(1.0))
    return rows.withColumn("diversity", total / len(features))


def candidate_scores(rows: DataFrame, settings: dict[str, Any] = SELECTION) -> DataFrame:
    """Diversity and the candidate score, which takes rounded scores but the diversity as it is."""
    w = settings["score_weights"]
    number = lambda c: F.coalesce(S.number_in(rows, c), F.lit(0.0))
    score = w["event_likelihood"] * number("event_likelihood_score") + w["hardcase"] * number("hardcase_score") + w["diversity"] * F.col("diversity") + w["activity"] * number("activity_score")
    return with_diversity(rows).withColumn("candidate_score", S.score6(score)).withColumn("diversity_score", S.score6("diversity")).drop("diversity")


def source_rank(rows: DataFrame, score: str = "candidate_score", key: str = "clip_id") -> DataFrame:
    """1.. within each source by falling score, then key: places in a global order by source, less the source's first place.

    So a source that holds a third of all rows is sorted by many tasks.
    """
    placed = ranked(rows, ["source_id", F.desc(score), key], "_place")
    first = placed.groupBy(F.col("source_id").alias("_s")).agg(F.min("_place").alias("_from"))
    return placed.join(first, F.col("source_id").eqNullSafe(F.col("_s"))).withColumn("source_rank", (F.col("_place") - F.col("_from") + 1).cast("int")).drop("_s", "_place", "_from")


def global_rank(rows: DataFrame, score: str = "candidate_score", key: str = "clip_id") -> DataFrame:
    """1.. by falling score, then key, without bringing all rows, or all of one score, to one task."""
    return ranked(rows, [F.desc(score), key], "global_rank")


def source_quotas(counts: DataFrame, target: int, minimum: int, fraction: float) -> DataFrame:
    """Seats of each source: a floor, then one by one to the source with the largest sqrt(n) / (seats + 1).

    Which seat comes when doesn't depend on the other sources, so the seats beyond the floors are ordered by that
    priority and as many taken as are left. Of equal priorities the larger name goes first.
    """
    cap = max(minimum, int(target * fraction))
    base = counts.select("source_id", F.col("n"), F.least("n", F.lit(minimum)).cast("int").alias("floor"), F.least("n", F.lit(cap)).cast("int").alias("most"))
    left = base.agg(F.coalesce(F.lit(target) - F.sum("floor"), F.lit(0))).first()[0]
    seats = base.filter("most > floor").select("source_id", "n", F.explode(F.sequence("floor", F.col("most") - 1)).alias("k"))
    # At most as many seats as the target are left, so each task keeps no more than that.
    taken = seats.orderBy(F.desc(F.sqrt("n") / (F.col("k") + 1)), F.desc("source_id")).limit(max(0, int(left))).groupBy("source_id").agg(F.count(F.lit(1)).alias("more"))
    return base.join(taken, "source_id", "left").select("source_id", "n", (F.col("floor") + F.coalesce("more", F.lit(0))).cast("int").alias("quota"))


def near_duplicate(a: str, b: str, content: float, adjacent: float, adjacency_sec: float) -> Column:
    """Of one source, and alike in content, or less alike but next to each other."""
    c = lambda t, n: F.col(f"{t}.{n}")
    similar = S.bit_similarity(c(a, "signature"), c(b, "signature"))
    gap = F.greatest(c(a, "start_sec"), c(b, "start_sec")) - F.least(c(a, "end_sec"), c(b, "end_sec"))
    return (c(a, "source_id") == c(b, "source_id")) & ((similar >= content) | ((F.greatest(gap, F.lit(0.0)) <= adjacency_sec) & (similar >= adjacent)))


#: So many chosen rows are broadcast.
MOST_CHOSEN = 20_000


def redundant(rows: DataFrame, chosen: DataFrame, content: float = 0.95, adjacent: float = 0.86, adjacency_sec: float = 11.0) -> DataFrame:
    """Rows not chosen that some chosen row makes redundant.

    The chosen ones are a shortlist, broadcast up to MOST_CHOSEN, so that no source's rows meet in a task; more are joined by source.
    """
    short = chosen.limit(MOST_CHOSEN + 1).count() <= MOST_CHOSEN
    return rows.alias("r").join((F.broadcast(chosen) if short else chosen).alias("c"), near_duplicate("r", "c", content, adjacent, adjacency_sec) & (F.col("r.clip_id") != F.col("c.clip_id")), "left_semi").join(chosen.select("clip_id"), "clip_id", "left_anti")


#: Signatures that are held against each other at a time.
BLOCK_ROWS = 2048
#: A band of fewer bits brings more rows together than blocks do, and so do neighbouring bands that make up more than this share of all pairs.
LEAST_BAND_BITS, MOST_SHARE = 8, 0.1


def bands_of(distance: int) -> tuple[int, int] | None:
    """(bands, radius): of two signatures within ``distance`` one band at least differs in no more than ``radius`` bits. None where that says too little."""
    if 64 // (distance + 1) >= LEAST_BAND_BITS:
        return distance + 1, 0
    bands = distance // 2 + 1
    width = 64 // bands
    return (bands, 1) if bands * (1 + width) <= MOST_SHARE * (1 << width) else None


def signature_pairs(rows: DataFrame, distance: int) -> DataFrame:
    """Pairs of one source whose 64-bit signatures differ in at most ``distance`` bits.

    The signature is cut into bands. Up to distance 7 one band must be equal; up to 11 one differs in a bit at most, so
    each row also asks for its bands with one bit turned. Only rows that meet in such a cell of their source are compared, and a
    pair counts in its first common band alone. Cells of more than BLOCK_ROWS rows are split on both sides.
    For larger distances every pair of a source may be one, so each source's rows are dealt into blocks and each pair of
    blocks is compared in one go: a task holds two blocks, and only pairs that pass are made.
    """
    cut = bands_of(distance)
    if cut is None:
        return _pairs_of_blocks(rows, distance)
    bands, radius = cut
    edges = [round(64 * i / bands) for i in range(bands + 1)]
    part = lambda c, i: F.shiftrightunsigned(c, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1 if bands > 1 else -1))
    cell = lambda i, turned: F.struct(F.lit(i).alias("band"), part(F.col("signature"), i).bitwiseXOR(F.lit(turned)).alias("bits"))
    home = [cell(i, 0) for i in range(bands)]
    asked = home + [cell(i, 1 << b) for i in range(bands) if radius for b in range(edges[i + 1] - edges[i])]
    marked = lambda cells: rows.select("clip_id", "source_id", "signature", F.explode(F.array(*cells)).alias("_c")).select("clip_id", "source_id", "signature", "_c.*")
    by = ["source_id", "band", "bits"]
    large = marked(home).groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > BLOCK_ROWS).select(*by, F.ceil(F.col("_n") / BLOCK_ROWS).cast("int").alias("_k"))

    def dealt(cells: list[Column], mine: str, other: str) -> DataFrame:
        split = marked(cells).join(large, by, "left").withColumn("_k", F.coalesce("_k", F.lit(1)))
        return split.withColumn(mine, F.pmod(F.xxhash64("clip_id"), F.col("_k")).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))

    a, b = dealt(home, "_i", "_j").alias("a"), dealt(asked, "_j", "_i").alias("b")
    differ = F.col("a.signature").bitwiseXOR(F.col("b.signature"))
    apart = F.bit_count(differ)
    first = F.coalesce(*[F.when(F.bit_count(part(differ, i)) <= radius, F.lit(i)) for i in range(bands)])
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in [*by, "_i", "_j"]])
    met = a.join(b, same & (F.col("a.clip_id") < F.col("b.clip_id")) & (apart <= distance) & (F.col("a.band") == first))
    return met.select(F.col("a.source_id").alias("source_id"), F.col("a.clip_id").alias("left_id"), F.col("b.clip_id").alias("right_id"), apart.cast("int").alias("distance"))


def _pairs_of_blocks(rows: DataFrame, distance: int) -> DataFrame:
    sizes = rows.groupBy("source_id").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("_blocks"))
    dealt = rows.select("clip_id", "source_id", "signature").join(sizes, "source_id").withColumn("_mine", F.pmod(F.xxhash64("clip_id"), F.col("_blocks")).cast("int"))
    sent = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).withColumns({"_i": F.least("_mine", "_other"), "_j": F.greatest("_mine", "_other")})

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        part = part.sort_values("clip_id", ignore_index=True)
        ids, bits, mine = part["clip_id"].to_numpy(), part["signature"].to_numpy(np.int64).view(np.uint64), part["_mine"].to_numpy()
        left, right, apart = [], [], []
        for at in range(0, len(ids), 256):
            d = np.bitwise_count(bits[at : at + 256, None] ^ bits[None, at:]).astype(np.int32)
            x, y = np.nonzero((d <= distance) & ((mine[at : at + 256, None] != mine[None, at:]) if i != j else True))
            keep = x < y  # sorted by id: each pair once
            x, y = x[keep], y[keep]
            left.append(ids[at + x])
            right.append(ids[at + y])
            apart.append(d[x, y])
        n = sum(map(len, left))
        empty = np.zeros(0, object)
        return pd.DataFrame({"source_id": [key[0]] * n, "left_id": np.concatenate([empty, *left]), "right_id": np.concatenate([empty, *right]), "distance": np.concatenate([np.zeros(0, np.int32), *apart])})

    return sent.groupBy("source_id", "_i", "_j").applyInPandas(compare, "source_id string, left_id string, right_id string, distance int")


def tag_histogram(rows: DataFrame, column: str = "hardcase_tags", sep: str = r"\|") -> DataFrame:
    return rows.select(F.explode(F.split(column, sep)).alias("tag")).filter("tag != ''").groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def level_histogram(rows: DataFrame, levels: tuple[str, ...] = ("LOW", "MEDIUM", "HIGH")) -> DataFrame:
    """A count for every level, zero where none has it."""
    every = rows.sparkSession.createDataFrame([(x,) for x in levels], "level string")
    return every.join(rows.groupBy(F.col("event_likelihood_level").alias("level")).agg(F.count(F.lit(1)).alias("_n")), "level", "left").select("level", F.coalesce("_n", F.lit(0)).alias("n"))
