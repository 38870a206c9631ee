"""The greedy, diversity-aware choice of a few among any number of candidates, by bounds instead of by gathering them.

Each choice takes the candidate of most use given the choices before it. A candidate's use never grows once the first
choice is made: it gets no farther from the choices, no less like them, and stays next to one. So a use worked out earlier
bounds what it is now. Tasks give the few best of each stratum; the choices are made among these for as long as the best
of them beats the bound of everything that was left behind, and only then are the tasks asked again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import discard, stash
from . import scoring

LEVELS = ("LOW", "MEDIUM", "HIGH")
#: Candidates that are brought to the driver at a time, about, for each of the two tiers; at least LEAST of each stratum.
FRONTIER, LEAST = 2048, 8
FEATURES = [f"f{i}" for i in range(len(scoring.FEATURES))]
#: What is known of a candidate; a null signature is like no other.
COLUMNS = ["clip_id", "stratum", "source", "score", *FEATURES, "signature", "signed", "start_sec", "end_sec"]
FRONT = "clip_id string, stratum int, source int, score double, " + ", ".join(f"{f} double" for f in FEATURES) + ", signature long, signed boolean, start_sec double, end_sec double, tier int, use double"


class SelectionError(ValueError):
    pass


class Candidates:
    """Some candidates as arrays, with what the choices so far have made of them."""

    def __init__(self, table: pd.DataFrame, settings: dict[str, Any]):
        self.table, self.s = table, settings
        self.ids = table["clip_id"].to_numpy(object)
        self.stratum, self.source = table["stratum"].to_numpy(np.int64), table["source"].to_numpy(np.int64)
        self.score = table["score"].to_numpy(float)
        self.features = np.ascontiguousarray(table[FEATURES].to_numpy(float))
        self.signature, self.signed = table["signature"].to_numpy(np.int64).view(np.uint64), table["signed"].to_numpy(bool)
        self.start, self.end = table["start_sec"].to_numpy(float), table["end_sec"].to_numpy(float)
        n = len(table)
        self.any = False
        self.redundant, self.adjacent = np.zeros(n, bool), np.zeros(n, bool)
        self.novelty, self.similar = np.full(n, np.inf), np.zeros(n)

    def after(self, pick: pd.Series) -> None:
        """Take one more choice into account."""
        apart = self.features - pick[FEATURES].to_numpy(float)
        distance = np.sqrt((apart**2).sum(1) / apart.shape[1])
        bits = np.bitwise_count(self.signature ^ np.int64(pick["signature"]).astype(np.uint64))
        similar = np.where(self.signed & bool(pick["signed"]), 1 - bits / 64.0, 0.0)
        same = self.source == pick["source"]
        near = same & (np.maximum(0, np.maximum(self.start, pick["start_sec"]) - np.minimum(self.end, pick["end_sec"])) <= self.s["temporal_adjacency_sec"])
        self.novelty, self.similar = np.minimum(self.novelty, distance), np.maximum(self.similar, similar)
        self.adjacent |= near
        self.redundant |= same & (similar >= self.s["content_similarity_threshold"]) | near & (similar >= self.s["adjacent_similarity_threshold"])
        self.any = True

    def use(self) -> np.ndarray:
        if not self.any:
            return self.score
        return 0.68 * self.score + 0.24 * self.novelty + 0.08 * (1 - self.similar) - 0.08 * self.adjacent


def _best_of_strata(table: pd.DataFrame, most: int) -> pd.DataFrame:
    """Of each stratum and tier the ``most`` rows of most use, ties to smaller ids."""
    table = table.sort_values(["stratum", "tier", "use", "clip_id"], ascending=[True, True, False, True], kind="stable")
    return table[table.groupby(["stratum", "tier"]).cumcount() < most]


def _front(picks: pd.DataFrame, settings: dict[str, Any], most: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen = set(picks["clip_id"]) if len(picks) else set()
        held = None
        for part in parts:
            if chosen:
                part = part[~part["clip_id"].isin(chosen)]
            if not len(part):
                continue
            now = Candidates(part, settings)
            for _, pick in picks.iterrows():
                now.after(pick)
            part = _best_of_strata(part.assign(tier=now.redundant.astype(np.int32), use=now.use()), most)
            held = part if held is None else _best_of_strata(pd.concat([held, part]), most)
        if held is not None:
            yield held

    return run


@dataclass
class _Bound:
    """The last row that was brought of a stratum and tier of which more rows are left behind."""

    use: float
    id: str

    def beaten_by(self, use: float, id_: str) -> bool:
        return (-use, id_) <= (-self.use, self.id)


class Chooser:
    """Choices one after the other over a written table of candidates."""

    def __init__(self, table: DataFrame, settings: dict[str, Any], strata: Iterable[int]):
        self.table, self.s = table, settings
        self.most = max(LEAST, FRONTIER // max(1, len(list(strata))))
        self.picks = pd.DataFrame()
        self.asked = 0
        self._ask()

    def _ask(self) -> None:
        """Bring the best of each stratum under the choices so far."""
        self.asked += 1
        best = self.table.mapInPandas(_front(self.picks, self.s, self.most), FRONT)
        place = F.row_number().over(Window.partitionBy("stratum", "tier").orderBy(F.desc("use"), "clip_id"))
        rows = best.withColumn("_place", place).filter(F.col("_place") <= self.most).drop("_place").collect()
        front = pd.DataFrame([tuple(r) for r in rows], columns=[*COLUMNS, "tier", "use"])
        front = front.sort_values("clip_id", ignore_index=True)
        self.bounds: dict[tuple[int, int], _Bound] = {}
        for (stratum, tier), part in front.groupby(["stratum", "tier"]):
            if len(part) >= self.most:
                use = part["use"].min()
                self.bounds[int(stratum), int(tier)] = _Bound(use, part.loc[part["use"] == use, "clip_id"].max())
        self.now = Candidates(front, self.s)
        for _, pick in self.picks.iterrows():
            self.now.after(pick)
        self.taken = np.zeros(len(front), bool)
        self.of_first = self.picks.empty

    def pick(self, strata: set[int]) -> str | None:
        """Choose from these strata: the candidate of most use that isn't redundant, else the best redundant one; None where nothing is left."""
        # Before the first choice the use is another one, so what was brought then bounds nothing later.
        if self.of_first and not self.picks.empty:
            self._ask()
        for _ in range(2):
            i = self._certain(strata)
            if i != -1:
                break
            self._ask()
        else:
            raise AssertionError("what the tasks have just given bounds itself")
        if i is None:
            return None
        pick = self.now.table.iloc[i]
        self.taken[i] = True
        self.picks = pd.concat([self.picks, pick.to_frame().T], ignore_index=True)
        self.now.after(pick)
        return pick["clip_id"]

    def _certain(self, strata: set[int]) -> int | None:
        """The place of the next choice, None if there is none, -1 if what was left behind may hold it."""
        mine = ~self.taken & np.isin(self.now.stratum, list(strata))
        use = self.now.use()
        for tier in (0, 1):
            among = np.flatnonzero(mine & (self.now.redundant == bool(tier)))
            left = [b for (stratum, t), b in self.bounds.items() if t == tier and stratum in strata]
            if len(among):
                i = int(among[use[among].argmax()])  # rows are in the order of ids, and of equal ones the first is taken
                return i if all(b.beaten_by(use[i], self.now.ids[i]) for b in left) else -1
            if left:
                return -1
        return None


def _strata(quotas: dict[str, int]) -> tuple[Column, Column]:
    """Numbers of a row's source and of its stratum: source, hard or not, level."""
    number = F.create_map(*[F.lit(x) for i, s in enumerate(sorted(quotas)) for x in (s, i)])[F.col("source_id")]
    level = F.col("event_likelihood_level")
    rank = F.when(level == "LOW", 0).when(level == "MEDIUM", 1).when(level == "HIGH", 2).otherwise(3)
    return number.cast("int"), (number * 8 + F.when(F.coalesce("hardcase_tags", F.lit("")) != "", 4).otherwise(0) + rank).cast("int")


def choose(rows: DataFrame, quotas: dict[str, int], settings: dict[str, Any]) -> tuple[list[str], int]:
    """Ids in the order they were chosen, and how often the tasks were asked.

    First the reserves for hard, normal and each level, as far as quotas leave room, then each source's quota, then the
    rest of the pool. ``quotas``: seats of each source; rows of other sources are never chosen. Rows are written once,
    as numbers; a round reads them, and what reaches the driver is bounded by strata, not by candidates.
    """
    target = int(settings["candidate_pool_size"])
    if sum(quotas.values()) > target:
        raise SelectionError("the constraints overfill the pool")
    names = sorted(s for s, seats in quotas.items() if seats > 0)
    if not names:
        raise SelectionError("the pool can't be filled")
    source, stratum = _strata({s: quotas[s] for s in names})
    features = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f) for c, f in zip(scoring.FEATURES, FEATURES, strict=True)]
    table = rows.filter(F.col("source_id").isin(names)).select(
        "clip_id", stratum.alias("stratum"), source.alias("source"), F.col("candidate_score").cast("double").alias("score"), *features,
        F.coalesce("signature", F.lit(0)).cast("long").alias("signature"), F.col("signature").isNotNull().alias("signed"), F.col("start_sec").cast("double"), F.col("end_sec").cast("double"),
    )
    table = stash(table, "pool-candidates")
    try:
        return _choose(table, names, quotas, settings, target)
    finally:
        discard(table)


def _choose(table: DataFrame, names: list[str], quotas: dict[str, int], settings: dict[str, Any], target: int) -> tuple[list[str], int]:
    sizes = {r.stratum: r.n for r in table.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
    chooser = Chooser(table, settings, sizes)
    have = dict.fromkeys(sizes, 0)
    seats = [quotas[s] for s in names]
    ids: list[str] = []

    def taken(strata: Iterable[int]) -> int:
        return sum(have[s] for s in strata)

    def of_source(k: int) -> set[int]:
        return {s for s in sizes if s // 8 == k}

    def open_(strata: Iterable[int]) -> set[int]:
        return {s for s in strata if taken(of_source(s // 8)) < seats[s // 8]}

    def pick(strata: set[int]) -> bool:
        # Of the strata's rows some may be chosen already; a stratum that is used up is left out.
        strata = {s for s in strata if have[s] < sizes[s]}
        found = chooser.pick(strata) if strata else None
        if found is None:
            return False
        ids.append(found)
        have[int(chooser.picks["stratum"].iloc[-1])] += 1
        return True

    def reserve(strata: set[int], wanted: int) -> None:
        wanted = min(int(wanted), sum(sizes[s] for s in strata))
        while taken(strata) < wanted and pick(open_(strata)):
            pass

    reserve({s for s in sizes if s & 4}, settings["selected_hardcase_minimum"])
    reserve({s for s in sizes if not s & 4}, settings["selected_normal_minimum"])
    for i, level in enumerate(LEVELS):
        reserve({s for s in sizes if s & 3 == i}, settings["selection_level_minimums"][level])
    for k, source in enumerate(names):
        while taken(of_source(k)) < seats[k]:
            if not pick(of_source(k)):
                raise SelectionError(f"the quota of {source} can't be met")
    while len(ids) < target:
        if not pick(open_(sizes)):
            raise SelectionError("the pool can't be filled")
    return ids, chooser.asked
