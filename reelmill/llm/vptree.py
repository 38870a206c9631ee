"""Nearest neighbours by cosine with a vantage-point tree for each shard of the vectors.

The shards are the leaves of a coarse vantage-point tree, so that a query can pass over whole shards: first it is
searched in the shard it would lie in, then in those that the triangle inequality can't rule out with what was found.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import discard, stash, tidied

#: Rows of a shard, and queries that are searched in one go.
SHARD_ROWS = 4096
QUERY_ROWS = 4096
#: Vectors that the coarse tree is fitted on, at most; every row is in the index. A leaf holds so many of them at least.
MOST_SAMPLE = 16_384
SAMPLE_LEAF = 8
#: Few comparisons at a time cost more than those that a deeper tree would pass over.
LEAF = 256
#: Distances of unit vectors are right to about this, or where they have many components to the root of their roundings.
ROUNDING = 1e-7
TIED_ROWS = 128


class VpTree:
    """A vantage-point tree over the distinct vectors of a shard, each with its ids.

    Distances are those of unit vectors, which fall as the cosine rises and obey the triangle inequality.
    Of equal vectors only the ``most`` smallest ids are kept: ties go to smaller ids, so no other can be asked for.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, most: int, seed: int = 0):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order], np.float64)
        self.vectors, inverse = np.unique(vectors, axis=0, return_inverse=True)
        inverse = inverse.reshape(-1)
        by = np.argsort(inverse, kind="stable")
        starts = np.searchsorted(inverse[by], np.arange(len(self.vectors)))
        ends = np.append(starts[1:], len(by))
        self.ids = [np.unique(ids[by[a:b]])[:most] for a, b in zip(starts, ends, strict=True)]
        self.unit = self.vectors / np.sqrt((self.vectors * self.vectors).sum(1))[:, None]
        self.rounding = max(ROUNDING, float(np.sqrt(8 * np.finfo(np.float64).eps * self.unit.shape[1])))
        self.nodes: list[tuple] = []
        rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(self.vectors)), rng)

    def _build(self, rows: np.ndarray, rng: np.random.Generator) -> int:
        if len(rows) <= LEAF:
            self.nodes.append((rows,))
            return len(self.nodes) - 1
        at = int(rng.integers(len(rows)))
        point, rest = int(rows[at]), np.delete(rows, at)
        d = _distance(self.unit[rest], self.unit[point][None])[:, 0]
        half = float(np.median(d))
        inside = d <= half
        if inside.all():  # all as far away: no split does anything
            self.nodes.append((rows,))
            return len(self.nodes) - 1
        low, high = self._build(rest[inside], rng), self._build(rest[~inside], rng)
        self.nodes.append((point, half, low, high))
        return len(self.nodes) - 1

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the k nearest distinct vectors for each query, -1 where there are fewer, and their distances.

        A side of a node is passed over where its border is farther than ``factor`` times the k-th best distance so
        far. With a factor of one nothing nearer can be missed; smaller factors pass over more. With a ``reach`` for each
        query only what is not farther is asked for.
        """
        q = queries / np.sqrt((queries * queries).sum(1))[:, None]
        best = np.full((len(q), k), np.inf)
        rows = np.full((len(q), k), -1)
        limit = np.full(len(q), np.inf) if reach is None else reach + 2 * self.rounding
        worst = limit.copy()

        def take(of: np.ndarray, found: np.ndarray) -> np.ndarray:
            d = _distance(q[of], self.unit[found])
            nearer = np.flatnonzero(d.min(1) < worst[of])
            if len(nearer):
                of, closer = of[nearer], d[nearer]
                both = np.concatenate((best[of], closer), 1)
                names = np.concatenate((rows[of], np.broadcast_to(found, closer.shape)), 1)
                pick = np.argpartition(both, k - 1, axis=1)[:, :k]
                best[of] = kept = np.take_along_axis(both, pick, 1)
                rows[of] = np.take_along_axis(names, pick, 1)
                worst[of] = np.minimum(limit[of], kept.max(1))
            return d

        # (node, queries, border distance of each query to this side)
        stack = [(self.root, np.arange(len(q)), np.zeros(len(q)))]
        while stack:
            node, of, border = stack.pop()
            open_ = border <= factor * worst[of] + self.rounding
            of = of[open_]
            if not len(of):
                continue
            here = self.nodes[node]
            if len(here) == 1:
                take(of, here[0])
                continue
            point, half, low, high = here
            d = take(of, np.array([point]))[:, 0]
            inside = d <= half
            gap = np.abs(d - half)
            none = np.zeros(len(of))
            # Last in, first out: each query's own side is searched before the other.
            stack.append((high, of[inside], gap[inside]))
            stack.append((low, of[~inside], gap[~inside]))
            stack.append((low, of[inside], none[inside]))
            stack.append((high, of[~inside], none[~inside]))
        return rows, best

    def within(self, queries: np.ndarray, reach: np.ndarray, factor: float = 1.0) -> list[np.ndarray]:
        """For each query all rows no farther than its ``reach``, which with smaller factors may pass over some."""
        q = queries / np.sqrt((queries * queries).sum(1))[:, None]
        whose, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def take(of: np.ndarray, rows: np.ndarray) -> np.ndarray:
            d = _distance(q[of], self.unit[rows])
            i, j = np.nonzero(d <= reach[of][:, None])
            whose.append(of[i])
            found.append(rows[j])
            return d

        stack = [(self.root, np.arange(len(q)))]
        while stack:
            node, of = stack.pop()
            if not len(of):
                continue
            here = self.nodes[node]
            if len(here) == 1:
                take(of, here[0])
                continue
            point, half, low, high = here
            d = take(of, np.array([point]))[:, 0]
            open_ = factor * reach[of] + self.rounding
            stack.append((low, of[d - half <= open_]))
            stack.append((high, of[half - d <= open_]))
        by = np.concatenate(whose)
        order = np.argsort(by, kind="stable")
        return np.split(np.concatenate(found)[order], np.searchsorted(by[order], np.arange(1, len(q))))

    def nearest(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float = 1.0, reach: np.ndarray | None = None) -> list[tuple[int, int, float]]:
        """(query, id, cosine) of each query's k nearest rows but itself, ties to smaller ids; with a ``reach`` rows that are farther may be missing."""
        queries = np.ascontiguousarray(queries, np.float64)
        keep = min(len(self.vectors), k + 8)
        found, distances = self.search(queries, keep, factor, reach)
        kept = [rows[rows >= 0] for rows in found]
        if k < keep < len(self.vectors):
            # A query's own vector aside, k others are enough, but all that tie with the last of them are asked for.
            far = np.sort(distances, axis=1)[:, [k, -1]]
            tied = np.flatnonzero(far[:, 1] <= far[:, 0] + 2 * self.rounding)
            for at in range(0, len(tied), TIED_ROWS):
                part = tied[at : at + TIED_ROWS]
                for i, rows in zip(part, self.within(queries[part], far[part, 0] + self.rounding, factor), strict=True):
                    kept[i] = np.union1d(kept[i], rows)
        out = []
        for i, q in enumerate(queries):
            rows = kept[i]
            score = cosine(self.vectors[rows], q)
            all_ids = np.concatenate([self.ids[r] for r in rows]) if len(rows) else np.zeros(0, np.int64)
            all_scores = np.repeat(score, [len(self.ids[r]) for r in rows])
            other = all_ids != ids[i]
            all_ids, all_scores = all_ids[other], all_scores[other]
            for j in np.lexsort((all_ids, -all_scores))[:k]:
                out.append((int(ids[i]), int(all_ids[j]), float(all_scores[j])))
        return out


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def cosine(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (rows * q).sum(1) / (np.sqrt((rows * rows).sum(1)) * np.sqrt((q * q).sum()))


class CoarseTree:
    """Vantage points fitted on a sample; its leaves are shards. Of a leaf's rows it knows how far they are from each vantage point above it."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 0):
        self.points: list[np.ndarray] = []
        self.half: list[float] = []
        self.sides: list[tuple[int, int]] = []  # children: a node, or ~leaf
        self.leaves = 0
        self.above: list[list[int]] = []  # of each leaf, the nodes from the root down
        unit = sample / np.sqrt((sample * sample).sum(1))[:, None] if len(sample) else sample
        self.root = self._grow(unit, leaves, np.random.default_rng(seed), [])
        self.low = [np.zeros(len(a)) for a in self.above]
        self.high = [np.full(len(a), np.inf) for a in self.above]

    def _grow(self, unit: np.ndarray, leaves: int, rng: np.random.Generator, above: list[int]) -> int:
        if leaves > 1 and len(unit) >= 2 * SAMPLE_LEAF:
            point = unit[int(rng.integers(len(unit)))]
            d = _distance(unit, point[None])[:, 0]
            half = float(np.median(d))
            inside = d <= half
            if not inside.all():
                node = len(self.points)
                self.points.append(point)
                self.half.append(half)
                self.sides.append((0, 0))
                low = self._grow(unit[inside], leaves // 2, rng, [*above, node])
                high = self._grow(unit[~inside], leaves - leaves // 2, rng, [*above, node])
                self.sides[node] = (low, high)
                return node
        self.above.append(above)
        self.leaves += 1
        return ~(self.leaves - 1)

    def route(self, vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The leaf of each vector, and its distances from the vantage points above that leaf."""
        unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
        leaf, away = np.zeros(len(unit), np.int64), [[] for _ in range(len(unit))]
        stack = [(self.root, np.arange(len(unit)))]
        while stack:
            node, of = stack.pop()
            if node < 0:
                leaf[of] = ~node
                continue
            d = _distance(unit[of], self.points[node][None])[:, 0]
            for i, x in zip(of.tolist(), d.tolist(), strict=True):
                away[i].append(x)
            inside = d <= self.half[node]
            for side, mine in zip(self.sides[node], (of[inside], of[~inside]), strict=True):
                if len(mine):
                    stack.append((side, mine))
        return leaf, away

    def bound(self, leaf: int, low: list[float], high: list[float]) -> None:
        self.low[leaf], self.high[leaf] = np.array(low, float), np.array(high, float)

    def visits(self, queries: np.ndarray, reach: np.ndarray, rounding: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of every leaf that may hold a row within a query's reach."""
        unit = queries / np.sqrt((queries * queries).sum(1))[:, None]
        d = _distance(unit, np.array(self.points).reshape(-1, unit.shape[1])) if self.points else np.zeros((len(unit), 0))
        whose, where = [], []
        for leaf, above in enumerate(self.above):
            away = d[:, above]
            gap = np.maximum(away - self.high[leaf], self.low[leaf] - away).max(1, initial=0.0)
            mine = np.flatnonzero(gap <= reach + 2 * rounding)
            whose.append(mine)
            where.append(np.full(len(mine), leaf))
        return np.concatenate(whose), np.concatenate(where)


def _routed(trees: dict[int, CoarseTree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width, v = batch.column(2).to_numpy(), batch.column(1)
            leaf, away = np.zeros(len(width), np.int64), [[] for _ in range(len(width))]
            for w in np.unique(width):
                mine = np.flatnonzero(width == w)
                if int(w) in trees:
                    found, far = trees[int(w)].route(_matrix(v.take(pa.array(mine)), int(w)))
                    leaf[mine] = found
                    for i, x in zip(mine.tolist(), far, strict=True):
                        away[i] = x
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32)), pa.array(away, pa.list_(pa.float64()))], [*batch.schema.names, "leaf", "away"])

    return run


def _matrix(v: pa.Array, width: int) -> np.ndarray:
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _visits(trees: dict[int, CoarseTree], factor: float):
    """Queries with a row for each leaf they have to see."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            most = max([1, *(t.leaves for t in trees.values())])
            step = max(1, 20_000 // most)
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                width, reach = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                rows, leaves = [], []
                for w in np.unique(width):
                    mine = np.flatnonzero(width == w)
                    if int(w) in trees:
                        q, leaf = trees[int(w)].visits(_matrix(batch.column(1).take(pa.array(mine)), int(w)), factor * reach[mine], _rounding(int(w)))
                    else:
                        q, leaf = np.arange(len(mine)), np.zeros(len(mine), np.int64)
                    rows.append(mine[q])
                    leaves.append(leaf)
                at_rows = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([*(c.take(at_rows) for c in batch.columns[:4]), pa.array(np.concatenate(leaves).astype(np.int32))], [*batch.schema.names[:4], "leaf"])

    return run


def _rounding(width: int) -> float:
    return max(ROUNDING, float(np.sqrt(8 * np.finfo(np.float64).eps * width)))


def _tree(most: int):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        tree = VpTree(part["vec_id"].to_numpy(np.int64), np.stack(part["v"].to_numpy()).astype(np.float64), most)
        away = np.stack([np.asarray(x, float) for x in part["away"]]) if len(part["away"].iloc[0]) else np.zeros((len(part), 0))
        return pd.DataFrame({"width": [key[0]], "leaf": [key[1]], "sub": [key[2]], "tree": [pickle.dumps(tree)], "low": [away.min(0).tolist()], "high": [away.max(0).tolist()]})

    return run


def _search(k: int, factor: float):
    def run(key: tuple, asked: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or trees.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        tree = pickle.loads(trees["tree"].iloc[0])
        reach = asked["reach"].to_numpy(float)
        found = tree.nearest(asked["vec_id"].to_numpy(np.int64), np.stack(asked["v"].to_numpy()).astype(np.float64), k, factor, np.where(np.isnan(reach), np.inf, reach))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return run


def nearest_neighbours(vectors: DataFrame, k: int = 5, every: int = 50, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank from 1, vec_id, score: the k nearest rows by cosine of each row whose id is divisible by ``every``.

    Every row is in the index: a coarse tree, fitted on a bounded sample, deals the rows to shards of about SHARD_ROWS;
    a leaf that grew beyond that is dealt on by a hash of the id. Of equal vectors only as many as can be asked for are
    kept, so copies fill no shard. A query is searched in its own shard, then in every shard that may hold a row
    nearer than the k-th found there. A task loads one tree and takes up to about QUERY_ROWS queries through it; the queries move,
    not the trees. What the shards find nearest, k rows for a query, is then ranked. With factor 1, the
    default, the search is exact: all vectors that tie with a shard's k-th best are met, however many, before ties go to
    smaller ids. Where vectors lie so that no shard can be ruled out, every query sees every shard.

    Defined cases: vectors that are null, empty, zero, or have null or non-finite components take no part, nor
    do rows with a null id; vectors of different lengths never meet; a repeated row is a candidate once, and of rows that repeat an id
    with other vectors the smallest vector asks, and the nearest answers; vectors of very large or small components are scaled
    by a power of two first, which leaves their cosines as they are; a query with
    fewer than k candidates has as many rows; an empty table gives no rows; other columns are ignored. The rows are read
    from a table in the shared folder, which the caller may ``discard``; all others are deleted.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
        .filter("vec_id is not null and v is not null and size(v) > 0")
        .filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
        .filter(F.exists("v", lambda x: x != 0))
        .withColumn("width", F.size("v"))
    )
    # Squares of very large or small components are no doubles. A power of two changes no cosine.
    most = F.array_max(F.transform("v", lambda x: F.abs(x)))
    scaled = lambda by: F.transform("v", lambda x: x * F.lit(by))
    rows = stash(rows.withColumn("v", F.when(most > 1e100, scaled(2.0**-600)).when(most < 1e-100, scaled(2.0**600)).otherwise(F.col("v"))), "vectors")
    # A limit on the place within a group is applied before the shuffle, so copies by the million cost no task more.
    copies = Window.partitionBy("v").orderBy("vec_id")
    index = stash(rows.dropDuplicates(["vec_id", "v"]).withColumn("_n", F.row_number().over(copies)).filter(F.col("_n") <= k + 1).drop("_n"), "distinct-vectors")
    sizes = {r[0]: r[1] for r in index.groupBy("width").agg(F.count(F.lit(1))).collect()}
    sample = index.orderBy(F.xxhash64("vec_id"), "vec_id").limit(MOST_SAMPLE).collect()
    trees = {w: CoarseTree(np.array([r.v for r in sample if r.width == w], float).reshape(-1, w), -(-n // SHARD_ROWS)) for w, n in sizes.items() if n > SHARD_ROWS}
    routed = "vec_id long, v array<double>, width int, leaf int, away array<double>"
    dealt = stash(index.select("vec_id", "v", "width").mapInArrow(tidied(_routed(trees)), routed), "routed")
    subs = stash(dealt.groupBy("width", "leaf").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("subs")), "leaves")
    in_sub = F.pmod(F.xxhash64("vec_id"), F.col("subs")).cast("int")
    shards = dealt.join(F.broadcast(subs), ["width", "leaf"]).withColumn("sub", in_sub)  # at most as many leaves as the sample has rows
    built = stash(shards.select("width", "leaf", "sub", "vec_id", "v", "away").groupBy("width", "leaf", "sub").applyInPandas(_tree(k + 1), "width int, leaf int, sub int, tree binary, low array<double>, high array<double>"), "vp-trees")
    bounds = built.select("width", "leaf", F.posexplode(F.arrays_zip("low", "high")).alias("at", "b")).groupBy("width", "leaf", "at").agg(F.min("b.low").alias("low"), F.max("b.high").alias("high"))
    of_leaf: dict[tuple[int, int], list] = {}
    for r in sorted(bounds.collect(), key=lambda r: (r.width, r.leaf, r["at"])):
        of_leaf.setdefault((r.width, r.leaf), []).append((r.low, r.high))
    for (w, leaf), b in of_leaf.items():
        trees[w].bound(leaf, [x for x, _ in b], [x for _, x in b])
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = queries.withColumn("width", F.size("v")).select("vec_id", "v", "width")
    home = stash(queries.mapInArrow(tidied(_routed(trees)), routed).drop("away").join(F.broadcast(subs), ["width", "leaf"], "left").withColumn("sub", F.coalesce(in_sub, F.lit(0))), "queries")

    def searched(asked: DataFrame) -> DataFrame:
        """What (vec_id, v, width, leaf, sub, reach) find in their shards."""
        keys = ["width", "leaf", "sub"]
        load = asked.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("blocks"))
        load = stash(load, "blocks")
        # Blocks are as many as shards, or as loads of queries for them; they are joined, not broadcast, for they grow.
        parts = asked.join(load, keys).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("blocks")).cast("int")).select(*keys, "block", "vec_id", "v", "reach")
        sent = built.select(*keys, "tree").join(load, keys).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*keys, "block", "tree")
        by = [*keys, "block"]
        out = stash(parts.groupBy(*by).cogroup(sent.groupBy(*by)).applyInPandas(_search(k, factor), "query_id long, vec_id long, score double"), "found")
        discard(load)
        return out

    first = searched(home.select("vec_id", "v", "width", "leaf", "sub", F.lit(None).cast("double").alias("reach")))
    enough = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) >= k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.min("score")))).alias("reach"))
    reached = home.join(enough, "vec_id", "left").select("vec_id", "v", "width", F.coalesce("reach", F.lit(float("inf"))).alias("reach"), F.col("leaf").alias("_leaf"), F.col("sub").alias("_sub"))
    seen = reached.select("vec_id", "v", "width", "reach").mapInArrow(tidied(_visits(trees, factor)), "vec_id long, v array<double>, width int, reach double, leaf int")
    visits = seen.join(F.broadcast(subs), ["width", "leaf"]).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).drop("subs")
    other = visits.join(reached.select("vec_id", F.col("_leaf").alias("leaf"), F.col("_sub").alias("sub")), ["vec_id", "leaf", "sub"], "left_anti")
    second = searched(other)
    found = first.unionByName(second).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    out = stash(best.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")
    discard(rows, index, dealt, subs, built, home, first, second)
    return out
