"""Centroid clustering of integer vectors with annulus search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, stash, tidied

#: Components beyond this are refused: squared distances of 64 of them would not fit a long.
LARGEST = 1 << 27
#: Up to this, squared distances of 64 components are whole numbers of doubles, which are faster.
LARGEST_DOUBLE = 1 << 22
#: Vectors that are compared together.
ROWS = 4096


def _kept(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows with exactly ``dims`` finite components, and those components as doubles."""
    long = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(long == dims)
    begin = np.concatenate(([0], np.cumsum(np.maximum(long, 0))))[:-1]
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    if not len(at):
        return at, np.zeros((0, dims))
    rows = flat[begin[at][:, None] + np.arange(dims)]
    good = np.isfinite(rows).all(1)
    return at[good], rows[good]


def quantised(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as long."""
    whole = np.floor(scale * rows)
    if len(whole) and np.abs(whole).max() > LARGEST:
        raise ArithmeticError(f"a component times {scale} is beyond {LARGEST}: squared distances would not fit a long")
    return whole.astype(np.int64)


class Annulus:
    """Centroids sorted by norm, and the search for each vector's nearest one.

    A centroid no farther than u from x has a norm within u of x's. Any centroid's distance gives such a bound u; the
    centroids whose norms lie in the annulus are found by binary search and compared exactly, in whole numbers.
    The annulus is widened by more than the roots can be off, so that nothing on its border is missed.
    """

    def __init__(self, centres: np.ndarray):
        self.centres = centres
        norms = np.sqrt((centres.astype(np.float64) ** 2).sum(1))
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]
        self.small = not len(centres) or np.abs(centres).max() <= LARGEST_DOUBLE

    def nearest(self, rows: np.ndarray, guess: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each row's nearest centroid, of equal ones the smaller number.

        ``guess``: a centroid for each row that may be near; its distance is the bound. Without it the bound is
        the distance of the centroid with the nearest norm.
        """
        which, best = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for lo in range(0, len(rows), ROWS):
            part = slice(lo, lo + ROWS)
            which[part], best[part] = self._nearest(rows[part], None if guess is None else guess[part])
        return which, best

    def _nearest(self, rows: np.ndarray, guess: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        kind = np.float64 if self.small and np.abs(rows).max() <= LARGEST_DOUBLE else np.int64
        x, centres = rows.astype(kind), self.centres.astype(kind)

        def squared(some: np.ndarray, c: np.ndarray) -> np.ndarray:
            apart = some - c
            return np.einsum("ij,ij->i", apart, apart).astype(np.int64)

        norm = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
        if guess is None:
            above = np.clip(np.searchsorted(self.norms, norm), 0, len(centres) - 1)
            below = np.maximum(above - 1, 0)
            guess = self.order[np.where(norm - self.norms[below] < self.norms[above] - norm, below, above)]
        which = guess.astype(np.int64)
        best = squared(x, centres[which])
        bound = np.sqrt(best.astype(np.float64))
        slack = 1e-9 * (norm + bound + 1.0)
        first = np.searchsorted(self.norms, norm - bound - slack, side="left")
        last = np.searchsorted(self.norms, norm + bound + slack, side="right")
        for j, c in enumerate(self.order):
            at = np.flatnonzero((first <= j) & (j < last) & (guess != c))
            if not len(at):
                continue
            d = squared(x[at], centres[c])
            nearer = (d < best[at]) | ((d == best[at]) & (c < which[at]))
            which[at[nearer]], best[at[nearer]] = c, d[nearer]
        return which, best


def _rows_of(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole components) of the vectors that take part."""
    for batch in batches:
        at, rows = _kept(batch.column(1), dims)
        if len(at):
            yield batch.column(0).take(pa.array(at)), quantised(rows, scale)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), pa.array(rows.reshape(-1).astype(np.int32)))


def _whole(dims: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in _rows_of(batches, dims, scale):
            yield pa.RecordBatch.from_arrays([ids, _lists(rows)], ["id", "q"])

    return run


def _placed(centres: np.ndarray, dims: int, scale: int):
    """Whole components of each vector, with the first centroid it goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Annulus(centres)
        for ids, rows in _rows_of(batches, dims, scale):
            yield pa.RecordBatch.from_arrays([ids, _lists(rows), pa.array(search.nearest(rows)[0].astype(np.int32))], ["id", "q", "guess"])

    return run


def _read(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("q").flatten().to_numpy().reshape(-1, dims).astype(np.int64), batch.column("guess").to_numpy()


def _sums(centres: np.ndarray, first: bool):
    """Of each centroid that has any of the partition's vectors: its number, how many, and their sums. The first round's assignment is the guess."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centres.shape
        search = Annulus(centres)
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            rows, guess = _read(batch, dims)
            if not len(rows):
                continue
            which = guess if first else search.nearest(rows, guess)[0]
            by = np.argsort(which, kind="stable")
            found, cut = np.unique(which[by], return_index=True)
            total[found] += np.add.reduceat(rows[by], cut, axis=0)
            n += np.bincount(which, minlength=k)
        at = np.flatnonzero(n)
        if len(at):
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(at) * dims + 1, dims), pa.int32()), pa.array(total[at].reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), lists], ["cluster", "n", "total"])

    return run


def _assigned(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Annulus(centres)
        for batch in batches:
            rows, guess = _read(batch, centres.shape[1])
            if len(rows):
                which, apart = search.nearest(rows, guess)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(which.astype(np.int32)), pa.array(apart)], ["vec_id", "cluster", "distance"])

    return run


def _order(column: Column, salt: int) -> Column:
    """The hash that says which vectors the centroids start as."""
    return F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(column.cast("string"), F.lit(""))), 256)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector with ``dims`` finite components, one row per row.

    Components x become floor(scale * x). Centroids start as the k vectors whose ids have the smallest hashes; each round
    assigns all vectors to their nearest centroid and moves each centroid that has any to the floor of their mean.

    The vectors are written once, as whole numbers with the centroid they first went to, which bounds every later search:
    most vectors stay near it. A round reads them and gives one row of sums for each task and centroid; what reaches
    the driver is k rows, whatever the number of vectors. A lost task is done again from the written rows.

    Defined cases: vectors of another length, null ones and those with null or non-finite components take no part and
    have no row; with fewer than k vectors each is a centroid; ties go to the smaller number; rows that repeat an id
    each take part, a null id hashes as an empty one, and of equal hashes the smaller components come first; an empty
    table gives no rows; other columns are ignored. Components beyond 2^27 after scaling raise ArithmeticError.
    The rows are read from a table in the shared folder, which the caller may ``discard``.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    start = rows.mapInArrow(tidied(_whole(dims, scale)), "id long, q array<int>").orderBy(_order(F.col("id"), salt), "q").limit(k).collect()
    centres = np.array([r.q for r in start], np.int64).reshape(len(start), dims)
    names = "vec_id long, cluster int, distance long"
    if not len(centres):
        return rows.sparkSession.createDataFrame([], names + ", cluster_inertia long, inertia long, centroid_sha256 string")
    placed = stash(rows.mapInArrow(tidied(_placed(centres, dims, scale)), "id long, q array<int>, guess int"), "whole-vectors")
    for r in range(rounds):
        parts = placed.mapInArrow(tidied(_sums(centres, first=not r)), "cluster int, n long, total array<long>")
        moved = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(dims)]).alias("total")).collect()
        centres = centres.copy()
        for row in moved:
            centres[row.cluster] = [x // row.n for x in row.total]
    found = stash(placed.mapInArrow(tidied(_assigned(centres)), names), "assigned-vectors")
    discard(placed)
    # Sums of longs may be no longs.
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(inertia.values())
    about = [(c, inertia[c], total, hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest()) for c in sorted(inertia)]
    per = found.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    out._stashed_at = found._stashed_at
    return out


def cluster_sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: int = 2) -> str:
    """The same in SQL, every vector held against every centroid."""
    parts = [
        f"""WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || coalesce(vec_id::VARCHAR, '')), q) - 1 AS i, vec_id, q FROM
            (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS q FROM embeddings
             WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}))""",
        "e AS MATERIALIZED (SELECT i, unnest(q) AS x, generate_subscripts(q, 1) AS p FROM v)",
        f"c0 AS MATERIALIZED (SELECT i AS c, p, x FROM e WHERE i < {k})",
    ]
    for r in range(rounds + 1):
        parts.append(f"d{r} AS (SELECT e.i, c.c, sum((e.x - c.x) * (e.x - c.x))::BIGINT AS d FROM e JOIN c{r} c USING (p) GROUP BY ALL)")
        parts.append(f"a{r} AS MATERIALIZED (SELECT i, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, c) = 1)")
        if r < rounds:
            parts.append(f"m{r} AS (SELECT a.c, e.p, sum(e.x) AS s, count(*) AS n FROM a{r} a JOIN e USING (i) GROUP BY ALL)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c.c, c.p, coalesce(((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::BIGINT, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (c, p))")
    parts.append(f"h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM c{rounds} GROUP BY c)")
    return ",\n".join(parts) + f"""
        SELECT v.vec_id, a.c::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia, h.centroid_sha256
        FROM a{rounds} a JOIN v USING (i) JOIN h USING (c)"""
