"""Numbers in a global order, and exact quantiles, without bringing all rows to one task."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stash


def _parts(rows: DataFrame) -> int:
    return max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ranked(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``rows`` with 1.. in the given order under ``name``.

    Rows are dealt by ranges of the order, sorted and numbered within each range, and shifted by the rows of the ranges
    before. The ranges' sizes, one row for each partition, are what is broadcast. Ties must be told apart by the order;
    where they aren't, tied rows are numbered in any order, and a range takes all of them.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    # A range is known by the partition it lies in, so the dealing is written down before it is used twice.
    dealt = rows.repartitionByRange(_parts(rows), *keys).sortWithinPartitions(*keys)
    placed = stash(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_k"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_k").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("_p", part).join(F.broadcast(before), "_p").withColumn(name, (inside + F.col("_before")).cast("long")).drop("_p", "_at", "_before")


def ranked_within(rows: DataFrame, keys: list[str], order: list[str | Column], name: str) -> DataFrame:
    """``rows`` with 1.. in the given order within each key under ``name``: places in a global order by key, less the key's first place.

    So a key that holds a third of all rows is numbered by many tasks. NULL is a key like others.
    """
    placed = ranked(rows, [*keys, *order], "_place")
    first = placed.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min("_place").alias("_from"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return placed.join(first, same).withColumn(name, F.col("_place") - F.col("_from") + 1).drop("_place", "_from", *[f"_k{i}" for i in range(len(keys))])


def with_previous(rows: DataFrame, key: str, order: list[str], column: str, name: str) -> DataFrame:
    """``rows`` with the ``column`` of the row before, within the key and in the given order, under ``name``; NULL for a key's first row.

    Rows are dealt by ranges of key and order, so a key that holds very many rows goes on over several stretches, each of
    which hands its last value on to the next: one row for each key and stretch.
    """
    dealt = stash(rows.repartitionByRange(_parts(rows), key, *order).withColumn("_p", F.spark_partition_id()), "stretches")
    last = dealt.groupBy("_p", key).agg(F.max_by(F.struct(F.col(column).alias("v")), F.struct(*order)).alias("_last"))
    handed = last.select(F.col("_p").alias("_at"), F.col(key).alias("_k"), F.lag("_last").over(Window.partitionBy(key).orderBy("_p")).alias("_handed"))
    w = Window.partitionBy("_p", key).orderBy(*order)
    inside = dealt.withColumns({"_n": F.row_number().over(w), "_lag": F.lag(column).over(w)})
    both = inside.join(handed, (F.col("_p") == F.col("_at")) & F.col(key).eqNullSafe(F.col("_k")))
    return both.withColumn(name, F.when(F.col("_n") == 1, F.col("_handed.v")).otherwise(F.col("_lag"))).drop("_p", "_at", "_k", "_n", "_lag", "_handed")


#: Rank error of the sketch is one part in so many; its size grows with it.
ACCURACY = 10_000
#: Distinct values that are gathered for one quantile, about; brackets that hold more are narrowed first.
GATHER = 100_000


@dataclass
class _Place:
    """Where one quantile of one column lies: between two values, as far as is known."""

    column: int
    fraction: float
    at: float = 0.0
    lo: float = 0.0
    hi: float = 0.0
    within: int = 0  # rows in the bracket, at most, but for ties

    def around(self, fraction: float) -> list[float]:
        return [max(0.0, fraction - 4 / ACCURACY), min(1.0, fraction + 4 / ACCURACY)]


def exact_quantiles(rows: DataFrame, columns: list[str], fractions: list[float]) -> dict[str, list[float]]:
    """Exact quantiles, with linear interpolation between neighbours, of several columns of finite doubles; NULLs don't count.

    One pass makes a mergeable sketch of every column, which brackets each wanted place between two values. A second counts
    what lies below each bracket and gathers the distinct values inside with their counts: about eight parts in ACCURACY of
    the rows at most, or all where there are at most ACCURACY. Where that is still too many, brackets are counted and sketched again from the inside first, which
    makes them thousands of times narrower. A column without values has NaN.
    """
    x = [F.col(c).cast("double") for c in columns]
    places = [_Place(i, q) for i in range(len(columns)) for q in fractions]
    wanted = sorted({f for p in places for f in p.around(p.fraction)})
    seen = rows.agg(*[f for i, c in enumerate(x) for f in (F.count(c).alias(f"n{i}"), F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}"), F.percentile_approx(c, wanted, F.lit(ACCURACY)).alias(f"q{i}"))]).first()
    some = [p for p in places if seen[f"n{p.column}"]]
    for p in some:
        n = seen[f"n{p.column}"]
        p.at = p.fraction * (n - 1)
        low, high = p.around(p.fraction)
        # A sketch of few rows is exact, but its ranks may be off by one.
        p.lo = seen[f"l{p.column}"] if low == 0 or n <= ACCURACY else seen[f"q{p.column}"][wanted.index(low)]
        p.hi = seen[f"h{p.column}"] if high == 1 or n <= ACCURACY else seen[f"q{p.column}"][wanted.index(high)]
        p.within = 8 * n // ACCURACY
    while narrow := [p for p in some if p.within > GATHER and p.lo < p.hi]:
        _narrow(rows, x, narrow)
    held = _gathered(rows, x, some)
    out: dict[str, list[float]] = {}
    for p in places:
        values = out.setdefault(columns[p.column], [])
        values.append(_value(p, held[p.column, p.fraction]) if seen[f"n{p.column}"] else float("nan"))
    return out


def _inside(x: Column, p: _Place) -> Column:
    return (x >= F.lit(p.lo)) & (x <= F.lit(p.hi))


def _narrow(rows: DataFrame, x: list[Column], places: list[_Place]) -> None:
    """Count what is below and inside each bracket, then bring the bracket down by a sketch of its inside."""
    counts = rows.agg(*[f for i, p in enumerate(places) for f in (F.count_if(x[p.column] < F.lit(p.lo)).alias(f"b{i}"), F.count_if(_inside(x[p.column], p)).alias(f"n{i}"))]).first()
    sides = [p.around((p.at - counts[f"b{i}"]) / max(1, counts[f"n{i}"] - 1)) for i, p in enumerate(places)]
    seen = rows.agg(*[F.percentile_approx(F.when(_inside(x[p.column], p), x[p.column]), side, F.lit(ACCURACY)).alias(f"q{i}") for i, (p, side) in enumerate(zip(places, sides, strict=True))]).first()
    for i, (p, side) in enumerate(zip(places, sides, strict=True)):
        low, high = seen[f"q{i}"]
        p.lo, p.hi = p.lo if side[0] == 0 else low, p.hi if side[1] == 1 else high
        p.within = 8 * counts[f"n{i}"] // ACCURACY


def _gathered(rows: DataFrame, x: list[Column], places: list[_Place]) -> dict[tuple[int, float], list[tuple[float | None, int]]]:
    """Of each bracket the values inside and their counts, in order; what lies below is counted under None, first."""
    held: dict[tuple[int, float], list] = {(p.column, p.fraction): [] for p in places}
    if not places:
        return held
    value = lambda p: F.when(_inside(x[p.column], p), x[p.column])
    below = lambda p: x[p.column] <= F.lit(p.hi)  # noqa: E731  what is above counts nowhere
    flat = rows.select(F.stack(F.lit(len(places)), *[c for i, p in enumerate(places) for c in (F.when(below(p), F.lit(i)), value(p))]).alias("p", "x"))
    for r in flat.filter("p is not null").groupBy("p", "x").agg(F.count(F.lit(1)).alias("n")).collect():
        held[places[r.p].column, places[r.p].fraction].append((r.x, r.n))
    for found in held.values():
        found.sort(key=lambda v: (v[0] is not None, v[0] or 0.0))
    return held


def _value(p: _Place, found: list[tuple[float | None, int]]) -> float:
    """The value at a place, between its two neighbours in order."""
    first = int(p.at)
    got: list[float] = []
    before = 0
    for v, n in found:
        for k in range(max(0, before - first), 2):
            if v is not None and before <= first + k < before + n:
                got.append(v)
        before += n
    # The last place has no neighbour above.
    if not got or (len(got) == 1 and p.at > first):
        raise ArithmeticError("the sketch is less accurate than it says")
    return got[0] if len(got) == 1 else got[0] + (got[1] - got[0]) * (p.at - first)
