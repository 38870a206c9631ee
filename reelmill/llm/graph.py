"""Connected components by alternating large-star and small-star steps, all in Spark tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stash, tidied


def _stars(edges: DataFrame, centre: str, leaf: str) -> DataFrame:
    """Each (centre, leaf) with the smallest of the centre and its leaves."""
    least = edges.groupBy(F.col(centre).alias("_c")).agg(F.min(leaf).alias("_m"))
    return edges.join(least, F.col(centre) == F.col("_c")).withColumn("_m", F.least("_m", F.col(centre)))


def _are_stars(edges: DataFrame) -> bool:
    """Every u has one v, and no v is a u: nothing is left to move."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("head")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("head")))
    return not ends.groupBy("x").agg(F.sum("leaf").alias("n"), F.max("head").alias("h")).filter("n > 1 or (n = 1 and h = 1)").limit(1).count()


#: Up to so many edges a single task finds the components; its memory is bounded by that.
ONE_TASK_EDGES = 500_000


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.setdefault(x, x)) != x:
            above[x] = x = above[y]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = top(a), top(b)
            above[max(a, b)] = min(a, b)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())], ["node", "component"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node each node reaches, for nodes that have an edge (a, b), a != b."""
    if edges.limit(ONE_TASK_EDGES + 1).count() <= ONE_TASK_EDGES:
        return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a != b").coalesce(1).mapInArrow(tidied(_union_find), "node long, component long")
    now = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    for _ in range(most_rounds):
        if _are_stars(now):
            break
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, "u", "v").filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).filter("u != v").distinct()
        star = _stars(large, "u", "v")
        small = star.select(F.col("v").alias("u"), F.col("_m").alias("v")).unionByName(star.select("u", F.col("_m").alias("v"))).filter("u != v").distinct()
        now = stash(small, "edges")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
