"""Splits that keep groups whole, their coverage and their leaks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import ranked


def assign_split(rows: DataFrame, key: str, ratio: float = 0.7, seed: int = 42) -> DataFrame:
    """``split``: the groups whose hashes are smallest are dev, as many as the ratio asks for; the others are test.

    With more than one group each side has at least one. Only the distinct groups are ordered.
    """
    groups = rows.select(key).distinct().withColumn("_h", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256))
    size = groups.agg(F.count(F.lit(1)).alias("_n"))
    wanted = F.when(F.col("_n") > 1, F.greatest(F.lit(1), F.least(F.col("_n") - 1, F.bround(F.col("_n") * ratio)))).otherwise(F.bround(F.col("_n") * ratio))
    ordered = ranked(groups, ["_h", key], "_r").crossJoin(F.broadcast(size))  # one row
    split = ordered.select(key, F.when(F.col("_r") <= wanted, "dev").otherwise("test").alias("split"))
    return rows.join(split, key)


def coverage(scenarios: DataFrame, splits: DataFrame) -> DataFrame:
    """Approved scenarios by split."""
    rows = scenarios.filter("review_status = 'approved'").join(splits.select("clip_id", "split"), "clip_id")
    return rows.groupBy("scenario").agg(F.count_if(F.col("split") == "dev").alias("count_dev"), F.count_if(F.col("split") == "test").alias("count_test"), F.count(F.lit(1)).alias("total"))


def leakage(splits: DataFrame, key: str) -> DataFrame:
    return splits.groupBy(key).agg(F.count_distinct("split").alias("splits")).filter("splits > 1")


def summary(clips: DataFrame, splits: DataFrame, scenarios: DataFrame) -> DataFrame:
    """One row: clips by split, cameras, duration, clips with positive and negative scenarios."""
    kinds = scenarios.groupBy("clip_id").agg(F.max((F.col("scenario_group") == "positive").cast("int")).alias("pos"), F.max((F.col("scenario_group") == "negative").cast("int")).alias("neg"))
    rows = clips.join(splits.select("clip_id", "split"), "clip_id", "left").join(kinds, "clip_id", "left")
    return rows.agg(
        F.count(F.lit(1)).alias("clips"),
        F.count_if(F.col("split") == "dev").alias("dev_clips"),
        F.count_if(F.col("split") == "test").alias("test_clips"),
        F.count_distinct("camera_id").alias("cameras"),
        F.round(F.sum("duration_sec"), 6).alias("total_duration_sec"),
        F.count_if(F.col("pos") == 1).alias("positive_clips"),
        F.count_if(F.col("neg") == 1).alias("negative_clips"),
    )
