"""Preferred rows, duplicate groups, first-wins indexes and fallback matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .ranking import ranked


def first_per_key(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order; a total order makes it the same every time.

    Spark keeps one row of each key in a task before it shuffles (a window group limit), so no key is too large.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def preferred_sources(items: DataFrame) -> DataFrame:
    """Reasons why an item is a duplicate: of its source item, or of its content among those that won there.

    Valid items go before others, original file names before others, then the path decides.
    """
    order = F.struct(F.when(F.col("status") == "valid", 0).otherwise(1).alias("a"), F.when(F.col("filename") == "source.mp4", 0).otherwise(1).alias("b"), F.col("local_path").alias("c"), F.col("video_id").alias("d"))
    source, content = F.nullif(F.col("source_video_id"), F.lit("")), F.nullif(F.col("sha256"), F.lit(""))
    rows = items.withColumns({"_source": source, "_content": content, "_order": order})
    # Items without a source or without content are nobody's duplicates and take no part in the aggregates. These are
    # summed up before the shuffle, so a source that holds a third of all items is one row of each task.
    best = rows.filter("_source is not null").groupBy(F.col("_source").alias("_s")).agg(F.min("_order").alias("_best"))
    one = rows.join(best, F.col("_source") == F.col("_s"), "left").withColumn("_first", F.coalesce(F.col("_order") == F.col("_best"), F.col("_source").isNull()))
    kept = one.filter("_first and _content is not null").groupBy(F.col("_content").alias("_c")).agg(F.min("_order").alias("_kept"))
    two = one.join(kept, F.col("_content") == F.col("_c"), "left").withColumn("_again", F.col("_first") & F.coalesce(F.col("_order") != F.col("_kept"), F.lit(False)))
    return two.select(*items.columns, (~F.col("_first")).alias("duplicate_source"), F.col("_again").alias("duplicate_checksum"))


def review_reasons(items: DataFrame, min_duration: float, min_width: int, min_height: int) -> DataFrame:
    """Items with their reasons against, in a fixed order; numbers that can't be read skip their checks."""
    d, w, h = (S.number_in(items, c) for c in ("duration_sec", "width", "height"))
    return preferred_sources(items).withColumn(
        "review_reason",
        S.joined_reasons(
            ("invalid_video", F.col("status") == "invalid"),
            ("too_short", d < min_duration),
            ("unsupported_resolution", (w < min_width) | (h < min_height)),
            ("duplicate_source_video_id", F.col("duplicate_source")),
            ("duplicate_checksum", F.col("duplicate_checksum")),
        ),
    )


def duplicate_groups(clips: DataFrame, id_col: str = "clip_id", hash_col: str = "sha256") -> DataFrame:
    """Members of groups of equal content, labelled in the order of the hash, each with another member beside it.

    Groups are found by an aggregate that is summed up before the shuffle; only hashes that occur more than once
    are ranked and joined back, so a group's size costs nothing.
    """
    rows = clips.filter(F.coalesce(F.col(hash_col), F.lit("")) != "").select(F.col(id_col).alias("clip_id"), F.col(hash_col).alias("sha256"))
    pairs = rows.groupBy("sha256").agg(F.count(F.lit(1)).alias("members"), F.min("clip_id").alias("_a")).filter("members > 1")
    # The second smallest id is what the smallest is related to.
    second = rows.join(pairs, "sha256").filter("clip_id != _a").groupBy("sha256").agg(F.min("clip_id").alias("_b"))
    named = ranked(pairs, ["sha256"], "_k").withColumn("duplicate_group", F.format_string("DUP%03d", F.col("_k"))).drop("_k").join(second, "sha256", "left")
    return rows.join(named, "sha256").select(
        "clip_id", "sha256", "duplicate_group", "members", F.when(F.col("clip_id") == F.col("_a"), F.coalesce("_b", "_a")).otherwise(F.col("_a")).alias("related_clip_id")
    )


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")


def fallback_match(files: DataFrame, manifest: DataFrame, file_path: str = "path", manifest_path: str = "local_path") -> DataFrame:
    """Files with the manifest row of their path, or else of their base name where the manifest has that name once."""
    full = manifest.groupBy(F.col(manifest_path).alias("_p")).agg(F.max_by("clip_id", "ordinal").alias("by_path"))
    names = manifest.withColumn("_n", S.basename(manifest_path)).groupBy("_n").agg(F.count(F.lit(1)).alias("_k"), F.min("clip_id").alias("by_name")).filter("_k = 1")
    return (
        files.withColumn("_n", S.basename(file_path))
        .join(full, F.col(file_path) == F.col("_p"), "left")
        .join(names.select("_n", "by_name"), "_n", "left")
        .select(*files.columns, F.coalesce("by_path", "by_name").alias("clip_id"), F.when(F.col("by_path").isNotNull(), "path").when(F.col("by_name").isNotNull(), "basename").otherwise("none").alias("matched_by"))
    )


def collision_suffix(files: DataFrame, id_col: str = "clip_id", path_col: str = "path") -> DataFrame:
    """Files with an id that a file of a smaller path has get a suffix from their path's hash; rows that repeat a path are one file and get one id.

    Only ids that are taken twice, with their smallest path, are joined back, so an id's files need not meet in a task.
    """
    path = F.struct(F.col(path_col).alias("p"))
    taken = files.groupBy(F.col(id_col).alias("_id")).agg(F.min(path).alias("_first"), F.max(path).alias("_last")).filter(~F.col("_first").eqNullSafe(F.col("_last")))
    suffixed = F.concat(id_col, F.lit("-"), F.substring(F.sha2(path_col, 256), 1, 8))
    later = F.col("_first").isNotNull() & ~path.eqNullSafe(F.col("_first"))
    return files.join(taken, F.col(id_col) == F.col("_id"), "left").withColumn(id_col, F.when(later, suffixed).otherwise(F.col(id_col))).select(*files.columns)
