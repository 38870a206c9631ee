"""Exact duplicates by a 128-bit content hash, with the bytes compared inside each hash group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import kept_rows, stash, text_or_empty

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def content_hash(text: Column) -> Column:
    """128 bits of content hash."""
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after A-Z is lower-cased; of equal texts the row with the largest id stays.

    How: rows are grouped by (hash, text), so the grouping itself compares the bytes, and it is summed up
    before the shuffle: a group of copies, whatever its size, leaves each map task as one row. The groups
    without their texts are kept as a narrow table; each row then finds its group by the hash alone. Should
    one hash stand for several texts, the rows of just those hashes look up their group by hash and text.
    The row side of the join is a plain shuffle, which adaptive execution splits for a hot hash.

    Defined cases: a null text counts as empty; empty texts form a group; a null id never stays unless
    all ids of the group are null (keep_id is null then, and kept is true); rows that repeat the id that
    stays are one document, all kept; an empty table gives no rows; other columns are ignored.
    """
    norm = F.translate(text_or_empty(text_col), UPPER, UPPER.lower())
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.alias("_norm")).select("doc_id", "_norm", hash_of(F.col("_norm")).alias("_hash"))
    groups = stash(
        rows.groupBy("_hash", "_norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_hash", F.sha2("_norm", 256).alias("text_sha256"), "keep_id", "group_size"),
        "groups",
    )
    several = groups.groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts")).filter("_texts > 1").select("_hash")
    members = rows.select("doc_id", "_hash")
    if several.limit(1).count():
        clashes = stash(several, "clashes")
        texts = stash(
            rows.join(clashes, "_hash", "left_semi")
            .groupBy("_hash", "_norm")
            .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .withColumn("text_sha256", F.sha2("_norm", 256)),
            "clash-texts",
        )
        apart = rows.join(clashes, "_hash", "left_semi").join(texts, ["_hash", "_norm"]).select("doc_id", "text_sha256", "keep_id", "group_size")
        found = members.join(groups.join(clashes, "_hash", "left_anti"), "_hash").select("doc_id", "text_sha256", "keep_id", "group_size").unionByName(apart)
    else:
        found = members.join(groups, "_hash")
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text of ``docs`` that differs after A-Z is lower-cased, all columns as they were.

    Each row is judged for itself, by its id and text: the row with the largest id stays, and where several rows hold
    both that id and that text, one of them (by a hash of all columns). Whole texts are not shuffled a second time.

    Defined cases: a null text counts as empty, so of null and empty texts one row stays; a null id stays only where
    all ids of a text are null; a row with a text of its own stays, whatever its id; an empty table gives no rows;
    other columns may have any names.
    """
    found = exact_dedup(docs, id_col, text_col).filter("group_size > 1")
    verdicts = found.select("doc_id", F.unhex("text_sha256").alias("key"), "kept")
    return kept_rows(docs, verdicts, lambda text: F.unhex(F.sha2(F.translate(text_or_empty(text), UPPER, UPPER.lower()), 256)), id_col, text_col)
