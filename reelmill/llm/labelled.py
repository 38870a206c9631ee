"""Deterministic, bounded samples of labelled texts for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % folds


def sample_ids(table: DataFrame, most: int, seed: int) -> DataFrame:
    """The ``most`` distinct ids whose hashes are smallest, with one row each: at most that many whatever the size of the table, and the same each time.

    Only ids below a hash that about four times as many reach are made distinct, so nearly no id is shuffled; where
    repeated ids leave too few of them, all are.
    """
    order = F.xxhash64(F.col("doc_id"), F.lit(seed))
    rows = table.count()
    border = int(min(1.0, 4 * most / max(1, rows)) * (1 << 64)) - (1 << 63) - 1
    low = table.filter(order <= F.lit(border)).dropDuplicates(["doc_id"])
    if border < (1 << 63) - 1 and low.limit(most).count() < most:
        low = table.dropDuplicates(["doc_id"])
    return low.orderBy(order, "doc_id").limit(most)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One text for each row of a bounded sample of ids: of an id's texts the one with the smallest hash.

    The sample is what gets broadcast, so no text is shuffled but those of the sample, once per task and id.
    """
    mine = [c for c in ids.columns if c != "doc_id"]
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", *mine).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
