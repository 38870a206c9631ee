"""Shards by a Feistel permutation of the global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stash, text_or_empty
from .words import U, mix

ROUNDS = 6


class Permutation:
    """A bijection of 0..n-1 that needs no table: Feistel rounds over the next even number of bits, walked until inside."""

    def __init__(self, n: int, seed: int = 0):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = U((1 << self.half) - 1)
        self.keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(seed & 0xFFFFFFFFFFFFFFFF))

    def _through(self, x: np.ndarray, keys: np.ndarray, back: bool = False) -> np.ndarray:
        left, right = x >> U(self.half), x & self.mask
        for k in keys:
            if back:
                left, right = right ^ (mix(left ^ k) & self.mask), left
            else:
                left, right = right, left ^ (mix(right ^ k) & self.mask)
        return (left << U(self.half)) | right

    def _walk(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        x = self._through(np.asarray(x, np.uint64), keys, back)
        while (out := x >= U(self.n)).any():
            x[out] = self._through(x[out], keys, back)
        return x.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys, False) if len(x) else np.zeros(0, np.int64)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys[::-1], True) if len(x) else np.zeros(0, np.int64)


def shard(docs: DataFrame, shards: int = 8, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number.

    The law is ``rows``: the rows are numbered in the order of their ids, the number goes through the
    permutation, and the result's remainder and quotient by the number of shards are shard and slot. So counts
    are at most one apart, slots are gapless, and either can be computed from a row number and the row count.

    Only (id, checksum, size) is shuffled, by range. The numbering takes one count per partition to the driver.

    Defined cases: a null text has size 1 and the checksum of no bytes; null ids come first; rows that repeat
    an id follow each other by checksum and size, so the result doesn't depend on the files' order; an empty
    table gives no rows; other columns are ignored. Equal texts need not meet in a shard under this law.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(F.col(text_col).isNull(), F.lit(1)).otherwise(F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    ranged = rows.repartitionByRange(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), *order).sortWithinPartitions(*order)
    placed = stash(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_at", 33)
    counts = {r[0]: r[1] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1))).collect()}
    offsets, n = {}, 0
    for p in sorted(counts):
        offsets[p] = n
        n += counts[p]
    table = spark.createDataFrame(sorted(offsets.items()), "_part long, _offset long")
    where = Permutation(n, seed)

    @F.pandas_udf("long")
    def permuted(x: pd.Series) -> pd.Series:
        return pd.Series(where.forward(x.to_numpy().astype(np.uint64)))

    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(table), "_part")  # a row for each partition of the shuffle above
        .withColumn("row_number", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_offset"))
        .withColumn("_to", permuted("row_number"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            (F.col("_to") % shards).cast("int").alias("shard"),
            F.expr(f"_to div {shards}").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "row_number",
        )
    )
