"""Row-wise filtering by decisions, and a column helper; intermediate tables are those of ``reelmill.storage``."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import discard, stash

__all__ = ["discard", "kept_rows", "place_of", "stash", "text_or_empty", "tidied"]

ArrowMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidied(run: ArrowMap) -> ArrowMap:
    """An Arrow map that gives freed memory back to the system after each partition: a worker that waits for its next task holds little."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library keeps what it keeps

    return whole


#: Decisions on up to so many rows (about 50 bytes each) are broadcast; beyond it the rows are joined by a shuffle.
MOST_BROADCAST = 500_000


def kept_rows(docs: DataFrame, verdicts: DataFrame, key: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the verdicts keep, all columns as they were.

    ``verdicts`` has a row (doc_id, key, kept) for each row of ``docs`` there is something to say about; ``key`` makes
    a row's key from its text. A row goes by its id and key together, so a row with another text stays although it
    repeats an id. Of rows that repeat both id and key and are kept, one stays: the one that comes first by a hash of
    its columns, or any where all columns are equal. No text is shuffled, but for such repeated rows, while the
    verdicts that change something are at most MOST_BROADCAST; beyond that ``docs`` is joined by a shuffle.
    """
    told = verdicts.groupBy("doc_id", "key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).filter("not kept or n > 1")
    told = stash(told.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("kept").alias("_kept")), "verdicts")
    n, again = told.agg(F.count(F.lit(1)), F.count_if("_kept")).first()
    if not n:
        return docs
    few = n <= MOST_BROADCAST
    names = [f"c{i}" for i in range(len(docs.columns))]  # the columns may be called anything
    id_, text = (F.col(names[place_of(docs, c)]) for c in (id_col, text_col))
    rows = docs.toDF(*names).withColumn("_by", key(text))
    match = id_.eqNullSafe(F.col("_id")) & (F.col("_by") == F.col("_key"))
    out = rows.join(F.broadcast(told) if few else told, match, "left_anti").select(*names)
    if again:
        kept = told.filter("_kept")
        several = rows.join(F.broadcast(kept) if few else kept, match, "left_semi")
        hashed = F.xxhash64(*[c for c, kind in zip(names, (t for _, t in docs.dtypes), strict=True) if "map<" not in kind and "variant" not in kind])
        one = several.groupBy(id_.alias("_id"), "_by").agg(F.min_by(F.struct(*names), hashed).alias("_row"))
        out = out.unionByName(one.select("_row.*"))
    return out.toDF(*docs.columns)


def place_of(docs: DataFrame, column: str) -> int:
    """The place of the one column of that name, as Spark resolves names; none or several are an error."""
    same = (lambda x: x) if docs.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true" else str.lower
    found = [i for i, c in enumerate(docs.columns) if same(c) == same(column)]
    if len(found) != 1:
        raise ValueError(f"{len(found)} columns are named {column}")
    return found[0]


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))
