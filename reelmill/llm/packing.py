"""Packing of token ids into sequences by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_ids import ByteIds, long_runs
from .shared import tidied
from .words import slices

MODEL = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048
#: What doesn't fill a sequence is cut into pieces of so many ids: small pieces leave little padding.
PIECE = 512
#: Pieces that are dealt into windows together. It bounds the memory of a task and the cost of differencing.
GROUP = 1280


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Deal ``sizes`` into k windows of near-equal sums; returns the indices in each.

    A partial partition is k (sum, members) sorted by sum. The two with the largest spread are merged, the
    largest windows of one with the smallest of the other, so that opposing imbalances cancel.
    Members are kept as a tree of merges and unfolded at the end.
    """
    if k == 1:
        return [list(range(len(sizes)))]
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    children: list[tuple[int, int]] = [(-1, -1)]  # node 0: nothing
    for i, s in enumerate(sizes):
        children.append((-1, i))
        sums, nodes = np.zeros(1, np.int64), np.zeros(1, np.int64)
        sums[0], nodes[0] = s, len(children) - 1
        heap.append((-s, i, sums, nodes))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, sa, na = heapq.heappop(heap)
        _, _, sb, nb = heapq.heappop(heap)
        # Only windows with something in them are stored, in falling order; the rest have sum 0.
        spare = k - len(sa) - len(sb)
        if spare >= 0:
            sums, nodes = np.concatenate((sa, sb)), np.concatenate((na, nb))
        else:
            m = -spare  # so many of the smallest of each have to share a window
            sums, nodes = sa.copy(), na.copy()
            at = np.arange(len(sa) - m, len(sa))
            other = np.arange(len(sb) - m, len(sb))[::-1]
            sums[at] += sb[other]
            for x, y in zip(at, other, strict=True):
                children.append((int(na[x]), int(nb[y])))
                nodes[x] = len(children) - 1
            sums, nodes = np.concatenate((sums, sb[: len(sb) - m])), np.concatenate((nodes, nb[: len(sb) - m]))
        by = np.argsort(-sums, kind="stable")
        sums, nodes = sums[by], nodes[by]
        least = int(sums[-1]) if len(sums) == k else 0
        heapq.heappush(heap, (least - int(sums[0]), order, sums, nodes))
        order += 1
    out = []
    for node in heap[0][3] if heap else []:
        members, stack = [], [int(node)]
        while stack:
            a, b = children[stack.pop()]
            if a < 0:
                if b >= 0:
                    members.append(b)
            else:
                stack += [a, b]
        out.append(sorted(members))
    return out


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; their number rises from the least possible until none is exceeded."""
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("a piece is larger than a window")
    k = -(-sum(sizes) // capacity)
    while True:
        dealt = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in dealt):
            return [w for w in dealt if w]
        k += 1


def _ids(texts: pa.Array, ids_of: ByteIds) -> Iterator[bytes]:
    for _, _, data, offsets in slices(texts):
        flat, at = data.tobytes(), offsets.tolist()
        for i, long in enumerate(long_runs(data, offsets).tolist()):
            yield ids_of(flat[at[i] : at[i + 1]].decode(), long)


def _pack(encoder: Callable[[], ByteIds], end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder()
        part = TaskContext.get().partitionId()
        tail = np.array([end_id], "<u4").tobytes()
        number = 0
        rows: list[tuple] = []
        waiting: list[tuple] = []

        def flush() -> None:
            nonlocal number
            for w in windows([x[2] for x in waiting], capacity):
                at = 0
                for i in w:
                    doc, start, length, crc, total = waiting[i]
                    rows.append((doc, start, length, crc, total, (part << 32) + number, at))
                    at += length
                number += 1
            waiting.clear()

        for batch in batches:
            docs = batch.column(0).to_pylist()
            for doc, ids in zip(docs, _ids(batch.column(1), ids_of), strict=True):
                ids += tail
                total = len(ids) // 4
                whole = total - total % capacity
                for start in range(0, whole, capacity):
                    rows.append((doc, start, capacity, zlib.crc32(ids[4 * start : 4 * (start + capacity)]), total, (part << 32) + number, 0))
                    number += 1
                for start in range(whole, total, PIECE):
                    piece = ids[4 * start : 4 * (start + PIECE)]
                    waiting.append((doc, start, len(piece) // 4, zlib.crc32(piece), total))
                if len(waiting) >= GROUP:
                    flush()
                if len(rows) >= 20_000:
                    yield _rows(rows)
                    rows.clear()
        flush()
        if rows:
            yield _rows(rows)

    return run


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], NAMES)


def pack(docs: DataFrame, model: str = MODEL, end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and then ``end_id``. Full runs of ``capacity`` ids fill sequences of their own;
    what is left of each document is cut into small pieces and dealt with those of others into windows whose sums are nearly equal.
    Everything happens where the text is read, so nothing is shuffled; a sequence holds pieces of one input
    partition, and its id is that partition's number and a count within it. A task that runs again reads the
    same rows in the same order, so it numbers and deals them the same.

    Defined cases: a null or empty text is ``end_id`` alone; a null id stays null in its pieces; rows that
    repeat an id are packed each for itself; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(_pack(lambda: ByteIds.of(model), end_id, capacity)), ", ".join(f"{n} long" for n in NAMES))
