"""Quality by histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fold, sample_ids, texts_of
from .shared import tidied
from .words import SPACE, Words, slices

FOLDS, HELD_OUT = 4, 2
#: Bound of the labelled sample the trees are fitted on; everything is scored.
MOST_LABELLED = 20_000

_CLASSES = {}


def _class(name: str, members) -> None:
    table = np.zeros(256, bool)
    table[list(members)] = True
    _CLASSES[name] = table


_class("upper", range(65, 91))
_class("lower", range(97, 123))
_class("digit", range(48, 58))
_class("beyond_ascii", range(128, 256))
_class("stop", map(ord, ".,;:?"))
_class("shout", map(ord, "!"))
_class("noise", map(ord, "*$#%&@^~|<>{}[]\\_=+"))
_class("quote", map(ord, "\"'()-/"))
_class("line", [10])
_class("space", np.flatnonzero(SPACE))
NAMES = ["log_bytes", "log_words", "mean_word", "std_word", "longest_word", "distinct_words", "repeated_next", "most_common_pair", "lines_per_word", "distinct_lines", "capitalised", *(f"share_{k}" for k in _CLASSES)]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per text; a text without words has zeros but for its bytes."""
    w = Words(data, offsets)
    n = len(offsets) - 1
    out = np.zeros((n, len(NAMES)))
    size, count = np.diff(offsets).astype(float), w.counts().astype(float)
    doc = np.repeat(np.arange(n), w.counts())
    length = (w.ends - w.starts).astype(float)
    h = w.hashes()
    some, many = np.maximum(size, 1), np.maximum(count, 1)
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(count)
    total = np.bincount(doc, length, n)
    out[:, 2] = total / many
    out[:, 3] = np.sqrt(np.maximum(np.bincount(doc, length * length, n) / many - out[:, 2] ** 2, 0))
    np.maximum.at(out[:, 4], doc, length)
    out[:, 4] = np.log1p(out[:, 4])
    if len(h):
        by = np.lexsort((h, doc))
        new = np.concatenate(([True], (h[by][1:] != h[by][:-1]) | (doc[by][1:] != doc[by][:-1])))
        out[:, 5] = np.bincount(doc[by], new, n) / many
        same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        out[:, 6] = np.bincount(doc[1:], same, n) / many
        pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
        inside, of = doc[1:] == doc[:-1], doc[:-1]
        pair, of = pair[inside], of[inside]
        if len(pair):
            by = np.lexsort((pair, of))
            new = np.flatnonzero(np.concatenate(([True], (pair[by][1:] != pair[by][:-1]) | (of[by][1:] != of[by][:-1]))))
            run = np.diff(np.append(new, len(pair))).astype(float)
            most = np.zeros(n)
            np.maximum.at(most, of[by][new], run)
            out[:, 7] = most / many
        first = w.raw[w.starts]
        out[:, 10] = np.bincount(doc, (first >= 65) & (first <= 90), n) / many
    # Lines, by a hash of their words.
    flat_doc = np.repeat(np.arange(n), np.diff(offsets))
    at = np.flatnonzero(data == 10)
    out[:, 8] = np.bincount(flat_doc[at], minlength=n) / many if len(at) else 0
    if len(h):
        line = np.searchsorted(at, w.starts) + doc  # words of one line of one text
        begin = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
        weight = np.add.reduceat(h * (np.arange(len(h), dtype=np.uint64) - np.repeat(begin, np.diff(np.append(begin, len(h)))).astype(np.uint64) + np.uint64(1)), begin)
        of = doc[begin]
        by = np.lexsort((weight, of))
        new = np.concatenate(([True], (weight[by][1:] != weight[by][:-1]) | (of[by][1:] != of[by][:-1])))
        out[:, 9] = np.bincount(of[by], new, n) / np.maximum(np.bincount(of, minlength=n), 1)
    for k, table in enumerate(_CLASSES.values()):
        sums = np.concatenate(([0], np.cumsum(table[data], dtype=np.int64)))
        out[:, 11 + k] = (sums[offsets[1:]] - sums[offsets[:-1]]) / some
    return out


@dataclass
class Trees:
    """Boosted trees as flat arrays: node i of tree t asks column[t, i] <= threshold[t, i]; its children are 2i+1 and 2i+2."""

    column: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.column)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.column[t, node]] > self.threshold[t, node])
            out += self.value[t, node - ((1 << self.depth) - 1)]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, smooth: float = 1.0, least: float = 1.0) -> Trees:
    """Gradient boosting of the logistic loss; splits are sought in histograms of gradients over quantile bins."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)], 1).astype(np.int32)
    inner, leaves = (1 << depth) - 1, 1 << depth
    column, threshold, value = np.zeros((rounds, inner), np.int32), np.full((rounds, inner), np.inf), np.zeros((rounds, leaves))
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    f = np.full(n, base)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, start = 1 << level, (1 << level) - 1
            local = node - start
            best = np.zeros(width)
            gt, ht = np.bincount(local, g, width), np.bincount(local, h, width)
            for j in range(m):
                key = local * bins + binned[:, j]
                gl = np.cumsum(np.bincount(key, g, width * bins).reshape(width, bins), 1)
                hl = np.cumsum(np.bincount(key, h, width * bins).reshape(width, bins), 1)
                gr, hr = gt[:, None] - gl, ht[:, None] - hl
                gain = gl**2 / (hl + smooth) + gr**2 / (hr + smooth) - (gt**2 / (ht + smooth))[:, None]
                gain[(hl < least) | (hr < least)] = 0
                gain[:, len(edges[j]) :] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                win = top > best + 1e-9
                best[win] = top[win]
                column[t, start : start + width][win] = j
                for i in np.flatnonzero(win):
                    threshold[t, start + i] = edges[j][at[i]]
            node = 2 * node + 1 + (x[np.arange(n), column[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + smooth)
        f += value[t][leaf]
    return Trees(column, threshold, value, base, depth)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            rows = [r.tobytes() for r in statistics(data, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(rows, pa.binary())], ["label", "vector"])


def _scores(model: Trees | None, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1)):
                x = statistics(data, offsets)
                score = model.scores(x) if model else np.full(len(x), share)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score, pa.float64())], ["doc_id", "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> tuple[Trees | None, float]:
    """Trees fitted on at most ``most`` labelled rows outside the held-out fold, and the share of good ones among them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("label")).filter("doc_id is not null and label is not null")
    ids = sample_ids(known.filter(fold("doc_id", FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.max("label").alias("label")), most, 3)  # one row for each id
    got = texts_of(rows, ids).select("label", "text").mapInArrow(tidied(_vectors), "label long, vector binary").collect()
    if not got:
        return None, 0.5
    got.sort(key=lambda r: (r[1], r[0]))  # the sums of a fit shouldn't depend on the order of tasks
    x = np.stack([np.frombuffer(r[1], np.float64) for r in got])
    y = np.array([r[0] for r in got], float)
    if y.min() == y.max():
        return None, float(y[0])
    return fit_trees(x, y), float(y.mean())


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score in 0..1, predicted (1 where score >= ``threshold``).

    Every whole text is scored by its statistics alone, where it is read.

    Defined cases: a null text counts as empty, and an empty text is scored by its zeros; a null id has held_out
    false; rows that repeat an id each get a score; with labels of one kind or none, every score is that label's
    value, or 0.5; an empty table gives no rows; other columns are ignored.
    """
    model, share = train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(tidied(_scores(model, share)), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
