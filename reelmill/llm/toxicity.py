"""Toxicity by non-negative positive-unlabelled learning on hashed words and word beginnings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fold, sample_ids, texts_of
from .shared import discard, place_of, stash, tidied
from .words import U, Words, mix, slices

#: Features are hashes of so many bits; only those found telling get a weight.
BITS = 30
HEADS = (4, 5, 6, 7, 8)
#: The bound of what a classifier is fitted on: labelled texts. Every other text is counted, fitted to and scored.
MOST_POSITIVE = 2500
#: In so many positives a feature has to be, or in an eighth of them where they are few.
LEAST_TEXTS = 5
FOLDS, HELD_OUT = 5, 0


def hashed(words: Words) -> list[np.ndarray]:
    """Hashed features of each word: itself without marks at its ends, and its first few bytes."""
    starts, ends, low = words.starts, words.ends, words.low
    for _ in range(3):  # marks around a word don't make another word of it
        if not len(low):
            break
        ends = ends - (~_LETTER[low[np.maximum(ends - 1, 0)]] & (ends - starts > 1))
        starts = starts + (~_LETTER[low[np.minimum(starts, len(low) - 1)]] & (ends - starts > 1))
    cut = [words.hashes(starts, ends)] + [words.hashes(starts, np.minimum(starts + k, ends)) + U(k) for k in HEADS]
    return [(mix(h) >> U(64 - BITS)).astype(np.int32) for h in cut]


def features(words: Words) -> Iterator[np.ndarray]:
    """Per text, its distinct features."""
    all_of, first = hashed(words), words.first
    for d in range(len(first) - 1):
        yield np.unique(np.concatenate([h[first[d] : first[d + 1]] for h in all_of]))


_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[97:123] = _LETTER[128:] = True


def margins(weights: np.ndarray, bias: float, rows: list[np.ndarray]) -> np.ndarray:
    """Sums of the weights at each row's indices, and the bias."""
    size = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    sums = np.concatenate(([0.0], np.cumsum(weights[flat])))
    ends = np.cumsum(size)
    return sums[ends] - sums[ends - size] + bias


class Linear:
    """Weights of the telling features, which are sorted; all others weigh nothing."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.known, self.weights, self.bias = Known(features), weights, bias

    def of_words(self, words: Words) -> np.ndarray:
        """A score for each text: whether features are there counts, not how often."""
        docs = len(words.first) - 1
        doc, number = self.known.hits(words)
        sums = np.bincount(doc, self.weights[number], docs) if len(doc) else np.zeros(docs)
        return sigmoid(sums + self.bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def telling(p: np.ndarray, u: np.ndarray, n_p: int, n_u: int, deviations: float = 5.0) -> np.ndarray:
    """Of features in p of n_p positive and u of n_u unlabelled texts, those whose share among positives is higher by more than chance over so many features."""
    pool = (p + u + 1) / (n_p + n_u + 2)
    noise = np.sqrt(pool * (1 - pool) * (1 / n_p + 1 / max(1, n_u)))
    return p / n_p - u / max(1, n_u) > deviations * noise


def mixture_share(p: np.ndarray, u: np.ndarray, n_p: int, n_u: int, least: int = 20) -> float:
    """The share of positives among unlabelled texts, from above: no feature can be rarer there than that share of its rate among positives."""
    sure = p >= least
    return max(1e-3, float(np.percentile(u[sure] / max(1, n_u) / (p[sure] / n_p), 25))) if sure.any() else 1.0


#: Parts of one in which a text's share in a gradient is counted: sums of whole numbers don't depend on the order of tasks.
SHARES = 1 << 30
#: Steps of the fit, each one pass over what is known of all unlabelled texts, and the first step's length, which falls to a tenth.
STEPS, RATE = 40, 0.3


def unlabelled_part(w: np.ndarray, bias: float, rows: list[np.ndarray], times: np.ndarray | None = None) -> np.ndarray:
    """Over unlabelled rows, each so many times, in SHARES: the sum of loss(-), its gradient by each weight and by the bias, and how many rows.

    The loss is logistic: log(1 + e^-f) for a positive, log(1 + e^f) for a negative.
    """
    n = np.ones(len(rows), np.int64) if times is None else times
    f = margins(w, bias, rows)
    each = np.rint(sigmoid(f) * SHARES).astype(np.int64) * n
    slope = np.zeros(len(w), np.int64)
    if rows:
        np.add.at(slope, np.concatenate(rows), np.repeat(each, [len(r) for r in rows]))
    return np.concatenate(([(np.rint(np.logaddexp(0, f) * SHARES).astype(np.int64) * n).sum()], slope, [each.sum(), n.sum()]))


def pu_risk(w: np.ndarray, bias: float, positives: list[np.ndarray], part: np.ndarray, prior: float) -> tuple[float, float]:
    """prior * E_p[loss(+)], and E_u[loss(-)] - prior * E_p[loss(-)], the estimate of the negative part; ``part`` sums up the unlabelled rows."""
    f = margins(w, bias, positives)
    return prior * float(np.logaddexp(0, -f).mean()), float(part[0] / SHARES / part[-1] - prior * np.logaddexp(0, f).mean())


def pu_gradient(w: np.ndarray, bias: float, positives: list[np.ndarray], part: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the non-negative PU risk by the weights and then the bias.

    Where the estimate of the negative part is below zero, the step goes the other way along that part alone, so
    that it isn't fitted further.
    """
    sign = 1.0 if pu_risk(w, bias, positives, part, prior)[1] >= 0 else -1.0
    s = sigmoid(margins(w, bias, positives))
    each = prior / len(positives) * (-1.0 if sign > 0 else s) * np.ones(len(s))
    flat = np.concatenate(positives)
    mine = np.append(np.bincount(flat, np.repeat(each, [len(r) for r in positives]), len(w)), each.sum())
    return mine + sign * part[1:-1] / SHARES / part[-1]


def fit_nnpu(positives: list[np.ndarray], unlabelled: Callable[[np.ndarray, float], np.ndarray], dim: int, prior: float, steps: int = STEPS, rate: float = RATE, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias from positive rows of feature numbers, and a function that sums up all unlabelled rows under given ones, by full-batch Adam on the non-negative PU risk."""
    w, bias = np.zeros(dim), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(dim + 1), np.zeros(dim + 1)
    for step in range(1, steps + 1):
        grad = pu_gradient(w, bias, positives, unlabelled(w, bias), prior)
        grad[:-1] += decay * w
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        length = rate * (1 - 0.9 * (step - 1) / max(1, steps - 1))
        move = length * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * m / (np.sqrt(v) + 1e-8)
        w, bias = np.maximum(w - move[:-1], 0), bias - move[-1]  # telling features speak for toxicity only
    return w, bias


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each feature of each text, once."""
    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0)):
            for r in features(Words(data, offsets)):
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int32())], ["feature"])


class Known:
    """Sorted features, and for the words of many texts which of the features each text has."""

    def __init__(self, sorted_features: np.ndarray):
        self.features = sorted_features
        self.likely = np.zeros(1 << 20, bool)
        self.likely[sorted_features >> (BITS - 20)] = True

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, number of the feature) for each feature of each text, once and in order."""
        n = len(self.features)
        doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        found = []
        for h in hashed(words):
            at = np.flatnonzero(self.likely[h >> (BITS - 20)])
            place = np.minimum(np.searchsorted(self.features, h[at]), max(0, n - 1))
            real = self.features[place] == h[at] if n else np.zeros(len(at), bool)
            found.append(doc[at[real]] * max(1, n) + place[real])
        hit = np.sort(np.concatenate(found))
        hit = hit[np.concatenate(([True], hit[1:] != hit[:-1]))] if len(hit) else hit
        return hit // max(1, n), hit % max(1, n)


def _counts(known: Known):
    """How many of a task's texts have each feature; the last row, under number -1, is how many texts there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(len(known.features), np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for _, _, data, offsets in slices(batch.column(0)):
                total += np.bincount(known.hits(Words(data, offsets))[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], texts))], ["feature", "n"])

    return run


def _rows_of(known: Known):
    """The numbers of each text's telling features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(0)):
                doc, number = known.hits(Words(data, offsets))
                rows = [x.astype(np.int32).tobytes() for x in np.split(number, np.searchsorted(doc, np.arange(1, hi - lo)))]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["vector"])

    return run


def _parts(w: np.ndarray, bias: float):
    """A task's ``unlabelled_part``, as the places that aren't zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(w) + 3, np.int64)
        for batch in batches:
            rows = [np.frombuffer(v, np.int32) for v in batch.column(0).to_pylist()]
            total += unlabelled_part(w, bias, rows, batch.column(1).to_numpy())
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "total"])

    return run


def _all_parts(vectors: DataFrame) -> Callable[[np.ndarray, float], np.ndarray]:
    """``unlabelled_part`` over a table of vectors and how often each is there: a pass by all tasks, of which only the sums come back."""

    def sums(w: np.ndarray, bias: float) -> np.ndarray:
        total = np.zeros(len(w) + 3, np.int64)
        for place, n in vectors.mapInArrow(_parts(w, bias), "place long, total long").groupBy("place").agg(F.sum("total")).collect():
            total[place] = n
        return total

    return sums


def _scores(model: Linear):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1)):
                scores = model.of_words(Words(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def _count(texts: DataFrame, names: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many texts each feature is, and how many texts there are."""
    u, n_u = np.zeros(len(names), np.int64), 0
    for feature, n in texts.mapInArrow(tidied(_counts(Known(names))), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        if feature < 0:
            n_u = n
        else:
            u[feature] = n
    return u, n_u


def train(docs: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE) -> Linear:
    """Fit on rows outside the held-out fold: texts marked toxic as positives, and all texts as unlabelled.

    Features of a bounded sample of positives, picked by a hash of the id, are counted in all texts of those folds,
    the unlabelled ones, and those that are telling are kept. The class prior is the share of toxic among the labelled
    rows, or less where these counts prove it; a feature proves something from 20 positives on, so with fewer of them
    the labelled share stands. Each text is then no more than the numbers of its telling features, alike ones counted
    together, and every step of the fit is a pass over all of them.
    Without positives, or without texts, the model scores everything near 0.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null").filter(fold("doc_id", FOLDS) != HELD_OUT)
    marks = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = marks.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    nothing = Linear(np.zeros(0, np.int32), np.zeros(0), -4.0)
    if not share:
        return nothing
    ids = stash(sample_ids(marks.filter("toxic = 1").select("doc_id"), most_positive, 1), "toxic-ids")
    texts = stash(texts_of(rows, ids), "toxic-texts")
    n_p = texts.count()
    # Any text may be unlabelled, the confirmed among them: so toxic texts have the prior's share here.
    free = rows.filter(fold("doc_id", FOLDS) != HELD_OUT).select("text")
    try:
        if not n_p:
            return nothing
        least = min(LEAST_TEXTS, max(2, n_p // 8))
        counted = texts.select("text").mapInArrow(tidied(_features), "feature int").groupBy("feature").agg(F.count(F.lit(1)).alias("p")).filter(F.col("p") >= least)
        found = np.array([tuple(r) for r in counted.collect()], np.int64).reshape(-1, 2)
        found = found[np.argsort(found[:, 0])]
        names, p = found[:, 0].astype(np.int32), found[:, 1]
        u, n_u = _count(free, names)
        if not n_u:
            return nothing
        kept = telling(p, u, n_p, n_u)
        prior = min(max(share, 1e-3), 0.9, mixture_share(p[kept], u[kept], n_p, n_u))
        rows_of = tidied(_rows_of(Known(names[kept])))
        positives = sorted(r[0] for r in texts.select("text").mapInArrow(rows_of, "vector binary").collect())
    finally:
        discard(ids, texts)
    vectors = stash(free.mapInArrow(rows_of, "vector binary").groupBy("vector").agg(F.count(F.lit(1)).alias("n")), "unlabelled-vectors")
    w, bias = fit_nnpu([np.frombuffer(v, np.int32) for v in positives], _all_parts(vectors), int(kept.sum()), prior)
    discard(vectors)
    return Linear(names[kept], w, bias)


def toxicity_scores(docs: DataFrame, labels: DataFrame, model: Linear | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score in 0..1, predicted (1 where score >= 0.5).

    Every whole text is scored from its words alone, where it is read; nothing of its row but the text enters.

    Defined cases: a null or blank text gets the score of no features; a null id has held_out false; rows that
    repeat an id each get a score; without labels every score is near 0; an empty table gives no rows; other columns
    are ignored.
    """
    model = model or train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(tidied(_scores(model)), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _clean(model: Linear, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            keep = [model.of_words(Words(data, offsets)) < 0.5 for _, _, data, offsets in slices(texts)]
            yield batch.filter(pa.array(np.concatenate(keep))) if keep else batch

    return run


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the texts predicted toxic, all columns as they were.

    Defined cases: a null or blank text has no features and stays, unless most texts are toxic; rows are judged each
    by its own text, whatever their ids, null ones included; without labels nothing goes; an empty table gives no rows;
    other columns may have any names.
    """
    model = train(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels)
    return docs.mapInArrow(tidied(_clean(model, place_of(docs, text_col))), docs.schema)
