"""Ranked lexical search with block-max pruning over a forward index."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import discard, stash, tidied
from .words import slices

#: Documents of one block, and the entries after which a block ends early.
BLOCK_DOCS, BLOCK_ENTRIES = 64, 1 << 13
#: Text of the queries that are answered in one pass over the documents; what tasks are told about them is in proportion.
QUERY_BYTES = 8 << 20
#: Text that is cut into terms together.
WINDOW = 1 << 20
#: Bounds of queries and blocks that are held at a time.
BOUNDS = 1 << 21

#: A-Z to lower case, every other ASCII character that ends a term to a space.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

RAW = "block long, docs long, words long, doc_ids array<long>, sizes array<long>, ends array<int>, terms array<int>, counts array<int>, block_terms array<int>, block_docs array<int>"
INDEX = "block long, doc_ids array<long>, ends array<int>, terms array<int>, parts array<int>, block_terms array<int>, block_most array<int>"


def terms_of(text: str | bytes | None) -> list[bytes]:
    """The terms of a text, repeats included, as UTF-8."""
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(_TERMS).split()


def _windows(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text of any length, some at a time."""
    at = 0
    while at < len(data):
        to = at + WINDOW
        part = data[at:to].translate(_TERMS)
        if to < len(data):
            last = part.rfind(b" ")
            while last < 0 and to < len(data):  # a term longer than the window
                to += WINDOW
                part = data[at:to].translate(_TERMS)
                last = part.rfind(b" ") if to < len(data) else len(part)
            part, to = (part[: last + 1], at + last + 1) if to < len(data) else (part, to)
        yield part.split()
        at = to


@dataclass
class Queries:
    """Some queries as numbers: the terms of query i are ``flat[first[i]:first[i + 1]]``, repeats included."""

    ids: list
    vocabulary: dict[bytes, int]
    flat: np.ndarray
    first: np.ndarray
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    documents: int = 0
    words: int = 0

    @classmethod
    def of(cls, rows: list[tuple]) -> Queries:
        """Of (id, text); a query without terms is left out, since it finds nothing."""
        ids, vocabulary, flat, first = [], {}, [], [0]
        for id_, text in rows:
            if found := terms_of(text):
                ids.append(id_)
                flat += [vocabulary.setdefault(t, len(vocabulary)) for t in found]
                first.append(len(flat))
        return cls(ids, vocabulary, np.array(flat, np.int64), np.array(first, np.int64))

    def weigh(self, documents: int, words: int, holding: dict[int, int]) -> Queries:
        """The same queries, knowing the corpus: how many documents have terms, all their terms, and how many hold each query term."""
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(self.vocabulary))], np.int64)
        return Queries(self.ids, {}, self.flat, self.first, weight, documents, words)


def _blocks(queries: Queries):
    """Forward index of the queries' terms, in blocks of consecutive documents; documents without such terms only count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, wide = queries.vocabulary.get, len(queries.vocabulary)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        ids: list = []
        sizes: list[int] = []
        ends: list[int] = []
        terms: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        docs = words = entries = 0

        def block() -> pa.RecordBatch:
            nonlocal number, docs, words, entries
            t = np.concatenate(terms) if terms else np.zeros(0, np.int32)
            c = np.concatenate(counts) if counts else np.zeros(0, np.int32)
            distinct, holding = np.unique(t, return_counts=True)
            out = [number, docs, words, list(ids), list(sizes), list(ends), t.astype(np.int32), c.astype(np.int32), distinct.astype(np.int32), holding.astype(np.int32)]
            number += 1
            docs = words = entries = 0
            for x in (ids, sizes, ends, terms, counts):
                x.clear()
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.int32())] * 5
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(out, kinds, strict=True)], [c.split()[0] for c in RAW.split(", ")])

        def document(id_, n: int, places: np.ndarray, tf: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal docs, words, entries
            if not n:
                return
            docs, words = docs + 1, words + n
            if len(places):
                entries += len(places)
                ids.append(id_)
                sizes.append(n)
                ends.append(entries)
                terms.append(places)
                counts.append(tf)
                if len(ids) >= BLOCK_DOCS or entries >= BLOCK_ENTRIES:
                    yield block()

        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, hi, data, offsets in slices(batch.column(1), WINDOW):
                flat = data.tobytes()
                if len(flat) > WINDOW and hi == lo + 1:  # one long text
                    n, total = 0, np.zeros(wide, np.int64)
                    for found in _windows(flat):
                        n += len(found)
                        total += np.bincount(np.array([i for i in map(get, found) if i is not None], np.int64), minlength=wide)[:wide]
                    at = np.flatnonzero(total)
                    yield from document(names[lo], n, at, total[at])
                    continue
                flat = flat.translate(_TERMS)
                cut = [flat[offsets[i] : offsets[i + 1]].split() for i in range(hi - lo)]
                found = np.array([get(t, -1) for ts in cut for t in ts], np.int64)
                of = np.repeat(np.arange(hi - lo), [len(ts) for ts in cut])[found >= 0]
                key, tf = np.unique(of * wide + found[found >= 0], return_counts=True)
                place = key % wide if wide else key
                bounds = np.searchsorted(key, np.arange(hi - lo + 1) * wide)
                for i, ts in enumerate(cut):
                    part = slice(bounds[i], bounds[i + 1])
                    yield from document(names[lo + i], len(ts), place[part], tf[part])
        if docs:
            yield block()

    return run


def _list(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat values of a column of lists."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten().to_numpy(zero_copy_only=False)


def _impacts(documents: int, words: int):
    """What a document's counts are worth, weights aside, and the most that each term is worth in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                docs, size = _list(batch, "sizes")
                _, ends = _list(batch, "ends")
                entries, terms = _list(batch, "terms")
                _, tf = _list(batch, "counts")
                m = 75 + (25 * size.astype(np.int64) * documents) // words
                # Documents' ends are counted from their block's first entry.
                ends = ends.astype(np.int64) + np.repeat(entries[:-1], np.diff(docs))
                per = np.diff(np.concatenate(([0], ends)))
                parts = (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 12 * np.repeat(m, per))
                block = np.repeat(np.arange(batch.num_rows), np.diff(entries))
                by = np.lexsort((parts, terms, block))
                last = np.flatnonzero(np.concatenate((np.diff(block[by]) | np.diff(terms[by]), [1]))) if len(by) else by
                most = by[last]
                cut = np.searchsorted(block[most], np.arange(batch.num_rows + 1))
                old = batch.schema.get_field_index
                lists = lambda values, offsets: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(old(c)) for c in ("block", "doc_ids", "ends", "terms")), lists(parts, entries), lists(terms[most], cut), lists(parts[most], cut)],
                    [c.split()[0] for c in INDEX.split(", ")],
                )

    return run


def _bounds(queries: Queries, terms: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The most that any document of a block can score, for every query."""
    dense = np.zeros(len(queries.weight), np.int64)
    dense[terms] = most * queries.weight[terms]
    return np.add.reduceat(dense[queries.flat], queries.first[:-1])


def _best_blocks(queries: Queries):
    """Of each query the block with the largest bound among the partition's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound, block = np.zeros(len(queries.ids), np.int64), np.zeros(len(queries.ids), np.int64)
        for batch in batches:
            cut, terms = _list(batch, "block_terms")
            _, most = _list(batch, "block_most")
            for i, number in enumerate(batch.column(batch.schema.get_field_index("block")).to_pylist()):
                b = _bounds(queries, terms[cut[i] : cut[i + 1]], most[cut[i] : cut[i + 1]].astype(np.int64))
                more = b > bound
                bound[more], block[more] = b[more], number
        at = np.flatnonzero(bound)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bound[at]), pa.array(block[at])], ["query", "bound", "block"])

    return run


class _Leaders:
    """The k best documents of one query so far, and the score that a document has to reach. Equal scores stay until ids decide."""

    def __init__(self, k: int, floor: int):
        self.k, self.least = k, max(1, floor)
        self.scores: np.ndarray = np.zeros(0, np.int64)
        self.docs: list = []

    def take(self, scores: np.ndarray, docs: list) -> None:
        at = np.flatnonzero(scores >= self.least)
        if not len(at):
            return
        self.scores = np.concatenate((self.scores, scores[at]))
        self.docs += [docs[i] for i in at]
        if len(self.docs) > self.k:
            order = sorted(range(len(self.docs)), key=lambda i: (-self.scores[i], self.docs[i] is None, self.docs[i]))[: self.k]
            self.scores, self.docs = self.scores[order], [self.docs[i] for i in order]
        if len(self.docs) == self.k:
            self.least = max(self.least, int(self.scores.min()))


def _search(queries: Queries, k: int, floors: dict[int, int]):
    """The partition's k best documents of each query: blocks by falling bound, until the bound is below the k-th best score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(queries.ids)
        leaders = [_Leaders(k, floors.get(q, 0)) for q in range(n)]
        value = np.zeros(len(queries.weight), np.int64)
        step = max(1, BOUNDS // max(1, n))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                cut, terms = _list(batch, "terms")
                _, parts = _list(batch, "parts")
                docs_cut, ends = _list(batch, "ends")
                block_cut, block_terms = _list(batch, "block_terms")
                _, most = _list(batch, "block_most")
                parts, most = parts.astype(np.int64), most.astype(np.int64)
                ids = batch.column(batch.schema.get_field_index("doc_ids"))
                bounds = np.empty((batch.num_rows, n), np.int64)
                for i in range(batch.num_rows):
                    some = slice(block_cut[i], block_cut[i + 1])
                    bounds[i] = _bounds(queries, block_terms[some], most[some])
                names: dict[int, list] = {}
                for q, best in enumerate(leaders):
                    mine = bounds[:, q]
                    open_ = np.flatnonzero(mine >= best.least)
                    if not len(open_):
                        continue
                    own = queries.flat[queries.first[q] : queries.first[q + 1]]
                    np.add.at(value, own, queries.weight[own])
                    for i in open_[np.argsort(-mine[open_], kind="stable")].tolist():
                        if mine[i] < best.least:
                            break
                        some = slice(cut[i], cut[i + 1])
                        run_ = np.concatenate(([0], np.cumsum(value[terms[some]] * parts[some])))
                        scores = np.diff(run_[np.concatenate(([0], ends[docs_cut[i] : docs_cut[i + 1]]))])
                        if scores.max(initial=0) >= best.least:
                            if i not in names:
                                names[i] = ids[i].as_py()
                            best.take(scores, names[i])
                    value[own] = 0
        found = [(q, d, int(s)) for q, b in enumerate(leaders) for s, d in zip(b.scores, b.docs, strict=True)]
        cols = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query", "doc_id", "score"])

    return run


def _pass(docs: DataFrame, rows: list[tuple], k: int) -> DataFrame | None:
    """(item_id, rank, doc_id, score) of some queries, each known to every task."""
    spark = docs.sparkSession
    queries = Queries.of(rows)
    if not queries.ids:
        return None
    raw = stash(docs.mapInArrow(tidied(_blocks(queries)), RAW), "blocks-of-counts")
    documents, words = raw.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    if not words:
        discard(raw)
        return None
    pair = raw.select(F.explode(F.arrays_zip("block_terms", "block_docs")).alias("x"))
    holding = {r.t: r.n for r in pair.groupBy(F.col("x.block_terms").alias("t")).agg(F.sum("x.block_docs").alias("n")).collect()}
    queries = queries.weigh(int(documents), int(words), holding)
    index = stash(raw.mapInArrow(tidied(_impacts(int(documents), int(words))), INDEX), "block-max-index")
    discard(raw)
    # The k-th best score in the most promising block of each query is a score that the k best have to reach anywhere.
    best = index.select("block", "block_terms", "block_most").mapInArrow(tidied(_best_blocks(queries)), "query long, bound long, block long")
    seeds = best.groupBy("query").agg(F.max(F.struct("bound", "block")).alias("b")).select("b.block").distinct()
    scored = index.join(F.broadcast(seeds), "block", "left_semi").mapInArrow(tidied(_search(queries, k, {})), "query long, doc_id long, score long")
    top = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    floors = {r.query: r.score for r in scored.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") == k).select("query", "score").collect()}
    found = index.mapInArrow(tidied(_search(queries, k, floors)), "query long, doc_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)
    done = stash(ranked.select("query", "rank", "doc_id", "score"), "search-results")
    discard(index)
    names = spark.createDataFrame(list(enumerate(queries.ids)), "query long, item_id long")
    out = done.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
    out._stashed_at = done._stashed_at
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each query's k best documents with a score above 0.

    One pass over the texts writes the forward index of the queries' terms, in blocks of consecutive documents, and counts
    what the weights need. The index is then written with each entry's worth and, per block, the most that each term is
    worth. A query's bound on a block is the sum of these. Its most promising block of all gives the score to reach;
    then each task takes its blocks by falling bound, scores their documents, and stops where the bound is below the
    score to reach, which rises as it finds better ones. No document is shuffled: a task gives at most k rows for each query.

    The queries are read in groups of at most about QUERY_BYTES of text, each group with a pass of its own, so what tasks are told is
    bounded; their terms, ids and weights are all that is broadcast.

    Defined cases: null and empty texts have no terms, count nowhere and are never found, and a query without terms finds
    nothing; equal scores go by ascending id, null ids last; rows that repeat a document or query id each count for themselves;
    empty tables give no rows; other columns are ignored, whatever their names. Lost tasks are done again from the
    written index. The rows are read from tables in the shared folder, which the caller may ``discard``.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(query_col).cast("string").alias("text")).filter("text is not null")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(1, math.ceil(size / QUERY_BYTES))
    out = None
    for g in range(groups):
        some = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g) if groups > 1 else asked
        found = _pass(texts, [tuple(r) for r in some.collect()], k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def search_sql(k: int = 20) -> str:
    """The same in SQL, every document scored."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = rf"unnest(regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return f"""
        WITH t AS (SELECT r, doc_id, {terms} AS term FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
        f AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
        n AS (SELECT r, sum(tf)::BIGINT AS n FROM f GROUP BY r),
        c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY term, docs),
        q AS (SELECT i, item_id, {terms} AS term FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
        s AS (SELECT q.i, q.item_id, f.r, f.doc_id, sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * n.n * c.docs) // c.words))))::BIGINT AS score
              FROM q JOIN f USING (term) JOIN w USING (term) JOIN n USING (r), c GROUP BY ALL),
        o AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= {k}"""
