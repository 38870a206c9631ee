"""Documents linked by the Jaccard similarity of their word n-gram sets, exact, without all pairs.

What is thresholded is the product of the document-by-n-gram incidence matrix with its transpose. It is computed
only where bounds that follow from the sizes of the sets allow an entry to reach the threshold, in blocks of columns:

* Rows that are equal are one row (a class of copies), numbered for itself.
* Under any fixed order of the columns, two rows of similarity num/den share one of their first
  p = n - ceil(n * num / den) + 1 columns. The order here is by block: columns of a hashed block first, those
  in fewest rows before the others, then all other columns by hash. So a row's first columns are its own
  alone if it has no near copy, and neither frequent words nor passages that many documents share bring
  rows together. Only the block's columns have to be counted.
* Set sizes must be within num/den of each other, and the rows may differ in few columns, which parity sketches tell.

The entries that are left are summed up over blocks of columns: each block adds the number of columns that
both rows have in it, and a pair whose sum stays below num * (na + nb) / (num + den) is discarded.
Rows that meet in a column are paired with one pivot row of it, not with each other: with the row that has the fewest
columns of its own, since of near copies the one that was changed least is linked with most others. Only where the links
found leave a column's rows in several components are more pairs looked at: with further pivots, if asked for, and then, by size
classes and blocks of rows, all between different components, so that no link is lost. Of these a block first gives
only as many as would join its components if all were links, and the rest once those have been counted: of a thousand
near copies that makes thousands of pairs, not a million.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .shared import discard, kept_rows, stash, text_or_empty, tidied
from .words import U, Words, mix, shingle_sets, slices

#: The block holds so many times the columns that a row's bound asks for, on average.
BLOCK_SHARE = 1.3
#: Further pivots are tried so many times, while the pairs between components are more than so many times the rows that have
#: met. Spanning pairs join more at once, so no round is spent on pivots by default.
PIVOT_ROUNDS = 0
PAIRS_PER_ROW = 100
#: Rows of a column that are held against each other at a time.
BLOCK_ROWS = 4096
SKETCH_BITS = 2048
#: Pairs of rows whose sketches are compared at a time.
PAIRS_AT_ONCE = 1 << 14
#: Blocks of columns over which overlap counts are summed up.
COLUMN_BLOCKS = 4
#: A column with more rows is heavy: it is looked up in a broadcast table, so that its rows stay where they are.
HEAVY_ROWS = 1000
#: Up to so many ids or heavy columns are broadcast; beyond it that is a shuffled join.
MOST_BROADCAST = 500_000


def first_columns(n: int, num: int, den: int) -> int:
    """How many of its first columns a row of n has to show."""
    return n - (num * n + den - 1) // den + 1


def _marks(n: int):
    """Size and 128-bit digest of each text's set; columns besides id and text go along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1)):
                sets = list(shingle_sets(Words(data, offsets), n))
                more = [batch.column(i).slice(lo, hi - lo) for i in range(2, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *_digests(sets), *more], ["doc_id", "n_shingles", "k1", "k2", *batch.schema.names[2:]])

    return run


def _digests(sets: list[np.ndarray]) -> list[pa.Array]:
    k1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
    k2 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
    return [pa.array([len(s) for s in sets], pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))]


def _columns(n: int, num: int, den: int):
    """The columns of each text's set that may be among its first: those of the block, or else its lowest."""
    border = np.uint64(int(min(1.0, BLOCK_SHARE * (den - num) / den) * (1 << 64)) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1)):
                sets = list(shingle_sets(Words(data, offsets), n))
                held = [s[: max(int(np.searchsorted(s, border)), first_columns(len(s), num, den))] for s in sets]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in held]))).astype(np.int32)
                flat = np.concatenate(held).view(np.int64) if held else np.zeros(0, np.int64)
                sketches = pa.array([sketch(s) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *_digests(sets), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), sketches],
                    ["doc_id", "n_shingles", "k1", "k2", "held", "sketch"],
                )

    return run


def sketch(s: np.ndarray) -> bytes:
    """Parities of the columns of a row that fall on each of SKETCH_BITS places.

    A column in which two rows differ changes one place, so two sketches differ in no more places than the rows in columns.
    """
    at = (mix(s ^ U(0x5851F42D4C957F2D)) >> U(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


def _column_blocks(n: int):
    """The columns of each text's set in each block that has any, under the set's size and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = np.array([(i << 64) // COLUMN_BLOCKS for i in range(1, COLUMN_BLOCKS)], np.uint64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                sets = list(shingle_sets(Words(data, offsets), n))
                cuts = np.array([[0, *np.searchsorted(s, borders), len(s)] for s in sets])
                size = np.diff(cuts, axis=1)
                row, block = np.nonzero(size)
                ends = np.concatenate(([0], np.cumsum(size[row, block]))).astype(np.int32)
                marks = [x.take(pa.array(row)) for x in _digests(sets)]
                yield pa.RecordBatch.from_arrays([*marks, pa.array(block.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))], ["n_shingles", "k1", "k2", "block", "cols"])

    return run


def _sketches(column: pa.Array) -> np.ndarray:
    width = SKETCH_BITS // 64
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, width)


def _possible(na: np.ndarray, nb: np.ndarray, sa: np.ndarray, sb: np.ndarray, num: int, den: int) -> np.ndarray:
    """Row pairs that the sizes and the sketches don't rule out: linked rows differ in at most (na + nb)(den - num)/(den + num) columns."""
    keep = den * np.minimum(na, nb) >= num * np.maximum(na, nb)
    at = np.flatnonzero(keep)
    for lo in range(0, len(at), PAIRS_AT_ONCE):
        i = at[lo : lo + PAIRS_AT_ONCE]
        apart = np.bitwise_count(sa[i] ^ sb[i]).sum(1, dtype=np.int64)
        keep[i] = apart * (den + num) <= (na[i] + nb[i]) * (den - num)
    return keep


def _prune(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            keep = pa.array(_possible(na, nb, _sketches(batch.column(4)), _sketches(batch.column(5)), num, den))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in range(4)], ["a", "b", "na", "nb"])

    return run


def _joining(x: np.ndarray, y: np.ndarray, root: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Of pairs of rows, places of those that join components that weren't joined before; ``root`` is kept up to date."""
    taken = []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    a, b = label[x], label[y]
    _, first = np.unique(np.minimum(a, b) * len(root) + np.maximum(a, b), return_index=True)
    for at in first.tolist():
        i, j = top(int(a[at])), top(int(b[at]))
        if i != j:
            root[max(i, j)] = min(i, j)
            taken.append(at)
    return np.array(taken, np.int64)


def _block_pairs(num: int, den: int, forest: bool):
    """Possible pairs between the components of each block pair's rows, all of them or as many as may join the components. Rows come sorted by block pair."""

    def pairs(rows: dict[str, np.ndarray], lo: int, hi: int) -> np.ndarray:
        node, part, side, n, sk = (rows[k][lo:hi] for k in ("node", "component", "side", "n", "sketch"))
        two_blocks, own = rows["i"][lo] != rows["j"][lo], rows["i"][lo]
        label = np.unique(part, return_inverse=True)[1].reshape(-1)
        root = np.arange(int(label.max()) + 1)
        found = []
        step = max(1, (1 << 18) // (hi - lo))
        for at in range(0, hi - lo, step):
            r = np.arange(at, min(at + step, hi - lo))[:, None]
            c = np.arange(hi - lo)[None]
            # A group that is no pair of blocks holds a class of sizes and the next one, whose own pairs are another group's.
            maybe = (part[r] != part[c]) & ((side[r] < side[c]) if two_blocks else (r < c) & (np.minimum(side[r], side[c]) == own))
            maybe &= den * np.minimum(n[r], n[c]) >= num * np.maximum(n[r], n[c])
            of_r, of_c = np.nonzero(maybe)
            for k in range(0, len(of_r), PAIRS_AT_ONCE):
                x, y = of_r[k : k + PAIRS_AT_ONCE] + at, of_c[k : k + PAIRS_AT_ONCE]
                if forest:
                    while ((up := root[root]) != root).any():
                        root[:] = up
                    apart = root[label[x]] != root[label[y]]
                    x, y = x[apart], y[apart]
                keep = _possible(n[x], n[y], sk[x], sk[y], num, den)
                x, y = x[keep], y[keep]
                if forest and len(x):
                    at_pairs = _joining(x, y, root, label)
                    x, y = x[at_pairs], y[at_pairs]
                x, y = np.where(node[x] < node[y], x, y), np.where(node[x] < node[y], y, x)
                found.append(np.stack((node[x], node[y], n[x], n[y]), 1))
        return np.concatenate([np.zeros((0, 4), np.int64), *found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(table: pa.Table, cuts: list[int]) -> pa.RecordBatch:
            rows = {k: table.column(k).to_numpy() for k in ("i", "j", "node", "component", "side", "n")}
            rows["sketch"] = _sketches(table.column("sketch"))
            out = [pairs(rows, lo, hi) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True) if hi - lo > 1]
            each = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 4), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(each[:, i]) for i in range(4)], ["a", "b", "na", "nb"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            key = [table.column(k).to_numpy() for k in ("sig", "i", "j")]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if len(new):  # the last block pair may go on in the next batch
                yield emit(table.slice(0, int(new[-1])), [0, *new.tolist()])
                held = table.slice(int(new[-1])).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield emit(table, [0, table.num_rows])

    return run


def _possible_pairs(pairs: DataFrame, light: DataFrame, num: int, den: int) -> DataFrame:
    """Of the pairs (a, b), those that sizes and sketches leave, with the sizes na and nb."""
    side = lambda x: light.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(tidied(_prune(num, den)), "a long, b long, na long, nb long")


def _linked(pairs: DataFrame, texts: DataFrame, classes: DataFrame, n: int, num: int, den: int, name: str) -> DataFrame:
    """Of the pairs (a, b), those whose sets are similar enough: their entries of the product, summed up over blocks of columns."""
    pairs = stash(pairs, f"ngram-{name}")
    of_pairs = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    need = stash(classes.join(of_pairs, "node", "left_semi").select("node", "rep", "n_shingles", "k1", "k2"), f"ngram-need-{name}")
    few = need.count() <= MOST_BROADCAST  # then no text is shuffled
    reps = need.select(F.col("rep").alias("_rep")).distinct()
    rows = texts.join(F.broadcast(reps) if few else reps, texts["doc_id"].eqNullSafe(F.col("_rep")), "left_semi").select("text")
    blocks = rows.mapInArrow(tidied(_column_blocks(n)), "n_shingles long, k1 long, k2 long, block int, cols array<long>")
    # Other texts may have the ids of those that are needed, and the same text may stand on several rows.
    named = blocks.join(F.broadcast(need.drop("rep")) if few else need.drop("rep"), ["n_shingles", "k1", "k2"])
    grams = stash(named.groupBy("node", "block").agg(F.first("cols").alias("cols")), f"ngram-grams-{name}")
    # The pivot (a) stands in many pairs and goes last, on the side that adaptive execution may split.
    met = pairs.join(grams.select(F.col("node").alias("b"), "block", F.col("cols").alias("cb")), "b").join(grams.select(F.col("node").alias("a"), "block", F.col("cols").alias("ca")), ["a", "block"])
    entries = met.groupBy("a", "b", "na", "nb").agg(F.sum(F.size(F.array_intersect("ca", "cb"))).alias("both"))
    links = stash(entries.filter(F.col("both") * (num + den) >= (F.col("na") + F.col("nb")) * num).select("a", "b"), f"ngram-links-{name}")
    discard(grams, need, pairs)
    return links


def _of_column(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with what a stashed table (sig, n_rows, ...) says of their column; rows of other columns go.

    Rows of heavy columns find it in a broadcast table, so that no task gets all rows of one column.
    """
    heavy = table.filter(F.col("n_rows") > HEAVY_ROWS)
    n = heavy.limit(MOST_BROADCAST + 1).count()
    if not n or n > MOST_BROADCAST:
        return rows.join(table, "sig")  # adaptive execution splits what is large
    light = rows.join(F.broadcast(heavy.select("sig")), "sig", "left_anti").join(table.filter(F.col("n_rows") <= HEAVY_ROWS), "sig")
    return rows.join(F.broadcast(heavy), "sig").unionByName(light)


def _classes(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str, tag: Column | None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, k1, k2, and tag) of each row, and (n_shingles, k1, k2, class_size, alone, part, part_id) of each set with columns.

    ``part`` numbers the component of a set, part_id is the smallest id in it, and a set is alone if one row has
    it and it is linked with no other.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tagged = texts if tag is None else docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), tag.alias("tag"))
    key = "doc_id long, n_shingles long, k1 long, k2 long"
    same_set = ["n_shingles", "k1", "k2"]
    marks = stash(tagged.mapInArrow(tidied(_marks(n)), key if tag is None else f"{key}, tag binary"), "ngram-marks")
    # One row of columns for each set, whichever of its texts they come from.
    sets = texts.mapInArrow(tidied(_columns(n, num, den)), f"{key}, held array<long>, sketch binary").filter("n_shingles > 0").groupBy(*same_set)
    sets = sets.agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("class_size"), F.first(F.struct("held", "sketch")).alias("s"))
    columns = stash(sets.select(F.monotonically_increasing_id().alias("node"), *same_set, "rep", "class_size", "s.held", "s.sketch"), "ngram-columns")
    classes = columns.drop("held", "sketch")
    entries = columns.select("node", F.explode("held").alias("sig"))
    shared = stash(entries.groupBy("sig").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1"), "ngram-shared")
    asked = F.expr(f"n_shingles - (n_shingles * {num} + {den - 1}) div {den} + 1")
    by_row = _of_column(entries, shared).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n_rows", F.shiftrightunsigned("sig", 1).alias("place"), "sig"))).alias("s"))
    # Columns of one row alone come first in the order and meet nobody; what is left of the bound is taken from the others.
    first = by_row.join(columns.select("node", "n_shingles", F.size("held").alias("n_held")), "node").withColumn("left", (asked - F.col("n_held") + F.size("s")).cast("int"))
    first = first.filter("left > 0").withColumn("own", ((F.col("n_held") - F.size("s")) / F.col("n_held")).cast("float"))
    entries = stash(first.select("node", "own", F.explode(F.slice("s", 1, F.col("left"))).alias("x")).select("node", "own", F.col("x.sig").alias("sig")), "ngram-first")
    discard(shared)
    met = stash(entries.groupBy("sig").agg(F.min_by("node", F.struct("own", "node")).alias("a"), F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1"), "ngram-met")
    lists = stash(_of_column(entries, met).select("sig", "a", F.col("node").alias("b")), "ngram-lists")
    discard(entries, met)
    pairs = stash(lists.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "ngram-pairs")
    nodes = stash(lists.select(F.col("b").alias("node")).distinct(), "ngram-nodes")
    light = columns.select("node", F.col("n_shingles").alias("n"), "sketch")
    link = lambda more, name: _linked(more, texts, classes, n, num, den, name)
    links = link(_possible_pairs(pairs, light, num, den), "stars")
    tried, part = pairs, _labels(nodes, links)
    steps = ["pivots"] * PIVOT_ROUNDS + ["forest", "all"]
    for turn, step in enumerate(steps):
        open_lists = stash(_several(lists.select("sig", F.col("b").alias("node")), part), f"ngram-open{turn}")
        rows, between = _sizes(open_lists)
        if not rows:
            break
        if between <= PAIRS_PER_ROW * rows and step != "all":
            continue  # few enough to be looked at one by one
        if step == "pivots":
            asked_now = stash(_next_pivots(open_lists, turn).join(tried, ["a", "b"], "left_anti"), f"ngram-more{turn}")
            tried = tried.unionByName(asked_now)
            more = _possible_pairs(asked_now, light, num, den)
        else:
            more = stash(_between(open_lists, light, num, den, step == "forest").join(tried, ["a", "b"], "left_anti"), f"ngram-more{turn}")
            tried = tried.unionByName(more.select("a", "b"))
        new = link(more, f"turn{turn}")
        if new.limit(1).count():
            links = links.unionByName(new)
            part = _labels(nodes, links)
        discard(open_lists)
    labelled = classes.join(part, "node", "left").withColumn("part", F.coalesce("component", "node"))
    parts = labelled.groupBy("part").agg(F.min("rep").alias("part_id"), F.count(F.lit(1)).alias("_sets"))
    # Most components are one set: only the others are looked up.
    several = stash(parts.filter("_sets > 1").drop("_sets"), "ngram-parts")
    done = labelled.join(several, "part", "left").select(*same_set, "class_size", ((F.col("class_size") == 1) & several["part_id"].isNull()).alias("alone"), "part", F.coalesce("part_id", "rep").alias("part_id"))
    return marks, stash(done, "ngram-result")


def similarity_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_size, component_id.

    Words are runs of bytes other than white space (0x20, 0x09-0x0D), A-Z lower-cased. Two rows are linked when
    den * |A and B| >= num * |A or B| for their sets of distinct n-word shingles; component_id is the smallest id
    that links reach from a row, its own included. class_size is the number of rows with the very same set.

    Shingles are told apart by 64-bit hashes; everything else is exact.

    Defined cases: a text with fewer than n words has its whole sequence as its one shingle; a null or blank
    text has none, is linked with nothing and is its own component; a null id names no component, so such a
    row takes the smallest id that links reach, null if there is none; rows that repeat an id with different texts are
    different rows, each with its own set and links; an empty table gives no rows; other columns are ignored.
    """
    marks, sets = _classes(docs, n, num, den, id_col, text_col, None)
    return marks.join(sets, ["n_shingles", "k1", "k2"], "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("part_id")).alias("component_id"),
    )


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    if not links.limit(1).count():
        return nodes.withColumn("component", F.col("node"))
    return stash(nodes.join(components(links), "node", "left").select("node", F.coalesce("component", "node").alias("component")), "ngram-labels")


def _several(members: DataFrame, part: DataFrame) -> DataFrame:
    """(sig, node, component) of columns whose rows lie in more than one component, one column for each set of rows."""
    labelled = members.join(part, "node")
    # Columns of a shared passage stand in the same rows: of columns with equal sets of rows one is enough.
    same = [F.bit_xor(F.xxhash64(F.col("node"), F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)]
    several = labelled.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n_rows"), *same).filter("lo != hi")
    one = several.groupBy("n_rows", "x1", "x2").agg(F.min("sig").alias("sig")).select("sig", "n_rows")
    return _of_column(labelled, stash(one, "ngram-several")).select("sig", "node", "component")


def _sizes(open_lists: DataFrame) -> tuple[int, int]:
    """How many rows there are, and how many pairs of rows of one column lie between components."""
    each = open_lists.groupBy("sig", "component").agg(F.count(F.lit(1)).cast("double").alias("n"))
    of_sig = each.groupBy("sig").agg(F.sum("n").alias("n"), ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"))
    n, pairs = of_sig.agg(F.sum("n"), F.sum("pairs")).first()
    return int(n or 0), int(pairs or 0)


def _next_pivots(open_lists: DataFrame, turn: int) -> DataFrame:
    """Pairs of one more pivot of each column, picked by a hash, with the rows outside its component."""
    pick = F.xxhash64(F.col("node"), F.lit(turn))
    pivots = stash(open_lists.groupBy("sig").agg(F.min_by(F.struct("node", "component"), pick).alias("p"), F.count(F.lit(1)).alias("n_rows")).select("sig", "n_rows", F.col("p.node").alias("p"), F.col("p.component").alias("pc")), "ngram-pivots")
    rows = _of_column(open_lists, pivots).filter("component != pc")
    return rows.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()


def _between(open_lists: DataFrame, light: DataFrame, num: int, den: int, forest: bool) -> DataFrame:
    """Of every pair of a column's rows that lies between two components, those that sizes and sketches leave; with ``forest``
    no more of a block pair than would join its components.

    A column's rows are dealt by size into classes so that linked rows are at most one class apart, and each class into
    blocks of about BLOCK_ROWS. Each pair of blocks of one class or of neighbours is one group: no task holds more than
    two blocks, and no pair is made before it has passed.
    """
    sized = open_lists.join(light.select("node", "n"), "node")
    of_size = F.floor(F.log(F.col("n").cast("double")) / math.log(den / num * 1.0001)).cast("long") if num < den else F.col("n")
    rows = stash(sized.select("sig", "node", "component", "n", of_size.alias("size_class")), "ngram-sized")
    blocks = rows.groupBy("sig", "size_class").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"), F.count(F.lit(1)).alias("n"))
    # At most one entry for each size class, of which there are as many as logarithms of sizes.
    of_sig = stash(blocks.groupBy("sig").agg(F.map_from_entries(F.collect_list(F.struct("size_class", "blocks"))).alias("blocks"), F.sum("n").alias("n_rows")), "ngram-blocks")
    block = lambda size, number: F.shiftleft(size, 24) + number
    rows = _of_column(rows, of_sig)
    rows = rows.withColumn("side", block(F.col("size_class"), F.pmod(F.xxhash64("node"), F.col("blocks")[F.col("size_class")])))
    near = lambda d: F.when(F.map_contains_key("blocks", F.col("size_class") + d), F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks")[F.col("size_class") + d] - 1), lambda i: block(F.col("size_class") + d, i))).otherwise(F.array().cast("array<long>"))
    # While each class is one block, a class and the next one are one group, and a row goes to two at most.
    small = F.forall(F.map_values("blocks"), lambda b: b == 1)
    rows = rows.withColumn("small", small).withColumn("other", F.explode(F.when(F.col("small"), F.concat(near(-1), near(0))).otherwise(F.concat(near(-1), near(0), near(1)))))
    i, j = (F.when(F.col("small"), F.col("other")).otherwise(f("side", "other")) for f in (F.least, F.greatest))
    # The sketches, most of the bytes, come last.
    full = rows.select("sig", i.alias("i"), j.alias("j"), "node", "component", "side", "n").join(light.select("node", "sketch"), "node").select("sig", "i", "j", "node", "component", "side", "n", "sketch")
    parts = int(full.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = full.repartition(parts, "sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return sorted_.mapInArrow(tidied(_block_pairs(num, den, forest)), "a long, b long, na long, nb long").distinct()


def keep_one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of near copies, all columns as they were.

    The row with the smallest id stays, of rows that repeat it the one whose text has the smallest digest, and of rows
    that repeat the text as well one by a hash of all columns. Each row is judged for itself, by its id and text.

    Defined cases: null and blank texts are nobody's copies and stay, as does a text that is like no other, whatever
    its id; rows with null ids stay only where their component has no id; an empty table gives no rows; other columns may have
    any names.
    """
    digest = lambda text: F.unhex(F.md5(text_or_empty(text)))
    marks, sets = _classes(docs, n, num, den, id_col, text_col, digest(F.col(text_col)))
    told = stash(marks.join(sets.filter("not alone"), ["n_shingles", "k1", "k2"]).select("doc_id", "tag", "part"), "ngram-told")
    stays = F.struct(F.col("doc_id").isNull(), "doc_id", "tag")
    one = stash(told.groupBy("part").agg(F.min(stays).alias("stays"), F.count(F.lit(1)).alias("n_rows")).withColumnRenamed("part", "sig"), "ngram-one")
    verdicts = _of_column(told.withColumnRenamed("part", "sig"), one).select("doc_id", F.col("tag").alias("key"), (F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("tag") == F.col("stays.tag"))).alias("kept"))
    return kept_rows(docs, verdicts, digest, id_col, text_col)
