"""SentencePiece, clustering and search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

from reelmill.llm import annulus, block_max, piece_bpe
from reelmill.llm.piece_bpe import MODEL, Chunks, PieceBpe

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# SentencePiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return PieceBpe.of(MODEL)


ALPHABETS = ["a", "ab", " ", "a ", "ab  \n", "theand ing", "▁ a", "0123456789", "漢字日本語テスト中文的是", "éàüñ漢\0<>s/\t", "=-_*#", "The quick.Brown,(fox) "]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_encodes_as_the_library(pieces, library, alphabet):
    r = random.Random(alphabet)
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 70))) for _ in range(300)]
    got = pieces.encode(texts)
    assert got == [library.encode(t) for t in texts]
    assert [pieces.decode(x) for x in got] == [library.decode(x) for x in got]


def test_pieces_side_by_side_as_the_library(pieces, library):
    r = random.Random(5)
    shown = [p.replace("▁", " ") for p in pieces.id]
    texts = ["".join(r.choice(shown) for _ in range(r.randint(1, 12))) for _ in range(1500)]
    texts += ["".join(chr(r.choice([r.randint(1, 0xD7FF), r.randint(0x10000, 0x10FFFF)])) for _ in range(20)) for _ in range(200)]
    assert pieces.encode(texts) == [library.encode(t) for t in texts]


def test_runs_of_spaces_as_the_library(pieces, library):
    texts = [" " * k for k in range(120)] + ["x" + " " * k + "y" for k in range(70)] + [" " * 20000, "a" * 5000, "<s> </s> <unk> <0x0A>"]
    assert pieces.encode(texts) == [library.encode(t) for t in texts]


def test_a_failed_place_is_left(pieces):
    """Some words can't begin with their longest piece: the search has to come back from it."""
    backs = 0
    for word in ["▁" + w for w in "Airech Ananes Anat Aneaed".split()]:
        ids = pieces.encode_words([word])[0]
        longest = max(len(p) for p in pieces.id if word.startswith(p))
        backs += pieces.length[ids[0]] < longest
        assert "".join(pieces.piece[i] for i in ids) == word
    assert backs == 4


def test_decodes_any_ids_as_the_library(pieces, library):
    r = random.Random(2)
    for most in (32000, 270):
        for _ in range(500):
            ids = [r.randrange(most) for _ in range(r.randint(0, 7))]
            assert pieces.decode(ids) == library.decode(ids)


def test_borders_are_those_of_merging_anew(pieces, library):
    r = random.Random(3)
    made = [i for i in pieces.id.values() if pieces.length[i] and "▁" not in pieces.piece[i]]
    for _ in range(3000):
        a, b = r.choice(made), r.choice(made)
        whole = library.encode("\n" + pieces.piece[a] + pieces.piece[b])[2:]  # after a line end there is no space in front
        assert pieces._stay_apart(a, b) == (whole == [a, b])


def test_digests_of_documents(spark, docs, pieces, library):
    texts = [None, "", " ", "one two  two", "one two  two", "\n\nx \n", "漢字" * 400, "word " * 20000, "y" * 3000]
    table = docs([*enumerate(texts), (3, "repeated id"), (None, "no id")])
    got = rows_of(piece_bpe.piece_digests(table))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in [*enumerate(texts), (3, "repeated id"), (None, "no id")]:
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(want, key=repr)
    assert piece_bpe.piece_digests(docs([]).limit(0)).count() == 0
    back = piece_bpe.piece_decode(piece_bpe.piece_encode(table))
    assert rows_of(back) == sorted([(i, t or "") for i, t in [*enumerate(texts), (3, "repeated id"), (None, "no id")]], key=repr)


def test_kept_chunks_are_bounded(pieces, monkeypatch):
    monkeypatch.setattr(Chunks, "MOST_BYTES", 20_000)
    known = Chunks(pieces)
    for g in range(40):
        some = {f"▁w{g}x{i}" for i in range(30)} | {"漢字" * 100 + str(g)}
        table = known.look_up(some)
        assert all(table[c] == ",".join(map(str, pieces.encode_words([c])[0])) for c in some)
        assert len(known.known) + len(known.older) < 250
        assert not any(len(c) > Chunks.LONGEST for c in known.known)


# Clusters


def plain_clusters(rows, k, rounds, dims=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in kept[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, vs in groups.items():
            centres[j] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, j, d in last:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for i, j, d in last), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], "vec_id long, embedding array<double>, cluster int, q string").repartition(3)


def test_clusters_are_the_plain_ones(spark):
    r = np.random.default_rng(4)
    middles = r.normal(0, 2, (6, 64))
    rows = [(i, (middles[i % 6] + r.normal(0, 0.3, 64)).tolist()) for i in range(150)]
    rows += [(7, rows[7][1]), (200, [0.0] * 64), (201, [-1e4] * 64), (202, (middles[0] * 300).tolist())]
    odd = [(300, None), (301, [1.0] * 63), (302, [1.0] * 63 + [None]), (303, [1.0] * 63 + [float("nan")]), (304, [float("inf")] + [0.0] * 63), (305, [])]
    for k, rounds in ((9, 5), (1, 2), (40, 0)):
        assert rows_of(annulus.cluster(vectors(spark, rows + odd), k=k, rounds=rounds)) == plain_clusters(rows, k, rounds)


def test_few_vectors_ties_and_nothing(spark):
    rows = [(1, [1.0] * 64), (2, [1.0] * 64), (3, [-1.0] * 64), (None, [0.0] * 64), (None, [0.5] * 64)]
    assert rows_of(annulus.cluster(vectors(spark, rows))) == plain_clusters(rows, 40, 5)
    assert annulus.cluster(vectors(spark, [(1, None), (2, [1.0])])).count() == 0
    with pytest.raises(Exception, match="beyond"):
        annulus.cluster(vectors(spark, [(1, [1e30] * 64)])).count()


@pytest.mark.parametrize("scale", [3, 1000, 1 << 25])
def test_annulus_finds_the_nearest_with_ties(scale):
    r = np.random.default_rng(scale)
    for guess in (False, True):
        centres = r.integers(-scale, scale, (30, 4))
        centres[7] = centres[3]
        rows = r.integers(-scale, scale, (5000, 4))
        rows[:30] = centres
        which, best = annulus.Annulus(centres).nearest(rows, r.integers(0, 30, 5000) if guess else None)
        apart = ((rows[:, None, :] - centres[None]) ** 2).sum(2)
        assert (best == apart.min(1)).all()
        assert (which == apart.argmin(1)).all()  # the first of equal ones


def test_clusters_leave_one_table(spark, tmp_path):
    import os

    from reelmill.storage import discard, shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = annulus.cluster(vectors(spark, [(i, [float(i)] * 64) for i in range(60)]))
    assert len(set(os.listdir(folder)) - before) == 1
    assert out.count() == 60
    discard(out)
    assert set(os.listdir(folder)) == before


# Search


def plain_search(docs, items, k=20):
    find = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+").findall
    lower = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    terms = [(i, Counter(find((t or "").translate(lower)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n = len(terms)
    words = sum(c.total() for _, c in terms)
    holding = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        asked = find((text or "").translate(lower))
        scored = []
        for i, c in terms:
            m = 75 + (25 * c.total() * n) // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in asked if c[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, table, items, **more):
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    return rows_of(block_max.search(docs(table), asked, **more).select("item_id", "rank", "doc_id", "score"))


@pytest.mark.parametrize("block", [1, 3, 64])
def test_finds_what_scoring_everything_finds(spark, docs, monkeypatch, block):
    monkeypatch.setattr(block_max, "BLOCK_DOCS", block)
    r = random.Random(block)
    words = [f"w{int(r.paretovariate(0.6))}" for _ in range(400)]
    table = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 60)))) for i in range(400)]
    table += [(7, table[7][1]), (8, "W1 w1, w1-W1"), (1000, table[3][1]), (1001, table[3][1]), (2000, None), (2001, ""), (2002, " ... "), (None, "w1 w2")]
    table += [(3000, "w1 w2 é漢字 " * 70000), (3001, "x" * 3_000_000 + " w1")]
    items = [(j, " ".join(r.choice(words) for _ in range(r.randint(1, 12)))) for j in range(25)]
    items += [(50, None), (51, ""), (52, "?!"), (53, "never seen"), (54, "w1 w1 w1 É漢字"), (55, "é漢字"), (3, "w2"), (3, "w2")]
    assert searched(spark, docs, table, items) == plain_search(table, items)
    assert searched(spark, docs, table, items, k=3) == plain_search(table, items, 3)


def test_searches_in_groups_and_on_nothing(spark, docs, monkeypatch):
    table = [(i, f"a{i % 7} b{i % 3} c") for i in range(60)]
    items = [(j, f"a{j} b{j % 3} c") for j in range(9)]
    monkeypatch.setattr(block_max, "QUERY_BYTES", 20)
    assert searched(spark, docs, table, items) == plain_search(table, items)
    assert searched(spark, docs, [(1, None), (2, "")], items) == []
    assert searched(spark, docs, table, [(1, ""), (2, None)]) == []
    assert searched(spark, docs, [], items) == []


def test_terms_of_long_texts_in_windows(monkeypatch):
    r = random.Random(1)
    text = "".join(r.choice("abcABC  ,.é漢\n") for _ in range(5000)).encode()
    monkeypatch.setattr(block_max, "WINDOW", 7)
    assert [t for ts in block_max._windows(text) for t in ts] == block_max.terms_of(text)


def test_blocks_below_the_score_to_reach_are_left():
    """Of 200 blocks with one good one, only a few are scored."""
    scored = []

    class Seen(block_max._Leaders):
        def take(self, scores, docs):
            scored.append(docs)
            super().take(scores, docs)

    import pyarrow as pa

    queries = block_max.Queries.of([(1, "a b")]).weigh(1000, 9000, {0: 10, 1: 10})
    r = random.Random(9)
    raw = []
    for b in range(200):
        parts = [r.randrange(1, 1000) * (100 if b == 77 else 1) for _ in range(8)]
        raw.append((b, list(range(b * 4, b * 4 + 4)), [2, 4, 6, 8], [0, 1] * 4, parts, [0, 1], [max(parts[0::2]), max(parts[1::2])]))
    kinds = [pa.int64(), pa.list_(pa.int64())] + [pa.list_(pa.int32())] * 5
    names = [c.split()[0] for c in block_max.INDEX.split(", ")]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*raw, strict=True), kinds, strict=True)], names)
    old, block_max._Leaders = block_max._Leaders, Seen
    try:
        (found,) = block_max._search(queries, 3, {})(iter([batch]))
    finally:
        block_max._Leaders = old
    assert len(scored) < 20
    want = sorted(((-sum(int(queries.weight[t]) * p for t, p in zip((0, 1), row[4][2 * d : 2 * d + 2], strict=True)), row[1][d]) for row in raw for d in range(4)))[:3]
    assert sorted(zip((-s for s in found["score"].to_pylist()), found["doc_id"].to_pylist(), strict=True)) == want


def test_operators_on_the_tables(spark):
    if not __import__("os").path.isdir(SF):
        pytest.skip("the tables are not here")
    read = lambda name, *c: [tuple(r.values()) for r in pq.read_table(f"{SF}/{name}.parquet").select(c).to_pylist()]
    found = block_max.search(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert rows_of(found.select("item_id", "rank", "doc_id", "score")) == plain_search(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    embeddings = spark.read.parquet(f"{SF}/embeddings.parquet").filter(F.col("vec_id") < 120)
    assert rows_of(annulus.cluster(embeddings, k=5, rounds=2)) == plain_clusters([x for x in read("embeddings", "vec_id", "embedding") if x[0] < 120], 5, 2)
