"""Classifiers by held-out accuracy, pages, neighbours by brute force, and the pipeline."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmill.llm import html_text, labelled, quality, toxicity, vptree

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@needs_tables
def test_quality_held_out(spark):
    d, lab = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(d, lab).join(lab, "doc_id").toPandas()
    out = got[got.held_out]
    assert (out.predicted == out.quality).mean() > 0.95
    assert got.score.between(0, 1).all()


@needs_tables
def test_toxicity_held_out(spark):
    """What the model has not seen: most toxic texts are found, hardly any other is taken for one, and the order is right."""
    folder = SF.replace("sf0.01", "sf0.1")
    d, lab = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_scores(d, lab).join(lab, "doc_id").toPandas()
    out = got[got.held_out]
    toxic, ranks = out.toxic == 1, out.score.rank()
    assert (out.predicted == out.toxic).mean() > 0.95 and out.predicted[toxic].mean() >= 0.8
    assert (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum()) > 0.95
    assert got[(got.toxic == 0)].predicted.mean() < 0.03
    assert got.score.between(0, 1).all()


def test_classifier_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, None), (2, ""), (None, "x"), (3, "word " * 5000), (3, "word " * 5000)]
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        got = scores(docs(rows), none).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
        assert scores(docs([]), none).count() == 0
    few = spark.createDataFrame([(i, 1, 1) for i in range(1, 9)], none.schema)
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        assert scores(docs([(i, f"bad words {i}") for i in range(1, 9)]), few).count() == 8


def test_flat_trees_are_the_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit_trees(x, y, rounds=30, depth=3)
    assert ((model.scores(x) > 0.5) == y).mean() > 0.95
    for row in x[:50]:
        total = model.base
        for t in range(len(model.column)):
            i = 0
            for _ in range(3):
                i = 2 * i + (2 if row[model.column[t, i]] > model.threshold[t, i] else 1)
            total += model.value[t, i - 7]
        assert model.margins(row[None])[0] == pytest.approx(total)


def pu_rows(rng, dim=12):
    """Feature numbers of positives, which tend to have the first ones, and of unlabelled texts, a tenth of them alike."""
    positive = lambda: np.flatnonzero(rng.random(dim) < np.where(np.arange(dim) < 3, 0.8, 0.1)).astype(np.int32)
    plain = lambda: np.flatnonzero(rng.random(dim) < np.where(np.arange(dim) < 3, 0.01, 0.1)).astype(np.int32)
    return [positive() for _ in range(200)], [plain() for _ in range(900)] + [positive() for _ in range(100)]


def plain_risk(w, bias, p, u, prior):
    f = lambda r: sum(w[i] for i in r) + bias
    loss = lambda z: np.log(1 + np.exp(-z))
    of_p = sum(prior * loss(f(r)) for r in p) / len(p)
    negative = sum(loss(-f(r)) for r in u) / len(u) - sum(prior * loss(-f(r)) for r in p) / len(p)
    return of_p, negative


@pytest.mark.parametrize("prior, bias", [(0.1, -2.0), (0.9, 3.0)])
def test_risk_and_gradient_are_the_plain_ones(prior, bias):
    rng = np.random.default_rng(1)
    p, u = pu_rows(rng)
    w = rng.normal(size=12)
    if prior == 0.9:
        u = [r[:0] for r in u]  # so the negative part is below zero
        w = np.abs(w)
    got = toxicity.pu_risk(w, bias, p, toxicity.unlabelled_part(w, bias, u), prior)
    want = plain_risk(w, bias, p, u, prior)
    assert got == pytest.approx(want) and (want[1] < 0) == (prior == 0.9)
    part = (lambda x: sum(plain_risk(x[:-1], x[-1], p, u, prior))) if want[1] >= 0 else (lambda x: -plain_risk(x[:-1], x[-1], p, u, prior)[1])
    x = np.append(w, bias)
    slope = [(part(x + e) - part(x - e)) / 2e-5 for e in np.eye(13) * 1e-5]
    assert toxicity.pu_gradient(w, bias, p, toxicity.unlabelled_part(w, bias, u), prior) == pytest.approx(slope, abs=1e-6)


def test_fit_tells_positives_among_unlabelled():
    p, u = pu_rows(np.random.default_rng(1))
    w, bias = toxicity.fit_nnpu(p, lambda w, bias: toxicity.unlabelled_part(w, bias, u), 12, 0.1)
    score = toxicity.sigmoid(toxicity.margins(w, bias, p + u))
    assert (score[:200] >= 0.5).mean() > 0.8 and (score[200:1100] >= 0.5).mean() < 0.05  # some 3 % have a telling feature
    part = lambda w, bias: toxicity.unlabelled_part(w, bias, u)
    risk = toxicity.pu_risk(w, bias, p, part(w, bias), 0.1)
    assert risk[0] + max(0, risk[1]) < sum(toxicity.pu_risk(np.zeros(12), -2.2, p, part(np.zeros(12), -2.2), 0.1))


def test_repeated_labelled_ids_count_once(spark, docs):
    schema = "doc_id long, quality int, toxic int"
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    text = lambda toxic: " ".join([*rng.choice(words, 30), *(["vile", "rotten"] if toxic else [])])
    rows = [(i, text(i % 4 == 0)) for i in range(1, 400)]
    marks = [(i, 1, int(i % 4 == 0)) for i, _ in rows]
    labels = spark.createDataFrame(marks + marks[:50] * 3, schema)
    again = [r for r in rows if r[0] in (4, 8, 2)] * 500
    ids = labelled.sample_ids(docs(rows + again).select("doc_id"), 60, 2)
    assert ids.count() == 60 == ids.distinct().count()
    assert {r[0] for r in ids.collect()} == {r[0] for r in labelled.sample_ids(docs(rows).select("doc_id"), 60, 2).collect()}
    assert labelled.texts_of(docs(rows + again), ids).count() == 60
    for table in (rows, rows + again):
        got = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs(table), labels).collect()}
        assert np.mean([got[i] == t for i, _, t in marks]) > 0.97
    model, share = quality.train(docs(rows + again), labels.withColumn("quality", F.col("toxic")), most=10_000)
    assert model is not None and 0.15 < share < 0.35


def test_counts_are_over_all_texts(spark, docs):
    """Feature counts and text count against plain ones."""
    from reelmill.llm.words import Words

    texts = ["alpha beta", "beta", None, "", "gamma alpha alpha", "Alpha!"]
    of = lambda t: next(toxicity.features(Words(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))))
    names = np.unique(np.concatenate([of("alpha"), of("gamma")]))
    found = docs(list(enumerate(texts))).select("text").mapInArrow(toxicity._counts(toxicity.Known(names)), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    want = {i: n for i in range(len(names)) if (n := sum(names[i] in of(t) for t in texts))} | {-1: len(texts)}
    assert {r[0]: r[1] for r in found} == want


def test_sums_over_all_texts_dont_depend_on_how_they_lie(spark):
    """A step's sums from tasks, from rows counted together and from one plain call are the same numbers."""
    _, u = pu_rows(np.random.default_rng(2))
    w, bias = np.abs(np.random.default_rng(3).normal(size=12)), -1.5
    want = toxicity.unlabelled_part(w, bias, u)
    table = spark.createDataFrame([(r.astype(np.int32).tobytes(), 1) for r in u], "vector binary, n long")
    for made in (table.repartition(3), table.groupBy("vector").agg(F.sum("n").alias("n")).repartition(2)):
        assert toxicity._all_parts(made)(w, bias).tolist() == want.tolist()


def test_first_split_is_the_best_one():
    """The root's split against the gain of every column and border."""
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 9, size=(120, 4)).astype(float), (rng.random(120) < 0.5).astype(float)
    y[x[:, 2] > 4] = 1
    model = quality.fit_trees(x, y, rounds=1, depth=1, least=1.0, smooth=1.0)
    p = y.mean()
    g, h = p - y, np.full(120, p * (1 - p))
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
    gains = {(j, t): score(x[:, j] <= t) + score(x[:, j] > t) for j in range(4) for t in np.unique(x[:, j])[:-1] if min(h[x[:, j] <= t].sum(), h[x[:, j] > t].sum()) >= 1}
    j, t = max(gains, key=gains.get)
    assert model.column[0, 0] == j and ((x[:, j] > model.threshold[0, 0]) == (x[:, j] > t)).all()
    for side, leaf in ((x[:, j] <= t, 0), (x[:, j] > t, 1)):
        assert model.value[0, leaf] == pytest.approx(-0.15 * g[side].sum() / (h[side].sum() + 1))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div><!-- c --><div class="ad">Buy</div>
<article><h1>Head&amp;line</h1><p><b>One  two.<br><p>Three &eacute; &#233;\n four.</p><p>x</p><form><input><label>Mail</label></form><section class="comments"><p>I think so</p></section></article>
<aside>side</aside><footer>&copy; foot</footer></body></html>"""


def test_pages(spark):
    rows = spark.createDataFrame([(1, "u", PAGE, "clash"), (2, None, None, ""), (None, "v", "", ""), (3, "w", "plain", ""), (3, "w", "<<<>>&amp", ""), (4, "z", "<p>a<p>b<div>c", "")], "page_id long, url string, html string, text string")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract_main_text(rows).collect()]
    assert (1, "u", "Head&line One two. Three é é four. x", 36) in got
    assert (2, None, "", 0) in got and (None, "v", "", 0) in got and (3, "w", "plain", 5) in got and len(got) == 6
    assert html_text.extract_main_text(rows.limit(0)).count() == 0


def test_page_without_article():
    text = "A long paragraph of text that goes on and on for a while, with words."
    page = f'<div class="menu"><a href=x>a</a></div><div id="content"><h2>T</h2><p>{text}</p><p>Short.</p><p>{text}</p></div><div class="comments"><p>{text}</p></div>'
    assert html_text.main_text(page) == f"T {text} Short. {text}"


LONG_TEXT = "A long paragraph of text that goes on and on for a while, with words."


def test_body_beside_a_short_article():
    p = f"<p>{LONG_TEXT}</p>"
    assert html_text.main_text(f"<div>{p * 6}</div><article><h3>Card</h3></article>") == " ".join([LONG_TEXT] * 6)
    assert html_text.main_text(f"<article><h3>Card</h3></article><div>{p * 6}</div>") == " ".join([LONG_TEXT] * 6)
    assert html_text.main_text(f"<article><h2>One</h2>{p * 3}</article><p>by</p><article><h2>Two</h2>{p * 3}</article>") == " ".join(["One", *[LONG_TEXT] * 3, "Two", *[LONG_TEXT] * 3])


@pytest.mark.parametrize("wrapper", ['class="site has-sidebar"', 'id="wrap" class="with-footer"', 'class="comments-open"'])
def test_layout_named_after_a_part(wrapper):
    p = f"<p>{LONG_TEXT}</p>"
    parts = f'<div class="sidebar"><p>{LONG_TEXT}</p></div><div class="comments">{p * 2}</div>'
    for body in (f"<article>{p * 4}</article>", f"<main>{p * 4}</main>"):
        assert html_text.main_text(f"<body><div {wrapper}>{body}{parts}</div><p>x</p></body>") == " ".join([LONG_TEXT] * 4)
    assert html_text.main_text(f"<body><div {wrapper}>{p * 4}</div></body>") == " ".join([LONG_TEXT] * 4)
    assert html_text.main_text(f'<article>{p}</article><div class="comments">{p * 9}</div><div class="sidebar"><a href=x>{LONG_TEXT * 9}</a></div>') == LONG_TEXT


def test_page_in_a_form_and_words_that_only_look_like_names():
    long = " ".join([LONG_TEXT] * 4)
    assert html_text.main_text(f"<body><form action=x><div><p>{long}</p></div></form></body>") == long
    assert html_text.main_text(f"<body><form><article><p>{long}</p></article><form><input> Search</form></form></body>").startswith(long)
    kept = '<p class="share-price">The price rose.</p><p id="search-engines">Engines found it.</p><div class="related-work">Others did it.</div>'
    gone = '<div class="related-posts">More</div><div class="share-buttons">Like</div><div class="adSlot">Buy</div><div id="comments">Nice</div><form>Mail</form>'
    assert html_text.main_text(f"<article>{kept}<p>{long}</p>{gone}</article>") == f"The price rose. Engines found it. Others did it. {long}"


def test_headline_in_the_header_of_a_page_without_article():
    header = '<header><a href="/">Site</a><h1>The headline</h1></header>'
    assert html_text.main_text(f"{header}<div><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p></div>").endswith(f"{LONG_TEXT} {LONG_TEXT}")
    assert "The headline" in html_text.main_text(f"{header}<div><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p></div>")
    linked = '<header><h1><a href="/">Site</a></h1></header>'
    assert html_text.main_text(f"{linked}<div><p>{LONG_TEXT}</p></div>") == LONG_TEXT
    assert html_text.main_text(f"{header}<article><p>{LONG_TEXT}</p></article>") == LONG_TEXT


def test_deep_pages_in_linear_time():
    import time

    began = time.process_time()
    for page in ("<article>" * 20_000 + "x", "<b>" * 20_000 + "</i>" * 20_000 + "x", "<ul><li>" + "<div>" * 20_000 + "x", "<ul><li>" + "<section>" * 20_000 + "x", "<p>x" * 20_000):
        assert html_text.main_text(page).startswith("x")
    for page in ("<a href=y>" * 20_000 + "x", '<div class="ad">' * 20_000 + "x"):  # nothing but a link, nothing but an advert
        assert html_text.main_text(page) == ""
    assert time.process_time() - began < 20


def plain_choice(lines):
    """Ratios, smoothing and the threshold, line by line: which lines are content, before articles are widened."""
    ratio = [len(t) / max(1, tags) for t, tags, _, _ in lines]
    weights = {d: np.exp(-0.5 * d * d) for d in range(-3, 4)}
    level = []
    for i, (_, _, _, a) in enumerate(lines):
        lo = hi = i
        while lo > 0 and lines[lo - 1][3] == a:
            lo -= 1
        while hi + 1 < len(lines) and lines[hi + 1][3] == a:
            hi += 1
        level.append(sum(w * ratio[min(hi, max(lo, i + d))] for d, w in weights.items()) / sum(weights.values()))
    mean = sum(level) / len(level)
    deviation = (sum((x - mean) ** 2 for x in level) / len(level)) ** 0.5
    chosen = [(x >= min(deviation, max(level)) or x >= mean) and 2 * linked <= len(t) for x, (t, _, linked, _) in zip(level, lines, strict=True)]
    return chosen if any(chosen) else [i == level.index(max(level)) for i in range(len(level))]


@needs_tables
def test_content_is_the_plain_choice(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        parser = html_text._Lines()
        parser.feed(r.html or "")
        lines = parser.finish()
        if not lines:
            continue
        chosen = plain_choice(lines)
        above = lambda a: {a} | (above(parser.around[a]) if a else set())
        taken = {a for (_, _, _, a), c in zip(lines, chosen, strict=True) if c and a}
        want = " ".join(t for (t, _, _, a), c in zip(lines, chosen, strict=True) if c or taken & above(a))
        assert html_text.main_text(r.html) == want


def test_end_tags_left_out():
    assert html_text.main_text(f"<html><head><title>T</title><body><p>{LONG_TEXT}</body>") == LONG_TEXT
    assert html_text.main_text(f"<head><title>T</title><p>{LONG_TEXT}") == LONG_TEXT
    assert html_text.main_text(f'<div><p class="notice">n<p>{LONG_TEXT}<p>{LONG_TEXT}</div>') == f"{LONG_TEXT} {LONG_TEXT}"
    assert html_text.main_text(f'<ul><li class="share">s<li>{LONG_TEXT}<li><p>{LONG_TEXT}</ul>') == f"{LONG_TEXT} {LONG_TEXT}"


def brute_neighbours(ids, vectors, every, k):
    out = []
    v = np.array(vectors, float)
    for i, x in zip(ids, v, strict=True):
        if i % every == 0:
            s = vptree.cosine(v, x)
            other = np.flatnonzero(np.array(ids) != i)
            best = sorted(other, key=lambda j: (-s[j], ids[j]))[:k]
            out += [(i, r + 1, ids[j], s[j]) for r, j in enumerate(best)]
    return sorted(out)


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 60)
    monkeypatch.setattr(vptree, "QUERY_ROWS", 4)
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 8)).astype(np.float32)
    v[100:220] = v[3]
    v[5] = 2 * v[6]
    ids = rng.permutation(1000)[:300].tolist()
    good = [(i, [float(y) for y in x], 0) for i, x in zip(ids, v, strict=True)]
    bad = [(2000, None, 0), (2010, [0.0] * 8, 0), (2020, [1.0] * 7 + [None], 0), (2030, [float("nan")] * 8, 0), (2040, [float("inf")] * 8, 0), (None, [1.0] * 8, 0), (2050, [], 0), (2060, [1.0, 2.0], 0)]
    df = spark.createDataFrame(good + good[:20] + bad, "vec_id long, embedding array<float>, label int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in vptree.nearest_neighbours(df, k=5, every=10).collect())
    assert got == brute_neighbours(ids, [g[1] for g in good], 10, 5)
    assert vptree.nearest_neighbours(df.limit(0)).count() == 0


def test_coarse_tree_rules_out_only_what_is_far():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6))
    v = centres[rng.integers(12, size=900)] + 0.2 * rng.normal(size=(900, 6))
    tree = vptree.CoarseTree(v[:300], 16)
    leaf, away = tree.route(v)
    assert tree.leaves == 16 and set(leaf.tolist()) <= set(range(16))
    for x in np.unique(leaf):
        far = np.array([a for a, y in zip(away, leaf, strict=True) if y == x])
        tree.bound(int(x), far.min(0).tolist(), far.max(0).tolist())
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    d = np.sqrt(np.maximum(2 - 2 * unit[:40] @ unit.T, 0))
    reach = np.sort(d, axis=1)[:, 5]
    q, where = tree.visits(v[:40], reach, 1e-7)
    seen = set(zip(q.tolist(), where.tolist(), strict=True))
    need = {(i, int(leaf[j])) for i in range(40) for j in np.flatnonzero(d[i] <= reach[i])}
    assert need <= seen and len(seen) < 40 * 16 * 0.6  # clusters: most shards are passed over
    one = vptree.CoarseTree(np.ones((50, 3)), 8)  # all alike: no split does anything
    assert one.leaves == 1 and one.route(np.ones((4, 3)))[0].tolist() == [0] * 4


def test_neighbours_in_clusters(spark, monkeypatch):
    """Many shards, copies by the hundred, vectors of two lengths, and an id that stands for two vectors."""
    monkeypatch.setattr(vptree, "SHARD_ROWS", 25)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 5))
    v = centres[rng.integers(8, size=300)] + 0.1 * rng.normal(size=(300, 5))
    v[50:200] = v[7]
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(v)]
    rows += [(1000 + i, [float(y) for y in rng.normal(size=3)]) for i in range(30)] + rows[:100]
    got = sorted(tuple(r) for r in vptree.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, every=10).collect())
    want = brute_neighbours(list(range(300)), [x for _, x in rows[:300]], 10, 5) + brute_neighbours([i for i, _ in rows[300:330]], [x for _, x in rows[300:330]], 10, 5)
    assert got == sorted(want)
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [3.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, round(r.score, 6)) for r in vptree.nearest_neighbours(twice, k=5, every=10).orderBy("rank").collect()]
    assert got == [(2, 0.948683), (1, 0.707107)]


@pytest.mark.parametrize("kind", ["scaled", "one-hot", "binary"])
def test_neighbours_that_tie(kind):
    rng = np.random.default_rng(4)
    if kind == "scaled":
        v = np.concatenate([rng.normal(size=8) * 2.0 ** np.arange(50)[:, None], rng.normal(size=(150, 8))])
    elif kind == "one-hot":
        v = np.eye(50)
    else:
        v = np.unique(rng.integers(0, 2, size=(400, 9)), axis=0).astype(float)
        v = v[v.any(1)]
    v = v[rng.permutation(len(v))]
    ids = rng.permutation(1000)[: len(v)]
    got = vptree.VpTree(ids, v, 6).nearest(ids, v, 5)
    want = [(i, j) for i, _, j, _ in sorted(brute_neighbours(ids.tolist(), v, 1, 5))]
    assert sorted(x[0] for x in got) == [i for i, _ in want]
    ranked = {i: [x[1] for x in got if x[0] == i] for i in ids.tolist()}
    assert ranked == {i: [b for a, b in want if a == i] for i in ids.tolist()}


def test_relaxed_search_keeps_its_recall():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    v = centres[rng.integers(20, size=2000)] + 0.3 * rng.normal(size=(2000, 16))
    tree = vptree.VpTree(np.arange(2000), v, 6)
    exact = {x[:2] for x in tree.nearest(np.arange(100), v[:100], 5)}
    loose = {x[:2] for x in tree.nearest(np.arange(100), v[:100], 5, factor=0.7)}
    assert len(exact & loose) / len(exact) > 0.9


@needs_tables
def test_pipeline(spark):
    import corpus_pipeline

    d = spark.read.parquet(f"{SF}/documents.parquet")
    docs, before = d, d.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == d.columns and out.dtypes == d.dtypes
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipe-{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        now = docs.count()
        assert 0.7 * before < now <= before
        before = now
    assert docs.select(F.sha2("text", 256)).distinct().count() == before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == before


def test_pipeline_is_its_plain_version(spark, docs, tmp_path):
    """Every stage against plain Python, with nulls, empty texts, repeated rows and ids that stand for several texts."""
    import corpus_pipeline
    from reelmill.llm import packing, pii
    from reelmill.llm.byte_ids import ByteIds
    from test_text_operators import brute_components, low, near_rows

    near = [(i + 100, t) for i, t in near_rows(8, families=3, each=5)]
    rng = np.random.default_rng(3)
    mixed = [(400 + i, " ".join([*rng.choice(["so", "it", "goes", "on", "and", "far"], 12), *(["vile", "rotten"] if i % 3 == 0 else [str(i)])])) for i in range(90)]
    odd = [(1, None), (2, ""), (3, "Same text here"), (4, "same text here"), (3, "a text of its own by id three"), (5, "twice"), (5, "twice"), (None, "no id"), (None, "no id"), (None, "same text here"), (6, "mail a@b.co or +1 (277) 555-9423")]
    rows = near + mixed + odd
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 1)) for i, _ in mixed], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")

    model = toxicity.train(docs(rows), labels)
    data = lambda t: np.frombuffer((t or "").encode(), np.uint8)
    from reelmill.llm.words import Words

    left = [(i, t) for i, t in rows if model.of_words(Words(data(t), np.array([0, len(data(t))])))[0] < 0.5]
    assert 20 <= len(rows) - len(left) <= 34
    best = {}
    for i, t in left:  # the largest id of each text, null below all others
        k = low(t)
        if k not in best or (i is not None and (best[k][0] is None or i > best[k][0])):
            best[k] = (i, t)
    left = list(best.values())
    numbered = list(enumerate(left))
    parts = brute_components([(n, t) for n, (_, t) in numbered], 5, 80, 100)
    groups = {}
    for n, (i, t) in numbered:
        groups.setdefault(parts[n][1], []).append((i is None, i if i is not None else 0, t or ""))
    left = [min(g) for g in groups.values()]
    want = sorted((null, i) for null, i, _ in left)

    docs_now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs_now, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs_now = spark.read.parquet(f"{tmp_path}/{name}")
    got = docs_now.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == want
    texts = {t for _, _, t in left}
    masked = {pii.mask(t, base, added) for t in texts for _, _, [(base, added)] in pii.all_spans(pii.trained_field(), pii.pa.array([t]))}
    assert {low(r.text) for r in got} == {low(t) for t in masked}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs_now, str(tmp_path)).toPandas()
    assert packed.length.sum() == sum(len(ByteIds.of(packing.MODEL)(r.text or "")) // 4 + 1 for r in got)
    assert corpus_pipeline.run(spark, str(tmp_path)).groupBy().sum("length").first()[0] == packed.length.sum()


def test_pipeline_of_nothing(spark, docs, tmp_path):
    import corpus_pipeline

    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_stages_are_listed():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "pii", "packing"]
