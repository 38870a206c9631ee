"""Cases at the edges of the operators: extreme norms, pages without an article's text, texts without spaces, odd column names."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from reelmill.llm import bpe, html_text, ngram_join, pii, shared, toxicity, vptree


@pytest.mark.parametrize("scale", [1.0, 1e200, 1e-200, 1e-310, 1e308])
def test_nearest_of_extreme_norms(spark, scale):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 4))
    base /= np.abs(base).max()
    sizes = np.where(np.arange(30) % 3 == 0, scale, 1.0)
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(base, sizes, strict=True))] + [(100, [0.0] * 4)]
    got = vptree.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, every=10).collect()
    unit = base / np.linalg.norm(base, axis=1)[:, None]
    for q in (0, 10, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        cos = unit @ unit[q]
        want = [i for i in np.argsort(-cos) if i != q][:5]
        assert [r.vec_id for r in mine] == want
        assert [r.score for r in mine] == pytest.approx(cos[want].tolist(), abs=1e-6 if scale == 1e-310 else 1e-12)


WORDS = "The ferry left the harbour before noon and the crew began to repair the sails while the passengers slept below. "


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div class="cookie-notice"><p>We use cookies to make this site better for you and for us all.</p></div>', ""),
        ('<article></article><section class="comments"><p>What a fine story, I read it twice and liked it more each time.</p></section>', ""),
        ('<ul><li><a href="/">Home</a></li><li><a href="/n">All the latest news</a></li><li><a href="/c">Contact the editors</a></li></ul>', ""),
        ("<nav><p>" + WORDS + "</p></nav><footer>" + WORDS + "</footer>", ""),
        ('<form class="search"><label>Find a story</label></form><div role="alert">' + WORDS + "</div>", ""),
        ("<script>var a = 1</script><style>p {}</style><!-- " + WORDS + " -->", ""),
        ("<article><p>" + WORDS + "</p></article><div class='comments'><p>" + WORDS * 3 + "</p></div>", WORDS.strip()),
        ("<article><h1>Sails</h1><p>" + WORDS + "</p></article><aside><p>" + WORDS + "</p></aside><article><h1>Oars</h1><p>" + WORDS + "</p></article>", ("Sails " + WORDS + "Oars " + WORDS).strip()),
        ("<article><p>" + WORDS + "</p><p>Short.</p><ul><li>One</li><li>Two</li></ul></article>", WORDS + "Short. One Two"),
        ("<p>" + WORDS + "</p>", WORDS.strip()),
        ("<p>Tea &amp; cake&#8212;caf&eacute;</p>", "Tea & cake—café"),
        ("<p>  a\n\t b&nbsp;c </p>", "a b c"),
        ("plain text without a tag", "plain text without a tag"),
        ("<html><head><title>Sails</title></head><body></body></html>", ""),
        ("<header><a href='/'>Site</a></header><main><p>" + WORDS + "</p></main>", WORDS.strip()),
        ("<div hidden><p>" + WORDS + "</p></div>", ""),
        ("<div style='display: none'>" + WORDS + "</div><p>" + WORDS + "</p>", WORDS.strip()),
        ("<article><div class='advert'>" + WORDS + "</div><p>" + WORDS + "</p></article>", WORDS.strip()),
        ("", ""),
        (None, ""),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_parts_without_spaces_are_not_kept(monkeypatch):
    model = bpe.MODEL
    library = Tokenizer.from_file(model)
    library.no_truncation()
    library.no_padding()
    known = bpe.Parts(bpe.Bpe.of(model))
    rng = np.random.default_rng(0)
    for _ in range(20):
        texts = {"".join(chr(c) for c in rng.integers(0x4E00, 0x9FFF, 500)) for _ in range(5)} | {"word", "Word,"}
        known.know(texts)
        for t in texts:
            assert known.ids[t] == " ".join(map(str, library.encode(t, add_special_tokens=False).ids))
    assert len(known.ids) <= 7 and max(known.bytes.values()) < 5_000
    monkeypatch.setattr(bpe.Parts, "MOST_BYTES", 30_000)
    for g in range(40):
        some = {f"w{g}x{i}" for i in range(40)}
        known.know(some)
        assert all(known.ids[t] == " ".join(map(str, library.encode(t, add_special_tokens=False).ids)) for t in some)
        assert len(known.ids) + len(known.older[0]) < 400 and len(known.word_ids) + len(known.older_words[0]) < 800


def test_text_columns_are_found_as_spark_finds_them(spark):
    docs = spark.createDataFrame([(1, "mail me at ann@example.com", "zzz"), (2, None, "x@y.zz")], "doc_id long, Text string, last string")
    got = {r.doc_id: tuple(r) for r in pii.mask_pii(docs).collect()}
    assert "ann@example.com" not in got[1][1] and got[1][2] == "zzz" and got[2] == (2, None, "x@y.zz")
    twice = docs.toDF("doc_id", "text", "text")
    with pytest.raises(ValueError, match="2 columns"):
        shared.place_of(twice, "text")
    with pytest.raises(ValueError, match="0 columns"):
        pii.mask_pii(docs, text_col="body")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.reject_toxic(docs, labels).count() == 2
    assert ngram_join.keep_one_of_each(docs, n=5, num=80, den=100).count() == 2


def test_searches_leave_one_table(spark):
    import os

    folder = shared.stash(spark.range(1), "probe")._stashed_at.rsplit("/", 1)[0].removeprefix("file:")
    before = set(os.listdir(folder))
    rng = np.random.default_rng(1)
    out = vptree.nearest_neighbours(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 3)))], "vec_id long, embedding array<double>"), every=20)
    assert out.count() == 15
    assert len(set(os.listdir(folder)) - before) == 1
    shared.discard(out)
    assert set(os.listdir(folder)) == before
