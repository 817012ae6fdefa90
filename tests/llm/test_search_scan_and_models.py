import re
import zlib

import numpy as np
import pytest
from brute import LOWER
from pyspark.sql import functions as F

from starloom.llm import compression_quality, html_blocks, licenses, queries, vector_search

SF = "/root/testdata/sf0.01"


def plain_top(rows, k=10):
    """rows: {id: list of whole numbers}; all pairs."""
    out = []
    for q in rows:
        if q % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(rows[q], v, strict=True)), i) for i, v in rows.items() if i != q and len(v) == len(rows[q]))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def found(vectors, k=10):
    rows = vector_search.top_k(vectors, vectors.filter("vec_id % 100 = 0"), k).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)


@pytest.mark.parametrize(("shard", "block"), [(8192, 2048), (64, 2)])
def test_top_k_equals_all_pairs(spark, monkeypatch, shard, block):
    monkeypatch.setattr(vector_search, "SHARD_ROWS", shard)
    monkeypatch.setattr(vector_search, "QUERY_ROWS", block)
    monkeypatch.setattr(vector_search, "LEAF", 16)
    vectors = vector_search.scaled(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert found(vectors) == plain_top({r["vec_id"]: r["vector"] for r in vectors.collect()})


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "SHARD_ROWS", 8)
    monkeypatch.setattr(vector_search, "LEAF", 4)
    r = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [(100 + i, [float(x) for x in r.integers(-3, 3, 2)]) for i in range(40)]
    rows += [(200, [0.5, -1e17]), (201, [3e15, 1.0]), (300, [1.0, 2.0, 3.0]), (301, [1.0, 0.0, 0.0]), (400, [])]
    bad = [(500, None), (501, [None, 1.0]), (502, [float("nan"), 1.0]), (600, [float("inf"), 1.0]), (None, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("vector", F.lit("x")).withColumn("shard", F.lit(1))
    vectors = vector_search.scaled(df)
    plain = {r["vec_id"]: r["vector"] for r in vectors.collect()}
    assert set(plain) == {i for i, _ in rows}
    small = {i: v for i, v in plain.items() if i not in (200, 201)}
    keep = vectors.filter(~F.col("vec_id").isin(200, 201))
    assert found(keep, 5) == plain_top(small, 5)
    assert vector_search.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_search_with_exactly_k_found_so_far():
    """Leaves whose good rows add up to k must not end the search by a score that is not the k-th."""
    leaf = vector_search.LEAF
    v = np.concatenate([np.full(leaf, -9.0), [100.0, 1.0, 2.0], np.full(leaf - 3, 0.0), [50.0, 40.0], np.full(leaf - 2, 0.0)])[:, None]
    for k in (2, 3, 4, 5):
        whole = vector_search.Tree(v).search(np.array([1.0]), np.arange(len(v)), -1, k, 1)
        assert whole == sorted(((int(s), i) for i, s in enumerate(v[:, 0])), key=lambda x: (-x[0], x[1]))[:k]
    r = np.random.default_rng(4)
    for _ in range(200):
        v = r.normal(0, 40, (3 * leaf, 2)).round()
        q = r.normal(0, 40, 2).round()
        scores = v @ q
        want = sorted(((int(s), i) for i, s in enumerate(scores)), key=lambda x: (-x[0], x[1]))[:10]
        assert vector_search.Tree(v).search(q, np.arange(len(v)), -1, 10, want[-1][0]) == want


def test_repeated_rows_are_queries_and_candidates_each(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "SHARD_ROWS", 8)
    r = np.random.default_rng(3)
    rows = [(i % 30 * 20, [float(x) for x in r.integers(-3, 3, 2)]) for i in range(60)]
    rows += [rows[0], rows[0], rows[5], rows[7]]
    vectors = vector_search.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = []
    for a, (q, v) in enumerate(rows):
        if q % 100 == 0:
            scores = sorted((-sum(int(1024 * x) * int(1024 * y) for x, y in zip(v, w)), i) for b, (i, w) in enumerate(rows) if b != a)
            want += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:10], 1)]
    assert found(vectors) == sorted(want)


def test_trees_prune(monkeypatch):
    monkeypatch.setattr(vector_search, "LEAF", 8)
    r = np.random.default_rng(2)
    v = np.concatenate([r.normal(5 * c, 1, (200, 3)) for c in range(-3, 4)]).round().astype(float)
    tree, seen = vector_search.Tree(v), []
    tree.leaves = [None if leaf is None else leaf for leaf in tree.leaves]
    whole = tree.search(np.array([1.0, 1.0, 1.0]), np.arange(len(v)), -1, 5, None)
    scores = v.sum(axis=1)
    assert whole == sorted(((int(s), i) for i, s in enumerate(scores)), key=lambda x: (-x[0], x[1]))[:5]
    for node in range(len(tree.leaves)):
        if tree.leaves[node] is not None:
            seen += list(tree.leaves[node])
            assert (v[tree.leaves[node]] >= tree.low[node]).all() and (v[tree.leaves[node]] <= tree.high[node]).all()
    assert sorted(seen) == list(range(len(v)))


def plain_phrases(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hits = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_phrases_equal_plain_search(spark, odd):
    for docs in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = licenses.scanned(docs).collect()
        texts = sorted((plain_phrases(r["text"]) for r in docs.collect()), key=str)
        assert sorted(((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows), key=str) == texts
        for r in rows:
            assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert licenses.scanned(odd.limit(0)).count() == 0


def longest_in(words, i, texts):
    """Length of the longest run ending at word i that stands in a text."""
    for n in range(i + 1, 0, -1):
        part = words[i - n + 1 : i + 1]
        if any(part == t[j : j + n] for t in texts for j in range(len(t) - n + 1)):
            return n
    return 0


def test_matching_statistics_equal_plain_search():
    r = np.random.default_rng(4)
    for _ in range(30):
        texts = [[bytes([97 + x]) for x in r.integers(0, 3, r.integers(1, 9))] for _ in range(4)]
        words = [bytes([97 + x]) for x in r.integers(0, 4, 40)]
        automaton = licenses.Automaton.of(texts, 2)
        stats = {i: (s, n) for i, s, n in automaton.statistics(words)}
        for i in range(len(words)):
            assert stats.get(i, (0, 0))[1] == longest_in(words, i, texts)
            here = {t for n, t in automaton.phrases[stats[i][0]] if n <= stats[i][1]} if i in stats else set()
            assert here == {t for t in range(2) if i + 1 >= len(texts[t]) and words[i + 1 - len(texts[t]) : i + 1] == texts[t]}


def test_notices_get_labels_and_spans(spark):
    notice = licenses.TEMPLATES[1][1]
    changed = notice.replace("you may not use", "nobody can use").replace("compliance", "line")
    texts = [f"word {notice} more", f"intro words {changed}", "Released under the MIT License.", "the license of the work", "licensed under nothing"]
    rows = licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["labels"] for r in rows[:3]] == ["apache-2.0", "apache-2.0", "mit"] and [r["labels"] for r in rows[3:]] == ["", ""]
    span = max(rows[0]["spans"], key=lambda s: s["end_word"])
    assert (span["first_word"], span["end_word"], span["cover"]) == (1, 1 + len(licenses.split(notice.encode())), 1.0)


def auc(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return float((good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean())


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op4_compression_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (rows["held_out"] == rows["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    out = rows[rows["held_out"]]
    assert auc(out["score"].to_numpy(), out["quality"].to_numpy()) > 0.97
    assert out[out["quality"] == 1]["predicted"].mean() > 0.97
    assert out[out["quality"] == 0]["predicted"].mean() < 0.2
    assert ((rows["score"] >= 0.3) == (rows["predicted"] == 1)).all()


def test_quality_of_odd_rows(spark, odd):
    labelled = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(["$$$ ###", "good text here"] * 20)] + [(99, None, 1), (98, "x", None)], "doc_id long, text string, label int")
    for model in (compression_quality.fitted(labelled), compression_quality.fitted(labelled.limit(0)), compression_quality.fitted(labelled.filter("label = 1"))):
        rows = compression_quality.scored(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert compression_quality.scored(odd.limit(0), model).count() == 0


def plain_article(page):
    """For the pages of the tables alone: what stands in the article element."""
    import html

    body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    if not body:
        return None
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*\Z", "", body[1]))
    texts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in parts]
    return "\n\n".join(filter(None, texts))


def test_articles_of_pages_not_learnt_from(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    model = html_blocks.fitted(pages.filter("page_id % 2 = 0"))
    rows = html_blocks.extracted(pages.filter("page_id % 2 = 1"), model).join(pages.select("page_id", "html"), "page_id").collect()
    wrong = [r["page_id"] for r in rows if plain_article(r["html"]) is not None and r["text"] != plain_article(r["html"])]
    assert len(wrong) <= 0.01 * len(rows), wrong[:10]


def test_furniture_of_other_sites_goes(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").limit(250).collect()]
    model = html_blocks.trained(pages[:180])
    right = total = 0
    for i, page in enumerate(pages[180:]):
        read = html_blocks.blocks(html_blocks.furnished(page, 1000 + i))
        (score,) = model.scores([html_blocks.vectors(read)])
        want = np.array([b.inside and not b.away for b in read])
        right += int(((score >= 0.5) == want).sum())
        total += len(read)
    assert right >= 0.99 * total


def test_lstm_gradients_equal_differences():
    r = np.random.default_rng(7)
    model = html_blocks.Labeller.fresh(5)
    x, mask = html_blocks.padded([r.normal(size=(n, 5)).astype(np.float32) for n in (2, 4)])
    x, y = x.astype(float), np.where(mask, r.integers(0, 2, mask.shape), 0).astype(float)

    def loss():
        p = model.forward(x, mask)[0]
        return -np.where(mask, y * np.log(p) + (1 - y) * np.log(1 - p), 0).sum() / mask.sum()

    for k, g in model.gradients(x, mask, y).items():
        for _ in range(3):
            at = tuple(r.integers(0, s) for s in g.shape)
            old = model.w[k][at]
            model.w[k][at] = old + 1e-5
            up = loss()
            model.w[k][at] = old - 1e-5
            down = loss()
            model.w[k][at] = old
            assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_odd_pages(spark):
    texts = [None, "", "plain words", "<p>a &am", "<article><p>x &lt;b&gt; &eacute;<br>y</p><script>if (a < b) {}</script><p>z", "<!-- only", "<p", "<div " * 50, "<article>" + "<p>w</p>" * 5000]
    rows = [(i, None, t) for i, t in enumerate(texts)] + [(1, "u", "")] * 2 + [(None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("blocks", F.lit("x"))
    model = html_blocks.trained(["<nav><a href='/'>home</a></nav><article><p>some text here.</p><p>more text.</p></article><footer>end</footer>"] * 10)
    out = html_blocks.extracted(pages, model).collect()
    assert len(out) == len(rows) and all(r["text"] is not None for r in out)
    assert {r["text"] for r in out if r["page_id"] in (0, 1, None)} == {""}
    read = html_blocks.blocks(texts[4])
    assert [b.text for b in read] == ["x <b> é y", "z"] and all(b.inside for b in read)
    assert html_blocks.extracted(pages.limit(0), model).count() == 0


def test_unspaced_comparisons_in_scripts_keep_the_page():
    code = "for(i=0;i<n;i++){f()}"
    for page in (
        f"<script>{code}</script><article><p>Main text</p></article>",
        f"<SCRIPT>{code}</Script ><article><p>Main text</p></article>",
        f"<style>/* a<b */</style><svg><script>{code}</script><style/></svg><article><p>Main text</p></article>",
        "<script><!-- if(a<b)</script><article><p>Main text</p></article><!-- end -->",
        f"<title>a<b</title><textarea>a<b</scripted></textarea><article><p>Main text</p></article><script>{code}",
    ):
        assert [(b.text, b.inside) for b in html_blocks.blocks(page)] == [("Main text", True)], page


def test_wrappers_named_like_furniture_keep_the_article(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").limit(250).collect()]
    model = html_blocks.trained(pages[:180])
    wrapped = (
        lambda p: p.replace("<body>", '<body class="single no-sidebar">', 1),
        lambda p: p.replace("<article>", '<div class="has-header"><article>', 1),
        lambda p: p.replace("<body>", '<body><div id="search-results"><div class="has-header with-sidebar">', 1),
        lambda p: p.replace("<article>", '<article class="post share">', 1),
    )
    for wrap in wrapped:
        for page in pages[180:200]:
            plain, read = html_blocks.blocks(page), html_blocks.blocks(wrap(page))
            assert [(b.text, b.inside, b.away) for b in read] == [(b.text, b.inside, b.away) for b in plain]
            (score,) = model.scores([html_blocks.vectors(read)])
            assert [s >= 0.5 for s in score] == [b.inside and not b.away for b in plain]


def test_furniture_stays_furniture_where_it_holds_articles():
    page = (
        '<body class="has-sidebar"><div class="main-menu">menu</div><main class="no-sidebar"><div class="has-comments"><article><header><h1>Title</h1></header><p>Long text of the article.</p>'
        '<section class="comments"><article class="comment"><p>A comment longer than the whole article it stands under.</p></article></section></article></div>'
        '<div class="related"><article><p>Teaser</p></article></div></main><aside><article><p>Also a teaser, and a long one, longer than the article.</p></article></aside>'
    )
    kept = [b.text for b in html_blocks.blocks(page) if b.inside and not b.away]
    assert kept == ["Title", "Long text of the article."]
    assert [b.away for b in html_blocks.blocks('<div class="main-menu">menu</div><p>text')] == [True, False]


@pytest.mark.parametrize(
    "page, want",
    [
        ('<svg class="icon"/><article><p>Main text</p></article>', ["Main text"]),
        ("<article><p title='it's'>Main text, don't lose it.</p><p>more</p></article>", ["Main text, don't lose it.", "more"]),
        ('<article><p title="5" wide">five</p></article>', ["five"]),
        ('<article><p title="a > b">six</p></article>', ["six"]),
        ("<form><select><option>one</form><article><p>after</p></article>", ["after"]),
        ("<object data=x><p>after</p>", ["after"]),
        ("<object data=x><p>instead</p></object><p>after</p>", ["after"]),
    ],
)
def test_markup_that_is_not_closed_or_quoted_well(page, want):
    assert [b.text for b in html_blocks.blocks(page)] == want


def test_pages_are_labelled_alike_in_any_company():
    r = np.random.default_rng(5)
    model = html_blocks.Labeller.fresh(6)
    pages = [r.normal(size=(n, 6)) for n in (3, 40, 0, 41, 900, 5)]
    for page, scores in zip(pages, model.scores(pages), strict=True):
        assert np.allclose(scores, model.scores([page])[0], atol=1e-6)
