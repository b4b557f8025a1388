"""The trained operators: held-out accuracy and planted pages."""

import html
import re

import numpy as np

from tapelake.llm import boosting, html_extract, quality_gam, queries

SF = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    import zlib

    scored = {r["doc_id"]: r for r in queries.QUERIES["op1_quality_gam"](spark, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for d, r in scored.items())
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in scored.values())
    out = [(scored[d]["score"], q) for d, q in labels.items() if scored[d]["held_out"]]
    good, bad = [s for s, q in out if q == 1], [s for s, q in out if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([(s >= 0.7) == q for s, q in out]) > 0.9


def test_pairs_are_learnt():
    random = np.random.default_rng(0)
    x = random.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (2, 0) in model.pairs
    test = random.random((2000, 4))
    assert np.mean((model.logit(test) > 0) == ((test[:, 0] > 0.5) ^ (test[:, 2] > 0.5))) > 0.95


def test_boosted_trees():
    random = np.random.default_rng(0)
    x = random.random((3000, 3))
    y = (x[:, 0] * x[:, 1] > 0.25).astype(float)
    assert np.mean((boosting.fit_boosted(x, y).logit(x) > 0) == y) > 0.97


def test_pages_of_the_table(spark):
    got = {r["page_id"]: r["text"] for r in queries.QUERIES["op10_html_extract"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:h1|p)>", article)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


PAGE = """<!doctype html><title>no</title><body class="home"><div id="top-nav"><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></div>
<div class="cookie-notice">We use cookies. <button>OK</button></div><form action=/s><input name=q> Search here</form>
<div class="wrap"><div class="post-body"><h1>The  title</h1><p>First &eacute; paragraph of the text, with a <b>bold</b> word and some more words. It goes on.
<p>Second<br>one, after the first was not closed, and it is long enough too. It has an end.<script>var x = "<p>no</p>";</script><!-- <p>no -->
<div class="ad-slot">Buy this now!</div><p>Yes.</p></div>
<div class="comments"><p>I liked this article very much, thank you for writing it. Best wishes.</p></div></div>
<aside class="sidebar"><p>Related: another story that you may like to read.</p></aside><div class="site-footer">&copy; nobody</div></body>"""


def test_a_page_without_article_element(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html_extract.fit(pages)
    page = spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string")
    assert html_extract.extract(page, model).first()["text"].split("\n") == [
        "The title",
        "First é paragraph of the text, with a bold word and some more words. It goes on.",
        "Second one, after the first was not closed, and it is long enough too. It has an end.",
        "Yes.",
    ]


def test_large_pages_are_read_like_ordinary_ones(spark):
    model = html_extract.fit(spark.read.parquet(f"{SF}/pages.parquet"))
    links = "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(300))
    body = "".join(f"<h2>Part {i}</h2><p>Here is a sentence of part {i}, long enough to be read. It has an end.</p>" for i in range(200))
    page = '<body><div class="x1"><b>Menu</b><ul>{}</ul><p>All items</p></div><div class="wrap"><div><h1>The title</h1>{}</div><div>{}</div></div></body>'
    small, large = (page.format(links, body, "<div></div>" * n) for n in (1200, 1400))
    a, b = (html_extract.read(x) for x in (small, large))
    assert len(a.nodes) < 2000 < len(b.nodes)
    place = html_extract.features(b).shape[1] - len(html_extract._SHAPE) + html_extract._SHAPE.index("alike")
    children = [b.nodes[max(x.parent, 0)].children for x in b.nodes]
    want = [sum(b.nodes[c].tag == x.tag for c in own) / max(len(own), 1) for x, own in zip(b.nodes, children, strict=True)]
    assert np.allclose(html_extract.features(b)[:, place], want)
    rows = spark.createDataFrame([(1, "u", small), (2, "u", large)], "page_id long, url string, html string")
    first, second = (r["text"] for r in html_extract.extract(rows, model).orderBy("page_id").collect())
    assert first == second and first.count("sentence of part") == 200
