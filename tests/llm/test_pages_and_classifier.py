"""Page differencing and the attention classifier."""

import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerscope.llm import page_diff, quality_classifier
from ledgerscope.llm.html_blocks import blocks


def _lcs(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n[i + 1][j + 1] = n[i][j] + 1 if x == y else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


def test_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(1500):
        a, b = ([r.randrange(4) for _ in range(r.randrange(12))] for _ in range(2))
        got = page_diff.common_lines(a, b)
        left = iter(b)
        assert len(got) == _lcs(a, b) and got == sorted(set(got)) and all(a[i] in left for i in got)


def test_many_equal_lines_are_aligned_by_bits(monkeypatch):
    r = random.Random(2)
    for most in (1 << 28, 40):  # whole, and halved
        monkeypatch.setattr(page_diff, "_BITS", most)
        for _ in range(400):
            a, b = ([r.randrange(3) for _ in range(r.randrange(30))] for _ in range(2))
            got = page_diff._by_bits(a, b)
            left = iter(b)
            assert len(got) == _lcs(a, b) and got == sorted(set(got)) and all(a[i] in left for i in got)
    monkeypatch.undo()
    a, b = ([r.randrange(5) for _ in range(8_000)] for _ in range(2))
    began = time.time()
    assert len(page_diff.common_lines(a, b)) > 4_000 and time.time() - began < 5


@pytest.mark.parametrize("page", ["<span>" * 100_000 + "</b>" * 100_000, '<a "' * 250_000, "<header><main>" + "<div>x" * 160_000, '<a ">' * 200_001])
def test_pages_of_a_megabyte_take_seconds(page):
    began = time.time()
    blocks(page)
    assert time.time() - began < 10  # minutes, were any of these quadratic


def test_blocks_of_a_messy_page():
    page = '<html><head><title>T</title></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><a>x</a></nav><main><article><header><h1>Title &amp; b</h1><p>by me</p></header><p>One<br>two &lt;3 <b>bold<p>next</p><div class="ad">AD</div><ul><li>i1<li>i2</ul><table><tr><td>a<td>b</table><script>if(a<b){"</p>"}</script>tail<!-- no --></article></main><section id="comments"><p>c</p></section><footer>f</body>'
    assert [b.text for b in blocks(page) if b.content and not b.furniture] == ["Title & b", "One two <3 bold", "next", "i1", "i2", "a b", "tail"]
    assert blocks("") == [] and blocks("just text & more <") and blocks("<<<>>><p") is not None
    assert [b.text for b in blocks("<p>a" * 300)] == ["a"] * 300


def test_wrappers_named_like_furniture_keep_their_article():
    def text(page):
        return page_diff.main_text(blocks(page), set())

    for wrap in ("<div id='page' class='right-sidebar'>{}</div>", "<div class='layout-sidebar-left'><main>{}</main></div>", "<div class='elementor-widget elementor-widget-text'>{}</div>", "<div class='comments-open'>{}</div>"):
        for inner in ("<article class='post comments-open social'><p>a</p><div class='ad'>AD</div><p>b</p></article>", "<div itemprop='articleBody' class='share'><p>a</p><p>b</p></div>", "<span role='main'>a<p>b</span>"):
            assert text("<body><div class='menu'>m</div>" + wrap.format(inner) + "<footer>f</footer></body>") == "a\n\nb"
    assert text("<body><title>t</title><div class='right-sidebar'><p>a</p><nav>n</nav><p>b</p></div>") == "a\n\nb"
    article = "<article><p>a</p></article>"
    for other in ("<ol class='comment-list'><li><article class='x'>c</article></ol>", "<article class='comment'>c</article>", "<div class='related'><article>c</article></div>", "<aside><article>c</article></aside>", "<div hidden><article>c</article></div>"):
        assert text(f"<div class='right-sidebar'>{article}{other}</div>") == "a"


def _page(body):
    return f"<html><body><div>Site name</div>{body}<div>All our boxes</div></body></html>"


def test_template_lines_go_and_articles_stay(spark):
    rows = [
        (1, "http://h.org/a/1", _page("<p>first story</p>")),
        (2, "http://h.org/a/2?x=1", _page("<p>second story</p><p>more of it</p>")),
        (3, "http://h.org/a/2#top", _page("<p>second story</p><p>more of it</p>")),  # one path: never a pair
        (4, "http://other.org/a/1", _page("<p>alone on its host</p>")),
        (5, "http://copy.org/x/1", "<article><p>shared passage</p><p>one</p><p>Subscribe to our newsletter</p></article>"),
        (6, "http://copy.org/x/2", "<article><p>shared passage</p><p>two</p><p>Subscribe to our newsletter</p></article>"),
        (7, None, None), (8, None, ""), (9, "http://[bad", "<p>kept</p>"), (None, "http://h.org/a/1", _page("<p>first story</p>")),
        (1, "http://h.org/a/1", _page("<p>first story</p>")), (10, "http://long.org/", "<p>" + "word " * 40_000),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, path string")
    got = page_diff.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert text[1] == text[None] == "first story" and text[2] == text[3] == "second story\n\nmore of it"
    assert text[4] == "Site name\n\nalone on its host\n\nAll our boxes"
    assert text[5] == "shared passage\n\none" and text[6] == "shared passage\n\ntwo"
    assert text[7] == text[8] == "" and text[9] == "kept" and len(text[10]) == 40_000 * 5 - 1
    assert page_diff.extract(df.limit(0)).count() == 0


def test_articles_keep_shared_lines_that_hold_a_notice_word():
    lines = ["Bake the cookies for ten minutes.", "All rights reserved.", "Read more books, he said.", "Sign up"]
    copy = blocks("<article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article>")
    assert page_diff.main_text(copy, set(range(4))) == "\n\n".join(lines)  # a copy keeps even a notice
    other = blocks("<article>" + "".join(f"<p>{x}</p>" for x in [*lines, "a", "b", "c"]) + "</article>")
    assert page_diff.main_text(other, set(range(4))) == "\n\n".join([*lines[:3], "a", "b", "c"])  # the notice alone goes


def test_empty_rows_and_null_addresses_are_paired_as_well(spark):
    rows = [
        (1, "http://h.org/a/1", _page("<p>first</p>")), (2, "http://h.org/a/1", None), (3, "http://h.org/a/1?x", ""),
        (4, "http://h.org/a/2", _page("<p>second</p>")), (5, "http://h.org/a/2", ""),
        (6, None, _page("<p>no address</p>")), (7, "/b", _page("<p>no host</p>")),
    ]
    text = {r.page_id: r.text for r in page_diff.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert text == {1: "first", 2: "", 3: "", 4: "second", 5: "", 6: "no address", 7: "no host"}


def test_pages_of_the_table_give_their_article(spark, sf):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in page_diff.op3_page_differencing(spark, sf).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        want = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", x))).strip() for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(x for x in want if x)


def test_attention_learns_from_document_labels():
    """A bag is bad if one passage holds the bad word: only attention can find it."""
    r = random.Random(7)
    some = [f"w{i}" for i in range(40)]
    texts, labels = [], []
    for i in range(500):
        words = [r.choice(some) for _ in range(64 * r.randrange(2, 6))]
        if i % 2:
            at = 64 * r.randrange(len(words) // 64)
            words[at : at + 20] = ["$$$"] * 20
        texts.append(" ".join(words))
        labels.append(1 - i % 2)
    x, off = quality_classifier.encode_passages(pa.array(texts))
    bags = [x[a:b] for a, b in zip(off, off[1:], strict=False)]
    m = quality_classifier.fit(bags[:400], np.array(labels[:400], np.float32))
    p = quality_classifier.score_texts(m, pa.array(texts[400:]))
    assert ((p >= 0.5) == np.array(labels[400:], bool)).mean() > 0.97
    assert (m["W"] == quality_classifier.fit(bags[:400], np.array(labels[:400], np.float32))["W"]).all()


def test_classifier_edges(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (3, None, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train(odd_docs, labels)
    got = quality_classifier.scored(odd_docs, model, score_col="own").collect()
    assert len(got) == odd_docs.count() and all(0 <= r.own <= 1 for r in got)
    assert quality_classifier.accepted(odd_docs, labels).columns == odd_docs.columns
    assert quality_classifier.train(odd_docs, labels.limit(0)) == {"share": 0.5}
    assert quality_classifier.train(odd_docs, labels.filter("quality = 1")) == {"share": 1.0}
    assert quality_classifier.scored(no_docs, model, score_col="own").count() == 0
    assert quality_classifier.train(no_docs, labels) == {"share": 0.5}


def test_training_takes_a_row_an_id_and_whole_texts_within_its_bounds(spark):
    many = spark.range(5_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("copy number "), (F.col("id") % 50).cast("string")).alias("text"))
    long = spark.range(1).select(F.lit(3).cast("long").alias("doc_id"), F.repeat(F.lit("word "), 5_000_000).alias("text"))
    few = spark.range(10, 60).select(F.col("id").alias("doc_id"), F.lit("a few words of text").alias("text"))
    docs = many.unionByName(long).unionByName(few)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    sizes = {r.id: r.n for r in quality_classifier.training_rows(docs, labels).select("id", F.length("text").alias("n")).collect()}
    folds = {i for i in [1, 3, *range(10, 60)] if zlib.crc32(str(i).encode()) % 4 != 2}
    assert sizes.keys() == folds and sizes[3] == 25_000_000  # whole: its 78,125 passages fit
    below = quality_classifier.training_rows(docs, labels, max_passages=78_000)
    assert {r.id for r in below.select("id").collect()} == folds - {3}
    three = quality_classifier.training_rows(docs, labels, max_train=3)
    bags, y = quality_classifier.training_bags(three)
    assert len(bags) == len(y) == 3
    tight = quality_classifier.training_rows(docs, labels, max_passages=7)
    assert tight.count() == 7


def test_classifier_held_out_accuracy(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    got = quality_classifier.op10_quality_mil(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9
