import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesearch.llm import langid, templates

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows, **options):
    pages = spark.createDataFrame(rows, SCHEMA)
    return {(r.url, r.page_id): r.text for r in templates.extract(pages, "page_id, url", langid.host_of(F.col("url")), **options).collect()}


WRAPPED = '<html><body><nav><a href="/">Home</a></nav><div class="{0}"><article><header><h1>Head {1}</h1></header><p>Text of page {1}, the longest part of all that stands here.</p><p>Next {1}.</p></article></div><footer>Made by us</footer></body></html>'


@pytest.mark.parametrize("name", ["has-sidebar", "article-header-wide", "search-result-page", "related-none"])
def test_no_name_around_the_article_empties_a_page(spark, name):
    rows = [(i, "https://h.example.com/", WRAPPED.format(name, i)) for i in range(6)]
    rows.append((6, "https://h.example.com/", WRAPPED.format("plain", 6)))  # and a layout that few pages have
    found = texts(spark, rows)
    for i in range(7):
        assert found["https://h.example.com/", i] == f"Head {i}\n\nText of page {i}, the longest part of all that stands here.\n\nNext {i}."


def test_mathematics_in_an_article_is_text(spark):
    html = "<article><h1>H{0}</h1><p>Some longer text of the page {0} with words.</p><math><mi>x</mi>={0}</math></article>"
    found = texts(spark, [(i, "https://h.example.com/", html.format(i)) for i in range(4)])
    assert all(found["https://h.example.com/", i].endswith(f"\n\nx ={i}") or found["https://h.example.com/", i].endswith(f"\n\nx\n\n={i}") for i in range(4))


def test_names_are_a_prior_only(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.select("page_id", "url", "html").collect()]
    with_names, without = texts(spark, rows), texts(spark, rows, words=False)
    assert sum(with_names[k] == without[k] for k in with_names) >= 0.9 * len(with_names)
    assert all(with_names.values())


@pytest.mark.parametrize("pages", [1, 2, 3, 4])
def test_small_hosts_lean_on_all_others(spark, pages):
    """A small host's notice, which all hosts show to be one, is left out; no size of host changes the result."""
    html = '<html><body><div class="x"><div>Read our terms before use.</div></div><article><h1>Head {0}</h1><p>Text of page {0} on host {1}, with many words.</p></article></body></html>'
    rows = [(i, "https://big.example.com/", html.format(i, "big")) for i in range(8)] + [(i, "https://small.example.com/", html.format(i, "small")) for i in range(pages)]
    for (url, i), text in texts(spark, rows, words=False).items():
        assert text == f"Head {i}\n\nText of page {i} on host {'big' if 'big' in url else 'small'}, with many words."


def test_comments_do_not_outweigh_the_article(spark):
    html = '<html><body><div><h1>Head {0}</h1><p>Short text {0}.</p></div><div class="comments"><p>A reader says {0} at some length here.</p></div></body></html>'
    found = texts(spark, [(i, "https://h.example.com/", html.format(i)) for i in range(5)])
    assert all(found["https://h.example.com/", i] == f"Head {i}\n\nShort text {i}." for i in range(5))


def test_classes_match_brute_force(spark):
    """Tokens share a class exactly if their counts are equal on every page, also on repeated pages and those without id."""
    rng = np.random.default_rng(5)
    kinds = ["section", "figure", "table", "dl", "main", "address", "fieldset"]
    pages = []
    for i in range(30):
        counts = rng.integers(0, 3, len(kinds))
        counts[1] = counts[0]  # two that always agree
        counts[2] = 1 if i % 2 else counts[0]
        pages.append((str(i), "".join(f"<{k}></{k}>" * c for k, c in zip(kinds, counts))))
    pages += pages[:1] * 2 + [("", "<dl></dl>"), ("", "<dl></dl><main></main>")]
    frame = spark.createDataFrame([("h", *p) for p in pages], "host string, id string, html string").repartition(5)
    found = {r.token: r["class"] for r in templates.classes(templates._token_counts(frame)).where("host = 'h'").collect()}
    vectors = {}
    for token in found:
        vectors[token] = tuple(templates.Page(html).tokens.get(token, 0) for _, html in pages)
    assert len(found) > 4
    for a in found:
        for b in found:
            assert (found[a] == found[b]) == (vectors[a] == vectors[b])
    # An even number of equal pages does not cancel.
    even = spark.createDataFrame([("h", "1", "<dl></dl>")] * 2 + [("h", "2", "<dl></dl><main></main>")] * 2 + [("h", "3", "<dl></dl><main></main>")], "host string, id string, html string")
    of = {r.token: r["class"] for r in templates.classes(templates._token_counts(even)).where("host = 'h'").collect()}
    assert of["/dl"] != of["/main"]
