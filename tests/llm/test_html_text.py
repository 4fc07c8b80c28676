import html
import re

import pyarrow.parquet as pq
import pytest

from tallywatch.llm import html_text, queries
from tests.llm.edges import clashing

PAGES = {
    "classes": (
        '<body class="has-sidebar"><div id="page"><div class="site-header"><a href=/>My site</a>'
        "<span>a line of words</span></div><div class=entry-content><p>Short.</p><p>The main "
        "text &amp; more\n of   it.</p><p>Ok&nbsp;</p></div><div class=sidebar><p>Popular things "
        "with many words of text and no link</p></div><div id=comments><p>I do not agree at all"
        "</p></div><div class=site-footer>(c) me</div></div>",
        "Short. The main text & more of it. Ok",
    ),
    "semantic": (
        "<header><nav><a>x</a></nav></header><main><article><header><h1>Title</h1></header>"
        "<p>One <b>t</b>wo.</p><aside><p>By the way</p></aside><p>Three</p></article></main>"
        "<section class=comments-area><article><p>my comment on this</p></article></section>",
        "Title One two. Three",
    ),
    "unnamed": (
        "<ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul><div><p>A tiny.</p><p>"
        + "word " * 80 + "</p><p>" + "more " * 50 + "</p></div>",
        ("word " * 80 + "more " * 50).strip(),
    ),
    "scripts": (
        '<script>var t="</p>";</script><style>p{}</style><article><p title="a > b">Text'
        "<!-- gone --><br>here</p><noscript>no</noscript><form><p>Your name</p></form></article>",
        "Text here",
    ),
    "cut": ("<nav>Menu</nav><article><p>cut off &am", "cut off &am"),
    "notices": (
        '<div id="cookie-banner">We use cookies</div><div class="advert">Buy now</div>'
        '<article><p>x</p></article><div role="alert"><p>Closed on Monday</p></div>',
        "x",
    ),
    "state": (
        '<ul class=menu><li><a href=x>one</a></li></ul><div class="article has-comments"><p>A tiny.</p>'
        "<p>Some more</p></div><div class=comments><p>No, I think</p></div>",
        "A tiny. Some more",
    ),
    "id of a share button": (
        '<div class=sidebar><p>Popular</p></div><div id="post-share-123" class="post entry"><p>'
        + "word " * 60 + "</p><p>End.</p></div><div class=post-share><p>Tell your friends</p></div>",
        ("word " * 60 + "End.").strip(),
    ),
    "form in a name": (
        "<nav><a href=x>x</a></nav><div class=content-form-wide><p>" + "word " * 60 + "</p><p>"
        + "more " * 50 + "</p></div><div class=content-form-small><p>Your name</p></div>",
        ("word " * 60 + "more " * 50).strip(),
    ),
    "unspaced": (
        "<ul><li><a href=x>一覧</a></li><li><a href=y>連絡</a></li></ul><div><p>" + "昨日は雨が降った。" * 25
        + "</p><p>" + "今日は晴れている。" * 20 + "</p></div><div class=footer><p>著作権</p></div>",
        "昨日は雨が降った。" * 25 + " " + "今日は晴れている。" * 20,
    ),
    "comments by other names": (
        "<main><p>One two.</p></main><div class=post-comments><p>" + "word " * 60 + "</p></div>"
        "<div id=comment-content-7><p>" + "more " * 60 + "</p></div>",
        "One two.",
    ),
    "null": (None, ""),
    "empty": ("", ""),
    "tag": ("<p", ""),
}


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [(i, name, page) for i, (name, (page, _)) in enumerate(PAGES.items())]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = html_text.extract(clashing(df, "text", "n_chars", "block", "label")).collect()
    return {r.url: r for r in out}


@pytest.mark.parametrize("name", PAGES)
def test_pages(extracted, name):
    assert extracted[name].text == PAGES[name][1]
    assert extracted[name].n_chars == len(PAGES[name][1])


def test_held_out_layouts():
    """Accuracy over pages put together from the pieces in other ways than in training."""
    import random

    from tallywatch.llm import html_labels

    real, random.Random = random.Random, lambda seed: real(seed + 1)
    html_labels.random.Random = random.Random
    try:
        pages = html_labels.labelled_pages(120)
    finally:
        html_labels.random.Random = real
    tree = html_text.trained()
    right = total = 0
    for page in pages:
        found = html_text.blocks(page)
        share = tree.predict(html_text.features(found))
        right += sum((s >= 0.5) == bool(b.label) for b, s in zip(found, share))
        total += len(found)
    assert right / total > 0.98


def test_very_long_page():
    page = "<article>" + "<p>a b</p>" * 20_000 + "</article>" + "<" * 10_000
    tree = html_text.trained()
    found = html_text.blocks(page)
    assert len(found) >= 20_000 and (tree.predict(html_text.features(found)) >= 0.5).sum() >= 20_000


def test_all_pages_give_their_article(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{sf}/pages.parquet").to_pylist()}
    rows = queries.op7_html_text(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)[1]
        spaced = re.sub(r"</?(p|h1)>|<br>", " ", article)
        plain = re.sub(r"<[^>]*(>|\Z)", "", spaced)
        assert r.text == " ".join(html.unescape(plain).split())


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, html string")
    assert html_text.extract(none).count() == 0
