import re
import tracemalloc
from html import unescape

import pytest

from lapsekit.llm import html_text as H

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p><p>x</p>";</script></head><body>
<header class="top"><h1>Site</h1></header><nav><a href=x>Menu</a></nav><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>The   headline</h1></header><p>First &amp; long paragraph of the article, with words enough.
<p>Second<br>paragraph, also <b>bold</b> of some length to be content.</p><p>Short.</p>
<div class="ad">Buy now</div><form><input value=x>Your mail</form><p>Last paragraph &copy; with an unclosed tag.
</article></main><aside>Side text</aside><section id="comments"><p>A reader's comment that is quite long, too, really.</p>
</section><footer>Foot</footer></body></html>"""


def test_article_without_the_rest():
    assert H.main_text(PAGE) == "\n\n".join([
        "The headline", "First & long paragraph of the article, with words enough.",
        "Second paragraph, also bold of some length to be content.", "Short.",
        "Last paragraph © with an unclosed tag."])


def test_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumnRenamed("url", "text")
    rows = {r["page_id"]: r["html"] for r in pages.collect()}

    def plain(x):
        body = x[x.index("<article>") + 9:].split("</article>")[0].split("<footer>")[0]
        blocks = [unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))) for b in re.split("</?(?:p|h1)>", body)]
        return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)

    out = H.extract(pages)
    assert out.columns == ["page_id", "text"]
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert got == {k: plain(v) for k, v in rows.items()}


def test_edges(spark):
    odd = [None, "", "   ", "<p>", "plain text", "<p>one<p>two", "</p></div>x", "<div><div><div>", "&am", "<a", "<!-- x",
           "<p>" + "word " * 200_000, "<nav>only a menu</nav>", "<b>" * 3000 + "deep", "<script>var x"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(odd)], "page_id long, html string")
    got = {r["page_id"]: r["text"] for r in H.extract(df).collect()}
    assert [got[k] for k in (0, 1, 2, 3, 4, 5, 6, 12)] == ["", "", "", "", "plain text", "one\n\ntwo", "x", ""]
    assert got[11] == ("word " * 200_000).strip() and got[13] == "deep"
    assert H.extract(df.limit(0)).collect() == []


def test_smoothing_and_threshold():
    import numpy as np
    lines = [("x" * n, 1, (), False) for n in (5, 5, 200, 210, 5)]
    r = H.smoothed_ratios(lines)
    assert r[2] > r[1] > r[0]
    assert 5 < H.threshold(np.array([5.0, 6.0, 100.0, 110.0])) < 100


LONG = "A paragraph of the article that is long enough to be content by its ratio of text to tags. " * 3


def test_whole_article():
    body = f"<div><p>{LONG}</p><p>{LONG}</p></div>"
    menu = "<div><a href=a>Home</a> <a href=b>News</a></div>"
    words = " ".join(LONG.split())
    for page, first in (
            (f"{menu}<article><h1>Title</h1><p>Standfirst.</p>{body}</article>", ["Title", "Standfirst."]),
            (f"{menu}<main><h1>Title</h1><article>{body}</article></main>", ["Title"]),
            (f"{menu}<div><h1>Title</h1>{body}</div>", ["Title"])):
        assert H.main_text(f"<html><body>{page}</body></html>").split("\n\n") == [*first, words, words]
    for inner in ("section", "blockquote"):
        page = f"<article><{inner}>{f'<p>{LONG}</p>' * 14}</{inner}><section><p>{LONG}</p></section></article>"
        assert H.main_text(f"<body>{menu}{page}</body>").split("\n\n") == [words] * 15
    page = f"<div><section>{f'<p>{LONG}</p>' * 14}</section><section><p>{LONG}</p></section></div>"
    assert H.main_text(f"<body>{menu}{page}</body>").split("\n\n") == [words] * 15


def test_wrappers_with_boilerplate_words():
    words = " ".join(LONG.split())
    article = f"<article><h1>Title</h1><p>{LONG}</p><div class='ad'>Buy</div><p>{LONG}</p></article>"
    comments = f"<section id=comments><article><p>{LONG}</p></article></section><div class=sidebar><p>Side</p></div>"
    for wrapper in ("layout no-sidebar", "content has-sidebar", "post with-comments", "page-with-banner", "layout sidebar", "search"):
        page = f"<body><div class='{wrapper}'>{article}</div>{comments}</body>"
        assert H.main_text(page).split("\n\n") == ["Title", words, words], wrapper
        page = f"<body><div id='{wrapper}'>{article.replace('article>', 'div>')}</div><div class=sidebar><p>Side</p></div></body>"
        assert H.main_text(page).split("\n\n") == ["Title", words, words], wrapper
    page = f"<body><article><p>{LONG}</p></article><div class=comments>{f'<p>{LONG}</p>' * 9}</div></body>"
    assert H.main_text(page) == words


SENTENCES = [f"Sentence number {i} of the article says something of a usual length about the matter." for i in range(30)]


def test_a_form_around_the_whole_page_is_no_form_to_fill_in():
    body = "".join(f"<p>{s}</p>" for s in SENTENCES)
    want = "\n\n".join(["T", *SENTENCES])
    for inside in (f"<article><h1>T</h1>{body}</article>", f"<main><h1>T</h1>{body}</main>"):
        page = f"<body><nav>Menu</nav><form id='aspnetForm' action='x'>{inside}<select><option>A</option></select></form><footer>F</footer></body>"
        assert H.main_text(page) == want
    assert H.main_text(f"<article><h1>T</h1>{body}<form><p>Leave your mail here</p><input></form></article>") == want


def test_a_marked_block_that_is_the_article_stays():
    body = "".join(f"<p>{s}</p>" for s in SENTENCES)
    for word in ("legal", "notice", "related", "overlay", "widget", "share"):
        assert H.main_text(f"<article><h1>T</h1><div class='{word}'>{body}</div><p>The end.</p></article>") == \
            "\n\n".join(["T", *SENTENCES, "The end."])
        assert H.main_text(f"<article><h1>T</h1>{body}<div class='{word}'><p>Other things to read.</p></div></article>") == \
            "\n\n".join(["T", *SENTENCES])


def test_comments_go_however_long_they_are():
    article = "".join(f"<p>{s}</p>" for s in SENTENCES[:5])
    comments = "".join(f"<p>Reader: {s} {s}</p>" for s in SENTENCES)
    for mark in ("class='comments'", "id='disqus'", "class='user-replies'"):
        assert H.main_text(f"<article><h1>T</h1>{article}<section {mark}>{comments}</section></article>") == \
            "\n\n".join(["T", *SENTENCES[:5]])


@pytest.mark.parametrize("unit", ["<div>", "<article>", "<form>", "<div class='ad'>", "<p><span>", "<div>x</b>"])
def test_very_deep_pages(unit):
    tracemalloc.start()
    text = H.main_text(unit * 20_000 + "plain words of the page " * 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert text.endswith("plain words of the page") and peak < 60e6
