"""Main text of pages: the extractor on many layouts, and its query against the texts that the pages were made from."""

import html
import re
import time

import pytest

from msgflow.llm.html import boilerplate, densities, main_text, parse, sizes, with_main_text
from msgflow.llm.queries import QUERIES


TITLE = "A river and its bridges"
FIRST = "The river rises in the hills north of the town and runs for two hundred miles before it meets the sea."
SECOND = "Nine bridges cross it, the oldest of which was built by masons who had come down from the quarries."
THIRD = "In spring the water stands so high that boats can not pass below the arches, and traffic waits for days."
AD = "Buy two pairs of shoes today and get the third pair free of charge, only in our shop and only this week!"
ARTICLE = "\n\n".join((TITLE, FIRST, SECOND, THIRD))
BODY = f"<p>{FIRST}</p><p>{SECOND}</p><p>{THIRD}</p>"
MENU = '<ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li></ul>'
COMMENT = "I crossed the old one last summer with my children and we liked it very much, thank you for the story!"

LAYOUTS = {
    "article": f"<nav>{MENU}</nav><article><h1>{TITLE}</h1>{BODY}</article><footer>All rights reserved.</footer>",
    "main": f"<header><h1>The Daily</h1>{MENU}</header><main><h1>{TITLE}</h1>{BODY}</main><aside>{AD}</aside>",
    "plain divisions": f'<div id="menu">{MENU}</div><div id="text"><h1>{TITLE}</h1>{BODY}</div><div class="footer">Imprint</div>',
    "unlabelled menu": f"<div>{MENU}</div><div><h1>{TITLE}</h1>{BODY}</div><div><a href='/i'>Imprint</a></div>",
    "title outside": f'<div class="wrap"><h1>{TITLE}</h1><div class="text">{BODY}</div><div class="ads">{AD}</div></div>',
    "sections": f"<div><h1>{TITLE}</h1><section><p>{FIRST}</p><p>{SECOND}</p></section><section><p>{THIRD}</p></section></div><div>{MENU}</div>",
    "no containers": f"<h1>{TITLE}</h1>{BODY}",
    "own header": f'<article><header><h1>{TITLE}</h1><p class="by">By A. Writer</p></header>{BODY}<footer>Filed under: rivers</footer></article>',
    "header class": f'<div class="post"><div class="post-header"><h1>{TITLE}</h1><span>3 May</span></div>{BODY}</div>',
    "advert within": f'<article><h1>{TITLE}</h1><p>{FIRST}</p><div class="ad-slot">{AD}</div><p>{SECOND}</p><p>{THIRD}</p></article>',
    "comments class": f'<article><h1>{TITLE}</h1>{BODY}<section class="comments"><p>{COMMENT}</p><p>{COMMENT}</p></section></article>',
    "comments id": f'<div><h1>{TITLE}</h1>{BODY}</div><div id="comments"><ol><li>{COMMENT}</li><li>{COMMENT}</li></ol></div>',
    "comments heading": f"<article><h1>{TITLE}</h1>{BODY}<section><h2>3 Comments</h2><p>{COMMENT}</p></section></article>",
    "comments as articles": f"<article><h1>{TITLE}</h1>{BODY}<article><p>{COMMENT}</p></article></article>",
    "comment articles": f'<article><h1>{TITLE}</h1>{BODY}</article><article class="comment"><p>{COMMENT}</p></article>',
    "comments as articles without an article": f'<div><h1>{TITLE}</h1>{BODY}</div><section class="comments"><article><p>{COMMENT}</p></article></section>',
    "announced comments as articles": f"<div><h1>{TITLE}</h1>{BODY}</div><section><h2>Comments (2)</h2><article><p>{COMMENT}</p></article></section>",
    "responses": f'<main><h1>{TITLE}</h1>{BODY}<div id="reader-responses"><p>{COMMENT}</p></div></main>',
    "cookie notice": f'<div class="cookie-notice"><p>{AD}</p><button>Accept</button></div><article><h1>{TITLE}</h1>{BODY}</article>',
    "alert": f'<div role="alert">{AD}</div><main><h1>{TITLE}</h1>{BODY}</main>',
    "hidden": f'<div hidden>{AD}</div><div style="display: none">{AD}</div><main><h1>{TITLE}</h1>{BODY}</main>',
    "form": f"<article><h1>{TITLE}</h1>{BODY}<form>Your name <input><select><option>Mr<option>Ms</select></form></article>",
    "form around all": f"<form><div><h1>{TITLE}</h1>{BODY}</div></form>",
    "state classes": f'<div class="page has-sidebar comments-open sidebar-left"><main><h1>{TITLE}</h1>{BODY}</main></div>',
    "labelled wrapper": f'<div class="widget"><article><h1>{TITLE}</h1>{BODY}</article></div>',
    "related": f'<main><h1>{TITLE}</h1>{BODY}<div class="related"><h2>More</h2>{MENU}</div></main>',
    "scripts": f'<article><h1>{TITLE}</h1><script>var t = "</p><p>no";</script><style>p{{}}</style>{BODY}<noscript>{AD}</noscript></article>',
    "table of layout": f"<table><tr><td>{MENU}</td><td><h1>{TITLE}</h1>{BODY}</td></tr></table>",
    "unclosed": f"<nav><ul><li><a href=/>Home<li><a href=/n>News</ul></nav><article><h1>{TITLE}</h1><p><b>{FIRST}<br><p>{SECOND}<p>{THIRD}</article>",
    "cut off": f"<article><h1>{TITLE}</h1><p>{FIRST}</p><p>{SECOND}</p><p>{THIRD}<a hre",
    "no end tags": f"<body><article><h1>{TITLE}</h1><p>{FIRST}<p>{SECOND}<p>{THIRD}",
    "capitals": f"<BODY><NAV>{MENU}</NAV><ARTICLE CLASS=x><H1>{TITLE}</H1>{BODY}</ARTICLE></BODY>",
    "odd attributes": f"""<article title="a > b" data-x='</article>' =y><h1>{TITLE}</h1><p title=it's>{FIRST}</p><p>{SECOND}</p><p>{THIRD}</p></article>""",
    "remarks": f"<!-- <article>{AD}</article> --><article><h1>{TITLE}</h1><!-->{BODY}<!-- x --!><!-- never ends <p>{AD}</p>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page = f"<!DOCTYPE html><html><head><title>{TITLE} | The Daily</title></head><body>{LAYOUTS[name]}</body></html>"
    assert main_text(LAYOUTS[name]) == ARTICLE
    if name not in ("cut off", "remarks"):
        assert main_text(page) == ARTICLE


def test_short_articles_next_to_long_adverts():
    page = f'<nav>{MENU}</nav><div class="ad">{AD}</div><article><h1>Rain.</h1><p><b>Rain.<br></article><footer>{AD}</footer>'
    assert main_text(page) == "Rain.\n\nRain."


def test_references_and_white_space():
    page = "<article><p>a&amp;b &lt;i&gt; &copy;x &am; &amp &#65;&#x42; caf&eacute;\n\t d&nbsp;&nbsp;e</p><ul><li>one<li>two</ul><pre>x\n  y</pre></article>"
    assert main_text(page) == "a&b <i> ©x &am; & AB café d e\n\none\n\ntwo\n\nx y"
    assert main_text(f"<p>&#{'9' * 6000}; &#{'0' * 6000}65; &#xD800; &#0;</p>") == "� A � �"
    assert main_text("<p>a <b>bold</b> <a href=x>link</a> and<br>more<p>1 < 2 and 3 > 2</p>") == "a bold link and more\n\n1 < 2 and 3 > 2"
    assert main_text("<article><table><tr><td>a<td>b<tr><th>c</table></article>") == "a b\n\nc"


def test_pages_without_an_article():
    for page in (None, "", " \n", "<nav>Home</nav>", "<script>x</script>", "<title>never ends", f'<div class="ad">{AD}</div>', "<!--", "</", "<a"):
        assert main_text(page) == "", page
    assert main_text("plain text") == "plain text"


def test_densities_follow_their_definition():
    """Characters per tag, lowered by links, against the formula written out per node over the subtrees."""
    import math

    page = parse(f"<div>{MENU}<p>See <a href=x>here</a> and <b>there</b>.</p></div>{BODY}")
    cut, silent, explicit = boilerplate(page)
    size = sizes(page, silent, explicit)
    density, sums = densities(page, cut, size)

    def below(i, j):
        while j > i:
            j = page.nodes[j].parent
        return j == i

    def linked(j):
        while j > 0 and page.nodes[j].name != "a":
            j = page.nodes[j].parent
        return j > 0

    def count(text):
        return len("".join(text.split()))

    total = sum(count(t) for _, _, t in page.texts)
    total_links = sum(count(t) for j, _, t in page.texts if linked(j))
    for i in range(1, len(page.nodes)):
        c = sum(count(t) for j, _, t in page.texts if below(i, j))
        lc = sum(count(t) for j, _, t in page.texts if below(i, j) and linked(j))
        t = sum(j != i and below(i, j) for j in range(1, len(page.nodes)))
        lt = sum(j != i and below(i, j) and page.nodes[j].name == "a" for j in range(1, len(page.nodes)))
        base = math.log(c / max(1, c - lc) * max(1, lc) + total_links / total * c + math.e)
        want = c / max(1, t) * math.log(max(1, c / max(1, lc) * max(1, t) / max(1, lt)), base)
        assert density[i] == pytest.approx(want)
        children = [density[j] for j in range(len(page.nodes)) if page.nodes[j].parent == i]
        assert sums[i] == pytest.approx(sum(children) if children else density[i])


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "<p>deep</p>",
        "<b><p>" * 50_000 + "deep",
        "<a href='" * 100_000 + "deep",
        "<" * 300_000 + "deep",
        "<!-- " * 100_000 + "deep",
        "&#" * 200_000 + "deep",
        "</div>" * 100_000 + "deep",
        "<table><tr><td>" * 30_000 + "deep",
        "<script>" + "</scrip" * 100_000 + "deep",
    ],
    ids=lambda page: page[:8],
)
def test_hostile_pages_take_linear_time(page):
    began = time.time()
    main_text(page)
    assert time.time() - began < 10


def test_very_long_pages():
    page = "<article>" + f"<p>{FIRST}</p>" * 20_000 + "</article>"
    assert main_text(page) == "\n\n".join([FIRST] * 20_000)


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", LAYOUTS["article"], "x"), (1, "u", LAYOUTS["article"], "x"), (None, None, None, None), (2, "v", "", "y")],
        "page_id long, url string, html string, TEXT string",
    )
    rows = with_main_text(pages).select("page_id", "url", "text", "n_chars").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(1, "u", ARTICLE, len(ARTICLE))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str
    )
    assert with_main_text(pages.where("false")).collect() == []


def test_query(spark, sf_dir):
    rows = QUERIES["op12_html_density"](spark, sf_dir).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages) and set(rows[0].asDict()) == {"page_id", "url", "text", "n_chars"}
    for row in rows:
        page = pages[row["page_id"]]
        parts = re.split(r"</?p>|</?h1>", re.search(r"<article>(.*?)</article>", page["html"], re.S)[1])
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", part)).split()) for part in parts)
        assert row["text"] == "\n\n".join(block for block in blocks if block)
        assert (row["url"], row["n_chars"]) == (page["url"], len(row["text"]))
