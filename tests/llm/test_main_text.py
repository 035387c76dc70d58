"""Main text: pages of known articles, the given pages, and broken markup."""

import html
import re
import time

import pytest

from barline.llm.common import table
from barline.llm.main_text import extract_main_text, main_text
from barline.llm.queries import op12_html_extraction
from tests.conftest import SF_MID

LONG = "This paragraph, which is part of the article, says something of some length, and it goes on for a while."
ARTICLE = ["A heading", LONG, "Short one.", "A second paragraph, with a link in it, and a comma.", "Item one", "Item two", "Last words, at last."]
BODY = (f"<h1>A heading</h1><p>{LONG}</p><p>Short one.</p><p>A second paragraph, with a <a href=/x>link in it</a>, and a comma.</p>"
        "<ul><li>Item one<li>Item two</ul><p>Last words, at last.</p>")
NOISE = "Our notice text, which is long, has commas, and goes on and on, just as an article would, for some lines. " * 3
NAV = "<nav><ul>" + "".join(f"<li><a href='/{k}'>Menu {k}</a></li>" for k in range(8)) + "</ul></nav>"
HEAD = "<!DOCTYPE html><html><head><meta charset=utf-8><title>A heading | Site</title><style>p{margin:0}</style><script>var t='</p><p>x';</script></head>"
COMMENTS = "".join(f"<div class=comment><p>Comment {k}, by a reader, who writes a lot, really a lot, of words here. {LONG}</p></div>" for k in range(9))

LAYOUTS = {
    "semantic": f"{HEAD}<body><header><h2>Site</h2><p>{LONG}</p></header>{NAV}<article>{BODY}</article><aside><p>{NOISE}</p></aside>"
                f"<footer><p>{NOISE}</p></footer></body></html>",
    "divs by name": f"{HEAD}<body class='has-sidebar'><div id=header>Site, the site.</div><div class='top-menu'>{NOISE}</div><div class=content-with-sidebar>{BODY}</div>"
                    f"<div id=sidebar><p>{NOISE}</p></div><div class='cookie-notice'><p>{NOISE}</p></div><div id=footer><p>{NOISE}</p></div></body>",
    "divs without names": f"{HEAD}<body><div><a href=/>Home</a> | <a href=/a>About, and more</a> | <a href=/b>Terms, and others</a></div><div><div>{BODY}</div></div>"
                          "<div><a href=/1>See also this, and that, and all the rest of it</a><br><a href=/2>And one more</a></div></body>",
    "reader comments": f"{HEAD}<body><main><article>{BODY}</article><section id=comments><h2>Comments</h2>{COMMENTS}"
                       f"<article class=comment><p>{NOISE}</p></article></section></main></body>",
    "comments in the article": f"{HEAD}<body><article class='post comments-open'>{BODY}<div id='post-comments'>{COMMENTS}</div></article></body>",
    "adverts inside": f"{HEAD}<body><article>{BODY.replace('<p>Short', f'<div class=ad><p>{NOISE}</p></div><!-- <p>old</p> --><p>Short')}"
                      f"<form action=/s><label>Your mail</label><input value=v><button>Send</button><select><option>One<option>Two</select></form>"
                      f"<div class='newsletter-signup'><p>{NOISE}</p></div><p hidden>{NOISE}</p><div style='display: none'>{NOISE}</div></article></body>",
    "page in a form": f"{HEAD}<body><form method=post>{NAV}<div class=main>{BODY}</div><input type=submit></form></body>",
    "table": f"{HEAD}<body><table><tr><td width=100><a href=/a>One</a><br><a href=/b>Two</a><td>{BODY}</table></body>",
    "article header": f"{HEAD}<body><article><header><h1>A heading</h1><p class=meta>Mon, by A.</p></header>{BODY[18:]}<footer>Tags: a, b</footer></article></body>",
    "unclosed": "<title>t</title><body><div id=nav><a href=/>x</a></div><article>" + BODY.replace("</p>", "").replace("<p>", "<p><b>", 1),
    "roles": f"<div role=banner>{NOISE}</div><div role=main>{BODY}</div><div role='complementary'><p>{NOISE}</p></div><div role=contentinfo><p>{NOISE}</p></div>",
    "sections": "<body><div><div><h1>A heading</h1>" + f"<p>{LONG}</p></div><div><p>Short one.</p>" + BODY[BODY.index("<p>A second"):] + "</div></div></body>",
    "upper case": f"<HTML><BODY><NAV><A HREF=/>Menu</A></NAV><ARTICLE>{BODY.replace('<p>', '<P CLASS=x>').replace('</p>', '</P >')}</ARTICLE></BODY></HTML>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert main_text(LAYOUTS[name]).split("\n\n") == ARTICLE


def test_references_and_white_space():
    page = "<article><p>a &amp; b &lt;i&gt; &eacute;&#233;&#xe9; &nbsp; c\n\t d<br>e<b>f</b>g &unknown; &am</p><p> \n </p><p>AT&T &copy 2020, 1 < 2</p></article>"
    assert main_text(page) == "a & b <i> ééé c d efg &unknown; &am\n\nAT&T © 2020, 1 < 2"


def test_broken_markup():
    assert main_text(None) == main_text("") == main_text("<html><head><title>x</title>") == main_text("<!-- never ended <p>x</p>") == ""
    assert main_text("<nav><a href=/>Menu</a></nav><div class=ad>Buy, buy, buy.</div><artic") == ""
    assert main_text("<nav><a href=/>Menu</a></nav><div class=ad>Buy, buy.</div><article><h1>Head") == "Head"
    assert main_text("<article><p>one, two</p><p title='a > b'>three</p><p class=\"x>four</p></article") == "one, two\n\nthree\n\nfour"
    assert main_text("just text, no tags") == "just text, no tags"
    assert main_text("<article><script>if (a<b) document.write('<p>x</p>')</SCRIPT ><p>kept</p><svg/><p>too</p><style>p{}") == "kept\n\ntoo"
    assert main_text("<article><pre># head\n<span class=comment># x</span></pre><p>in <span class=ad>Buy</span> line</p></article>") == "# head # x\n\nin line"


def test_deep_and_long_pages_take_linear_time():
    t = time.time()
    deep = "<div>" * 20_000 + "<p>deep, deeper</p>" + "</div>" * 20_000
    assert main_text(f"<nav>menu</nav>{deep}") == "deep, deeper"
    words = ", ".join(f"w{k}" for k in range(300_000))
    assert main_text(f"<article><p>{words}</p></article>") == words
    many = main_text("<article>" + "<p><b>x, y<br>" * 60_000 + "</article>")
    assert many.count("x, y") == 60_000 and main_text("<" * 200_000 + "<p>" * 50_000 + "\"'<a b='" * 20_000) is not None
    assert time.time() - t < 30


def template_article(page):
    """The article of the given pages, whose layout is fixed, by another way."""
    m = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    body = re.sub(r"<[^>]*\Z", "", m[1]) if m else ""
    parts = [" ".join(html.unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(x for x in parts if x)


def test_registered_query_on_the_whole_table(spark):
    pages = table(spark, SF_MID, "pages").collect()
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in op12_html_extraction(spark, SF_MID).collect()}
    assert got == {(r.page_id, r.url): (t := template_article(r.html), len(t)) for r in pages}


def test_awkward_rows(spark):
    rows = [(1, None, None, "t"), (None, "u", "<p>x, y</p>", "t"), (2, "u", "", None), (2, "u", "<p>same</p>", ""), (2, "u", "<p>same</p>", ""), (3, "u", "\U0001d518 é", "n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    got = sorted((tuple(r) for r in extract_main_text(df).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (None, "u", "x, y", 4), (2, "u", "", 0), (2, "u", "same", 4), (2, "u", "same", 4), (3, "u", "\U0001d518 é", 3)], key=repr)
    assert extract_main_text(df.filter("false")).collect() == []
