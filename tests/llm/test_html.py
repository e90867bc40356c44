import itertools
import random
import re
import time
from html import unescape

from roamrank.llm import html_mincut, queries

PAGE = """<html><body class="has-sidebar"><header class="site"><h1>Site</h1><a href=x>Home</a></header>
<div id="cookie-notice"><p>We use cookies on this long site, and we want you to accept them all now.</p></div>
<div class="layout-sidebar"><main><article><h1>Title   here</h1><p>First para, with words &amp; more words in it.</p>
<div class="ad">Buy now, this is a long text. It is an advert with many words.</div><p>Second&nbsp;one<br>more.
<a href=x>A link</a></p><ul><li>one<li>two</ul><aside>Related: some long text here, and more of it.</aside>
<form><label>Mail</label><input></form></article></main>
<div class="sidebar"><p>Popular posts, here are a lot of words for you to read.</p></div></div>
<section id="comments"><article class="comment"><p>I like this, great post indeed my friend.</p></article></section>
<script>if (a<b) document.write("<p>no</p>")</script><footer><p>&copy; 2020</p></footer></body></html>"""


def article(html):
    """Text of the generated pages, which mark their article plainly."""
    inside = html[html.index("<article>") + 9 : html.index("</article>")]
    inside = re.sub(r"</?b>", "", inside).replace("<br>", " ")
    parts = re.split(r"</?(?:p|h1)>", inside)
    return "\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)


def test_query_against_the_marked_article(spark):
    sf_dir = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op2_html(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == article(pages[r["page_id"]])
        assert r["n_chars"] == len(r["text"])


def test_parts_that_are_not_the_article():
    assert html_mincut.main_text(PAGE) == (
        "Title here\nFirst para, with words & more words in it.\nSecond one more. A link\none\ntwo"
    )


def test_a_page_without_marks():
    page = """<div><a href=a>Home</a> <a href=b>News</a></div><div><h2>Headline of it</h2><p>A long paragraph, with many
    words in it, so that it is surely content.</p><p>Short one.</p><p>Another long paragraph with many words in it,
    content and nothing else.</p></div><div><a href=a>Imprint</a> <a href=b>Contact</a></div>"""
    lines = html_mincut.main_text(page).split("\n")
    assert [x.split()[0] for x in lines] == ["Headline", "A", "Short", "Another"]


def test_cut_is_the_cheapest_labelling():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 8)
        source = [rng.choice([0, rng.random() * 3]) for _ in range(n)]
        sink = [rng.choice([0, rng.random() * 3]) for _ in range(n)]
        edges = [(i, j, rng.random()) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(side):
            own = sum(b if s else a for s, a, b in zip(side, source, sink))
            return own + sum(w for i, j, w in edges if side[i] != side[j])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(html_mincut.max_flow_side(n, source, sink, edges)) - best) < 1e-6


def test_awkward_pages(spark):
    rows = [
        (1, "u", None, "x"),
        (2, None, "", "x"),
        (None, "u", "<p>Only this.</p>", "x"),
        (3, "u", "<nav><a href=a>Menu</a></nav>", "x"),
        (3, "u", PAGE, "x"),
        (3, "u", PAGE, "x"),
        (4, "u", "<article><p>" + "A word, and one more. " * 20_000, "x"),
        (5, "u", "a < b <", "x"),
        (6, "u", "<!-- never closed", "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = html_mincut.extract(pages).collect()
    texts = [r["text"] for r in sorted(found, key=lambda r: (r["page_id"] is None, r["page_id"], r["text"]))]
    assert texts[:3] == ["", "", ""] and texts[3] == texts[4] and texts[3].startswith("Title here")
    assert len(texts[5]) == 20_000 * 22 - 1 and texts[7] == "" and texts[8] == "Only this."
    assert html_mincut.extract(pages.limit(0)).count() == 0


def test_hard_pages_take_linear_time():
    start = time.perf_counter()
    for page in ("<div>" * 20_000 + "x", "<p>word, word. <b>" * 20_000, '<a "' * 20_000, "<li>x <a href=1>y</a>" * 20_000):
        html_mincut.main_text(page)
    assert time.perf_counter() - start < 30


def test_quotes_within_tags():
    """A tag ends at the first sign outside its quoted values, whatever other quotes they hold."""
    last = "First sentence. We don't stop here."
    for tag in (
        """<img src="d.jpg" alt="It's a dog">""",
        """<img alt='He said "no'>""",
        """<img alt="a > b, it's" title='"'>""",
        "<img alt=it's>",
        """<img ' alt="x">""",
        """<img alt="x"title='y'/>""",
        """<img alt = "it's">""",
        """<img alt=>""",
    ):
        page = f"<p>{tag}{last}</p><p>Last one here.</p>"
        assert html_mincut.Page(page).texts == [last, "Last one here."], tag
    assert html_mincut.Page('<p title="never closed>Kept</p><p>And this</p>').texts == ["Kept", "And this"]
    assert html_mincut.Page("<p>Kept</p><img alt='a>b' src").texts == ["Kept"]


def test_open_quotes_take_linear_time():
    start = time.perf_counter()
    for piece in (""" b="<a b='>'\"""", """<a b=">' c='""", """<a b='" c=">"""):
        html_mincut.Page("<a" + piece * 40_000 + ' b="')
    assert time.perf_counter() - start < 20


LONG = "A paragraph of the article, with many words in it, so that it is surely content."


def test_names_do_not_veto_the_article():
    text = f"<h1>Headline</h1><p>{LONG}</p><p>And {LONG}</p>"
    other = "<nav><a href=a>Home</a></nav><footer><p>Imprint, and some words more.</p></footer>"
    want = f"Headline\n{LONG}\nAnd {LONG}"
    for wrapper in (
        'article class="post category-social"',
        'article class="promo"',
        'main class="has-comments"',
        'main id="comments"',
        'div id="page" class="with-related"',
        'div class="social"',
        'div class="content no-sidebar"',
        'div class="sidebar"',
        'section title="A hidden gem" data-id="ads"',
    ):
        inner = text.replace("h1", "h2") if "sidebar" in wrapper else text
        assert html_mincut.main_text(f"{other}<{wrapper}>{inner}</{wrapper.split()[0]}>{other}") == want, wrapper
    assert html_mincut.main_text(f'<div class="with-related"><main>{text}</main></div>{other}') == want


def test_names_still_count():
    """Parts named so are left out, beside a marked article even if they are longer than it."""
    article = f"<article><p>{LONG}</p></article>"
    for name in ("comments", "post-comments", "related-posts", "shareButtons", "ad-1", "newsletter signup", "cookie-notice"):
        assert html_mincut.main_text(f'{article}<div class="{name}"><p>{LONG}</p><p>{LONG}</p></div>') == LONG, name
    assert html_mincut.main_text(f'<div><p>{LONG}</p><p>{LONG}</p></div><div id="comments"><p>{LONG}</p></div>') == f"{LONG}\n{LONG}"


def test_the_text_outweighs_a_name():
    """A long block within an article's part of such a name is content, as no name settles it alone."""
    text = f"<h1>Headline</h1><p>{LONG}</p>"
    page = f'<article>{text}<div class="share"><p>Share it</p></div><div class="promo"><p>{(LONG + " ") * 40}</p></div></article>'
    assert html_mincut.main_text(page) == f"Headline\n{LONG}\n" + " ".join([LONG] * 40)


def test_formulas_are_text():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2 in TeX</annotation></semantics></math>"
    page = f"<article><p>Let {formula} hold, as it is said above.</p><p>{LONG}</p></article>"
    assert html_mincut.main_text(page) == f"Let x=2 hold, as it is said above.\n{LONG}"


def test_what_is_not_shown_as_text():
    """Closed elements are skipped with those within, in the middle of a sentence too."""
    for part in (
        "<svg><title>Icon</title><a href=x><text>Mark</text></a></svg>",
        "<svg><g><svg><text>inner</text></svg><text>outer</text></g></svg>",
        "<svg/>",
        "<noscript>Switch on scripts. <b>Now</b></noscript>",
        "<template><p>A row, and more of it.</p><p>Another</p></template>",
        "<noscript>Now <template>x<p>A row</template> then<p>off</noscript>",
    ):
        page = html_mincut.Page(f"<article><p>Press {part}here, and go on.</p><p>{LONG}</p></article>")
        assert page.texts == ["Press here, and go on.", LONG] and page.linked == [0, 0], part
    page = html_mincut.Page("<div>Size <select><option>S<option>M</select><p>Text.</p></div>")
    assert page.texts == ["Size", "Text."]


def test_elements_left_open_lose_nothing():
    rest = f"<p>{LONG}</p><p>And {LONG}</p></article><footer><p>Imprint, and some words more.</p></footer>"
    for tag in ("svg", "math", "noscript", "template", "select", "svg><path d='M0'", "annotation"):
        page = f"<article><p>{LONG}</p><{tag}>{rest}"
        assert html_mincut.main_text(page) == f"{LONG}\n{LONG}\nAnd {LONG}", tag
        assert html_mincut.main_text(f"<p>{LONG}</p><div><{tag}></div><p>And {LONG}</p>") == f"{LONG}\nAnd {LONG}", tag
    assert html_mincut.Page(f"<p>{LONG}</p><script>x<p>{LONG}</p>").texts == [LONG]


def test_unshown_elements_take_linear_time():
    start = time.perf_counter()
    for page in (
        "<p>x<template>" * 20_000,
        "<p><template>" + "<div>x" * 20_000,
        "<svg>x" * 20_000 + "</svg>" * 20_000,
        "<p>x<noscript><p>y</noscript>" * 20_000,
        "x<noscript><p>y</noscript>" * 40_000,
    ):
        html_mincut.Page(page)
    assert time.perf_counter() - start < 20


def test_no_tag_vetoes_what_the_article_lies_in():
    """Forms around a page, and heads and navigations that are left open."""
    article = f"<article><h1>Headline</h1><p>{LONG}</p><p>And {LONG}</p></article>"
    plain = f"<div><h1>Headline</h1><p>{LONG}</p><p>And {LONG}</p></div>"
    nav, footer = "<nav><a href=a>Home</a> <a href=b>News</a></nav>", "<footer><p>Imprint, and some words more.</p></footer>"
    want = f"Headline\n{LONG}\nAnd {LONG}"
    for body in (f"{nav}{article}{footer}", f"{nav}{plain}{footer}"):
        alone = html_mincut.main_text(body)
        assert f"{LONG}\nAnd {LONG}" in alone
        for before, after in (
            ("<html><head><title>T</title><meta charset=utf-8><body>", "</body></html>"),
            ("<head><title>T</title><style>p {}</style>", ""),
            ("<body><form id=aspnetForm action=x>", "</form></body>"),
            ("<fieldset>", "</fieldset>"),
            ("<form><fieldset>", "</fieldset></form>"),
            ("<dialog open>", "</dialog>"),
        ):
            assert html_mincut.main_text(f"{before}{body}{after}") == alone, before
    for before in ("<nav><a href=a>Home</a> <a href=b>News</a>", "<aside><p>Read this too.</p>", "<footer><a href=a>Top</a>"):
        assert html_mincut.main_text(f"{before}{article}{footer}") == want, before
    assert html_mincut.main_text(f"<head><title>T</title>{LONG}<p>And {LONG}</p>") == f"{LONG}\nAnd {LONG}"


def test_tags_still_veto_their_own_text():
    teaser = "<article><h3>Other</h3><p>A teaser, and some words of it.</p></article>"
    for tag in ("aside", "nav", "footer", "form", "fieldset"):
        part = f"<{tag}><p>{LONG}</p></{tag}>"
        assert html_mincut.main_text(f"<article><p>{LONG}</p>{part}<p>And {LONG}</p></article>") == f"{LONG}\nAnd {LONG}", tag
        assert html_mincut.main_text(f"<article><p>{LONG}</p></article>{part}") == LONG, tag
    assert html_mincut.main_text(f"<div><p>{LONG}</p><p>And {LONG}</p></div><aside>{teaser}</aside>") == f"{LONG}\nAnd {LONG}"
