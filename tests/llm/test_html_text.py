import random

import pytest
from helpers import LONG

from ledgerline.llm import html_text as H

PROSE = "The quick fox and the dog were in the house of the man, and it was so that they had to be with him for the day. "


def test_page_without_article_uses_density_and_neighbours():
    html = (f"<body><nav>Home <a href=x>About</a></nav><div id=content><p>{PROSE * 3}</p><p>Short.</p><p>{PROSE * 3}</p></div>"
            f"<div class='sidebar'><p>{PROSE}</p></div><p><a href=y>more links here</a></p><div id='comments'><p>{PROSE * 4}</p></div>"
            f"<footer>{PROSE * 3}</footer>")
    assert H.main_text(html) == " ".join([PROSE * 3, "Short.", PROSE * 3]).replace("  ", " ").strip()


def test_article_keeps_short_blocks_and_drops_boilerplate():
    html = (f"<main><header class=site>Top</header><article><header><h1>Title</h1></header><p>x &lt;b&gt; y&nbsp;z &amp</p>"
            f"<aside>{PROSE * 3}</aside><form><p>{PROSE * 3}<input></form><p>One<br>two<b>three</b></p><div class='ad-box'>buy</div>"
            f"<p hidden>secret</p><section class=comments><article><p>{PROSE * 3}</p></article></section></article></main>")
    assert H.main_text(html) == "Title x <b> y z & One twothree"


def test_article_decides_only_if_it_holds_most_of_the_text():
    main = f"<div><p>{PROSE * 3}</p><p>{PROSE * 4}</p></div>"
    got = H.main_text(f"<body>{main}<article><p>Teaser of the day</p></article><footer>{PROSE}</footer>")
    assert (PROSE * 3).strip() in got and (PROSE * 4).strip() in got
    got = H.main_text(f"<body><article><p>{PROSE * 9}</p><p>End.</p></article><p>Shop now</p><div><p>{PROSE * 3}</p></div>")
    assert got == " ".join([(PROSE * 9).strip(), "End.", (PROSE * 3).strip()])


def test_long_blocks_without_listed_stop_words_are_kept():
    russian = "\u0411\u044b\u0441\u0442\u0440\u0430\u044f \u043b\u0438\u0441\u0430 \u0431\u0435\u0436\u0438\u0442 \u0447\u0435\u0440\u0435\u0437 \u043b\u0435\u0441. " * 9
    page = f"<body><nav><a href=x>a</a></nav><p>{russian}</p><blockquote>{PROSE * 2}</blockquote><p>{russian}</p><p>{russian}</p><footer>x</footer>"
    assert H.main_text(page).count(russian.strip()) == 3
    chinese = "\u5feb\u901f\u7684\u72d0\u72f8\u8df3\u8fc7\u61d2\u72d7\u3002" * 9
    assert H.main_text(f"<div><p>{chinese}</p><p>{chinese}</p></div>") == f"{chinese} {chinese}"
    code = "result = compute(alpha, beta); print(result); value += result ** 2; " * 3
    page = f"<body><p>{PROSE * 4}</p><p>{PROSE * 4}</p><pre>{code}</pre><pre>{code}</pre><footer>x</footer><footer>y</footer>"
    assert H.main_text(page).count(code.strip()) == 2


def test_cues_are_whole_names_and_not_heading_ids():
    page = (f"<div class='content-with-sidebar'><h2 id=related-work>Related work</h2><p>{PROSE * 3}</p>"
            f"<div class='left-sidebar'>{PROSE * 3}</div><div class='site-footer x'>{PROSE * 3}</div><div id=commentList>{PROSE * 3}</div></div>")
    assert H.main_text(page) == "Related work " + (PROSE * 3).strip()


def test_broken_markup():
    assert H.main_text('<p>abc <a href="x>foo</a> <b') == "abc foo"
    assert H.main_text("plain text & more < 3") == "plain text & more < 3"
    assert H.main_text("<article><p>one<script>var x='<p>'") == "one"
    assert H.main_text("<!-- open") == "" and H.main_text(None) == "" and H.main_text("") == ""
    assert H.main_text("<title>t</title><article>a<style>p{}</style>b</article>") == "ab"


def test_rows_pass_through(spark):
    rows = [(1, "u", "<article><p>One  two</p></article>"), (1, "u", "<article><p>One  two</p></article>"), (2, None, None),
            (None, "v", ""), (3, "w", f"<article><p>{LONG}</p></article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "One two", 7)] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", LONG.strip(), len(LONG) - 1)], key=str)
    assert H.extract(pages.limit(0)).count() == 0


def test_template_pages_equal_their_article(spark):
    """The article of the test pages, cut by their known template."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search("<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1)>|<br>", article))
        want[r.page_id] = " ".join(filter(None, parts))
    assert {r.page_id: r.text for r in H.extract(pages).collect()} == want


PARAGRAPH = "The council has decided that it will not change the rules for the market in the old town before the end of the year, and that the " \
            "people who live there are to be asked what they would like to see in its place when the work on the river is done. "


@pytest.mark.parametrize("mark, kept", [
    ('id="comment-on-policy"', True), ('class="cookie-recipes"', True), ('class="sponsorship-history"', True), ('id="consent-of-the-governed"', True),
    ('id="commentary"', True), ('class="comment"', False), ('class="comments-list"', False), ('id="comment-12"', False), ('class="CommentThread"', False),
    ('class="cookie-banner"', False), ('id="cookieConsent"', False), ('class="sponsored"', False), ('class="advertisement-box"', False),
    ('class="side-bar"', False), ('role="comment"', False)])
def test_cues_are_whole_words(mark, kept):
    page = f"<html><body><article><p>{PARAGRAPH}</p><div {mark}><p>Marked. {PARAGRAPH}</p></div></article></body></html>"
    assert ("Marked." in H.main_text(page)) == kept


def test_pages_without_article_by_density_and_neighbours():
    """Brute force of what such a page's text is: its paragraphs and heading, none of its menus, notices and comments."""
    rng = random.Random(3)
    words = "the of and in to is that was for on with as his they be at one have this from".split()
    for k in range(40):
        prose = lambda n: " ".join(rng.choice(words) if rng.random() < 0.5 else f"word{rng.randrange(500)}" for _ in range(n)).capitalize() + "."
        body = [("h1", f"Title number {k} of the day")] + [("p", prose(rng.randrange(60, 120))) for _ in range(rng.randrange(2, 6))]
        links = "".join(f'<li><a href="/{i}">Entry {i}</a></li>' for i in range(rng.randrange(3, 20)))
        junk = f'<ul>{links}</ul><div class="cookie-banner"><p>{prose(70)}</p></div>'
        after = f'<div id="comments"><div class="comment"><p>{prose(80)}</p></div></div><footer><p>{prose(50)}</p></footer>'
        page = f"<html><head><title>x</title></head><body>{junk}<div>" + "".join(f"<{t}>{x}</{t}>\n" for t, x in body) + f"</div>{after}</body></html>"
        assert H.main_text(page) == " ".join(x for _, x in body)
