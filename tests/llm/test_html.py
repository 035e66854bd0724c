import time

import pytest

from shopgrain.llm.html import extract_text, main_text

LONG = "A long paragraph with enough words in it that the window of lines surges over the bar."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("plain &amp; text\n only", "plain & text only"),
        ("<p>a<p>b", "a\nb"),
        ("<ul><li>one<li>two</ul>", "one\ntwo"),
        ("<article><header><h1>T</h1></header><p>x<script>if(a<b)'</p>'</script> y</p><form>q</form></article><p>z</p>", "T\nx y"),
        ('<article><p>a</p><section class="comments"><p>no</p></section></article>', "a"),
        ('<article><p>a <span class="ad">buy</span> b<br>c</p><!-- d --></article>', "a b c"),
        (f'<div id=nav><a href=x>Home</a></div><p>{LONG}<p>Short.<footer>f</footer>', f"{LONG}\nShort."),
        (f"<aside>{LONG}</aside><nav>{LONG}</nav><p>{LONG}</p>", LONG),
        ("<main><table><tr><td>1<td>2</table></main>", "1\n2"),
        ("<p>unclosed <a href='x", "unclosed"),
        ("<article><p>&#20320;&eacute;&nbsp;x</p></article>", "你é x"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_text_far_from_the_surge_is_left():
    page = "<p>x</p>" + "<nav>m</nav>" * 8 + f"<p>{LONG * 20}</p><p>end</p>" + "<nav>m</nav>" * 8 + "<p>y</p>"
    assert main_text(page) == f"{LONG * 20}\nend"


BODY = [f"{n}. {LONG}" for n in range(12)]
UNMARKED = "<div>" + "".join(f"<p>{x}</p>" for x in BODY) + "</div>"


@pytest.mark.parametrize(
    "small, text",
    [
        ('<h1 class="entry-title">The title</h1>', "The title"),
        ('<div class="post-meta">By A. Writer</div>', "By A. Writer"),
        ("<article><h2>A teaser</h2><p>It is short.</p></article>", "A teaser\nIt is short."),
        ('<div class="story-teaser"><p>One more story.</p></div>', "One more story."),
    ],
)
def test_a_mark_on_a_small_part_doesnt_hide_the_body(small, text):
    body = "\n".join(BODY)
    assert main_text(small + UNMARKED) == f"{text}\n{body}"
    assert body in main_text(UNMARKED + small)
    assert body in main_text(small * 3 + UNMARKED + small * 3)


def test_dense_text_outside_a_believed_mark_is_kept():
    page = "<h1>Title</h1><article>" + UNMARKED * 2 + f"</article><div><p>{LONG * 4}</p></div>" + "<nav>m</nav>" * 4 + "<p>stray</p>"
    assert main_text(page) == "\n".join(["Title", *BODY, *BODY, LONG * 4])


@pytest.mark.parametrize(
    "part, text",
    [
        (f'<section id="discussion"><h2>Discussion</h2><p>{LONG}</p></section>', f"Discussion\n{LONG}"),
        (f'<h2 id="related-work">Related work</h2><p>{LONG}</p>', f"Related work\n{LONG}"),
        (f'<section id="legal-framework"><p>{LONG}</p></section>', LONG),
        (f'<h2 class="section-header">Methods</h2><p>{LONG}</p>', f"Methods\n{LONG}"),
        (f'<h1 class="page-header">Title</h1><p>{LONG}</p>', f"Title\n{LONG}"),
        (f'<div class="elementor-widget"><p>{LONG}</p></div>', LONG),
        (f'<div class="widget legal"><p>{LONG}</p><p>{LONG * 3}</p></div>', f"{LONG}\n{LONG * 3}"),
        (f'<div class="notice"><p>{LONG}</p></div>', ""),
        ('<div class="post comments"><p>no</p></div>', ""),
        ('<div role="search"><p>no</p></div>', ""),
        ('<div class="share"><a href="x">Share</a></div>', ""),
    ],
)
@pytest.mark.parametrize("opening, closing", [("<article>", "</article>"), ('<div class="post-content">', "</div>")])
def test_words_of_boilerplate_inside_an_article(opening, closing, part, text):
    page = f"{opening}<p>{BODY[0]}</p>{part}{closing}"
    assert main_text(page) == "\n".join(x for x in (BODY[0], text) if x)


def test_ids_of_headings_mark_nothing():
    assert main_text(f'<div><h2 id="related-work">Related work</h2><p>{LONG}</p></div>') == f"Related work\n{LONG}"


PROSE = "<p>" + "</p><p>".join(BODY) + "</p>"


@pytest.mark.parametrize("name", ["with-sidebar", "layout sidebar-right", "social-science", "content sidebar-left", "no-footer", "hasSidebar"])
def test_a_layout_name_around_the_page_loses_nothing(name):
    body = "\n".join(BODY)
    assert main_text(f'<div class="{name}">{PROSE}</div>') == body
    page = f'<nav>m</nav><div class="{name}">{PROSE}<div class="sidebar"><p>{LONG}</p></div></div><div class="site-footer"><p>{LONG}</p></div>'
    assert main_text(page) == body
    assert main_text(f'<div class="{name}"><article>{PROSE}</article><div id="comments">{PROSE * 3}</div></div>') == body


@pytest.mark.parametrize(
    "named",
    [
        'id="comments"', 'class="comments-section"', 'class="comment-list"', 'class="cookie-banner"', 'class="newsletter-signup"',
        'class="ad-slot"', 'class="site-footer"', 'id="sidebar"', 'class="notice"', 'class="related"', 'class="relatedPosts"', 'id="post-comments"',
    ],
)
@pytest.mark.parametrize("element", ["div", "section"])
@pytest.mark.parametrize("opening, closing", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ("<div>", "</div>")])
def test_boilerplate_told_by_its_name_goes_even_if_it_is_dense(named, element, opening, closing):
    part = f"<{element} {named}><h3>More</h3><p>{LONG}</p><p>{LONG * 3}</p></{element}>"
    body = "\n".join(BODY)
    assert main_text(f"{opening}{PROSE}{part}{closing}") == body
    assert main_text(f"{opening}{part}{PROSE}{closing}") == body
    assert main_text(f"{part}{opening}{PROSE}{closing}{part}") == body


def test_more_comments_than_article():
    assert main_text(f'<article><p>{LONG}</p></article><div class="comment-list">{PROSE * 20}</div>') == LONG
    assert main_text(f'<div><p>{LONG}</p><section class="comments">{PROSE * 20}</section></div>') == LONG


@pytest.mark.parametrize(
    "page, chars",
    [
        ("<article><p>x</p>" + "<b><i>t</b>" * 60_000 + "</article>", 60_001),
        ("<div>" + "<b>t" * 60_000 + "<p>x</p>" * 20_000 + "</div>", None),
        ("<p>" + "<b>" * 60_000 + "</p></i>" * 60_000 + "end", None),
        ("<div class='comments'>" * 20_000 + "<p>x</p>", None),
        ("<p>" + "long text " * 500_000 + "</p>", 4_999_999),
    ],
)
def test_very_long_pages_take_time_in_proportion(page, chars):
    started = time.monotonic()
    found = main_text(page)
    assert time.monotonic() - started < 20
    assert chars is None or len(found.replace("\n", "")) == chars


def test_table(spark):
    rows = [(1, "u", "<p>a</p>", "k"), (1, "u", "<p>a</p>", "k"), (None, None, None, "k"), (2, "u", "<p>😀b</p>" * 3000, "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = extract_text(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in found) == [(0, 0), (1, 1), (1, 1), (2, 8999)]
    assert extract_text(pages.limit(0)).collect() == []
