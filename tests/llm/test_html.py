"""Main text of pages."""

import html
import re

from claimtide.llm import html_text, queries
from claimtide.llm.html_text import main_text

SMALL = "/root/testdata/sf0.001"


def by_markup(page):
    """The article of the test pages, cut out by their own markup."""
    inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.DOTALL)[1]
    inner = re.sub(r"</?(p|h1)>", "\0", inner.replace("<br>", " "))
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in inner.split("\0"))
    return "\n\n".join(b for b in blocks if b)


def test_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = queries.queries()["op1_html_text"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row.text == by_markup(pages[row.page_id].html)
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


PARAGRAPH = "Some sentences of the story, with a <a href='/x'>link</a> and more words. " * 4


def test_boilerplate_goes():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
      <header><a href="/">Home</a> Site</header><div id="main-menu"><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>
      <div class="cookie-notice"><p>We use cookies.</p></div><div class="SideBar"><p>{'aside ' * 60}</p></div>
      <div class=content><h1>Title &amp; more</h1><p>{PARAGRAPH}<p>Second. Short.<ul><li>a point</li></ul>
      <form><input><button>Send</button></form><div class="ad-box">Buy now</div><script>var a = "<p>no</p>";</script></div>
      <section id="comments"><article class="comment"><p>{'I agree with this. ' * 40}</p></article></section>
      <footer>Copyright</footer></body></html>"""
    text = main_text(page)
    assert text.startswith("Title & more\n\nSome sentences of the story, with a link and more words.")
    assert text.endswith("Second. Short.\n\na point")


def test_sections_of_one_article():
    page = "<body><div><div>" + "".join(f"<section><h2>Part {k}</h2><p>{PARAGRAPH}</p></section>" for k in range(3)) + \
        "</div></div><div>" + "".join(f"<a href={k}>Link {k}</a> " for k in range(40)) + "</div></body>"
    text = main_text(page)
    assert [f"Part {k}" in text for k in range(3)] == [True] * 3 and "Link 7" not in text


STORY = "".join(f"<p>Paragraph {k} tells a part of the story in some words, and then in some more.</p>" for k in range(5))
OTHER = "".join(f"<p>Note {k} is shorter.</p>" for k in range(5))
LINKS = "".join(f"<a href=/{k}>Another page {k}</a> " for k in range(30))


def lines(*wanted):
    return [b for w in wanted for b in (main_text(f"<article>{w}</article>").split("\n\n") if "<" in w else [w])]


def test_a_title_above_the_article_stays():
    assert main_text(f"<main><h1>My Title</h1><article>{STORY}</article></main>").split("\n\n") == lines("My Title", STORY)
    page = f"<body><div>{LINKS}</div><h1>My Title</h1><div><div>{STORY}</div></div><div>{LINKS}</div></body>"
    assert main_text(page).split("\n\n") == lines("My Title", STORY)


def test_several_articles_stay():
    for second in (STORY, OTHER):
        page = f"<body><nav>{LINKS}</nav><article>{STORY}</article><article>{second}</article><div>{LINKS}</div></body>"
        assert main_text(page).split("\n\n") == lines(STORY, second)


def test_labels_that_say_more_than_boilerplate():
    for label in ("class='post-with-sidebar'", "id='search'", "class='form-of-life'"):
        assert main_text(f"<body><article {label}>{STORY}</article></body>").split("\n\n") == lines(STORY)
    parts = ("<h2 id='Related_work'>Related work</h2>", "<section id='search-methods'><p>How we searched.</p></section>",
             "<div class='banner-story'><p>The banner fell.</p></div>", "<div class='form-of-life'><p>Moss.</p></div>",
             "<section id='discussion'><h2 class='comments'>Comments</h2><p>We discuss.</p></section>")
    for part in parts:
        assert main_text(f"<body><article>{STORY}{part}{STORY}</article></body>").split("\n\n") == lines(STORY, part, STORY)


def test_pages_by_density_alone():
    """No article, no main, no label: the dense part is the text, lists of links and short parts aren't."""
    page = f"""<body><div><div>{LINKS}</div><table><tr><td><div>{LINKS}</div></td><td><div><div>{STORY}</div>
      <ul>{''.join(f'<li><a href={k}>See also the page number {k}</a></li>' for k in range(9))}</ul></div></td></tr></table></div>
      <div>Copyright</div></body>"""
    assert main_text(page).split("\n\n") == lines(STORY)
    inside = f"<article>{STORY}<div>{LINKS}</div>{STORY}</article>"
    assert main_text(inside).split("\n\n") == lines(STORY, STORY)
    main = f"<main><h1>Title</h1><p>By a writer</p>{STORY}<div>{LINKS}</div></main>"
    assert main_text(main).split("\n\n") == lines("Title", "By a writer", STORY)


def test_very_long_pages(spark):
    page = "<body>" + "<div>" * 500 + "<article>" + f"<p>{'words of a very long page ' * 40}</p>" * 2_000 + "</article>"
    rows = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert html_text.extract_text(rows).first().n_chars == 2_000 * len(("words of a very long page " * 40).strip()) + 2 * 1_999


def test_blocks_white_space_and_references():
    page = "<article><p>a\n b&nbsp;&nbsp;c<br>d<b>e</b>f</p><table><tr><td>x<td>y</table>&lt;p&gt; &#233; &nosuch;</article>"
    assert main_text(page) == "a b c def\n\nx\n\ny\n\n<p> é &nosuch;"


def test_broken_pages():
    for page, text in (("", ""), ("<p", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("1 < 2 <b>3", "1 < 2 3"),
                       ("<!-- <p>x", ""), ("<div>" * 3000 + "deep", "deep"), ("<script>x", ""), ("a<p title='>b'>c", "a\n\nc"),
                       ("<p title='never closed>b</p><p>c</p>", None)):
        got = main_text(page)
        assert text is None or got == text, (page[:40], got)
    assert main_text("<a '" * 20_000) is not None  # in linear time


def test_edges(spark):
    rows = [(1, "u", None, "t", 1), (1, "u", "", "t", 1), (None, None, "<p>x</p>", "t", 1), (2, "v", "<p>x</p>", None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    out = sorted(map(str, html_text.extract_text(frame).collect()))
    assert out == sorted(map(str, [
        "Row(page_id=1, url='u', text='', n_chars=0)", "Row(page_id=1, url='u', text='', n_chars=0)",
        "Row(page_id=None, url=None, text='x', n_chars=1)", "Row(page_id=2, url='v', text='x', n_chars=1)"]))
    assert html_text.extract_text(frame.limit(0)).count() == 0
