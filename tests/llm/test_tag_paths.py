import html
import re
import time

import pytest

from pubspark.llm import tag_paths as T
from tests.llm.edge import SF


def article(page):
    """The article's blocks of the synthetic pages, read off their known layout."""
    text = page.partition("<article>")[2].partition("</article>")[0]
    text = re.sub(r"<[^>]*$", "", text)
    parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", text))
    return "\n\n".join(p for p in parts if p)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    expected = {r.page_id: (r.url, t := article(r.html), len(t)) for r in pages.collect()}
    got = T.extract_pages(pages).collect()
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in got} == expected and len(got) == len(expected)


BODY = ("<div id=header><h1>Site</h1></div><div class='menu'><a href=x>a</a></div><div id=content><h2>Title here</h2>"
        "<p>This is a long text, with commas &amp; more. It goes on, and on.</p><p>Second part,\n also long&nbsp;enough. Yes.</p>"
        "<form>Search <input></form></div><div class='cookie-notice'>We use cookies, as all do, on this site.</div>"
        "<div class=sidebar><p>Side text, that is long, really long, with commas.</p></div>"
        "<section class='comments'><p>nice post, thanks, a lot.</p></section><div id=footer>c 2020</div>")


@pytest.mark.parametrize("page, text", [
    (f"<html><body>{BODY}</body></html>", "Title here\n\nThis is a long text, with commas & more. It goes on, and on.\n\n"
                                          "Second part, also long enough. Yes."),
    ("<article><p>a &lt b, and mo &am", "a < b, and mo &am"), ("<article><p>Hello there.</p><p cla", "Hello there."),
    ("<p>a < b and 3<4, ok.</p>", "a < b and 3<4, ok."), ("", ""), ("<article>x<!-- no -->y<!-- cut", "xy"),
    ("<body><script>if(a<b){'</p>'}</script><p>Real text, yes.</p><script>cut", "Real text, yes."),
    ("<article><p title='a>b'>Hi there, you.</p><style>p{}</style></article>", "Hi there, you."),
    ("<article><p>One<br>two,  three.</article>", "One two, three."), ("no markup, at all.", "no markup, at all.")])
def test_cases(page, text):
    assert T.main_text(page) == text


def test_hostile_markup_takes_linear_time():
    began = time.time()
    for h in ("<" * 50_000, "<a " * 50_000, "<a b='" * 30_000, "<!--" * 50_000, "</p>" * 50_000, "<b><p>" * 30_000,
              "<div>" * 20_000, '<a "' * 30_000, "<script>" * 20_000):
        T.main_text(h)
    assert time.time() - began < 40


def test_edges(spark):
    ddl = "page_id long, url string, html string, text string, n_chars long"
    rows = [(1, "u", None, "x", 5), (2, None, "", "x", 5), (3, "u", "<p>Hi, you.</p>", "x", 5), (3, "u", "<p>Hi, you.</p>", "x", 5),
            (None, "u", "<p>" + "word, " * 50_000, None, None)]
    got = T.extract_pages(spark.createDataFrame(rows, ddl)).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text[:8], r.n_chars) for r in got) == [
        (0, "u", "word, wo", 299_999), (1, "u", "", 0), (2, "", "", 0), (3, "u", "Hi, you.", 8), (3, "u", "Hi, you.", 8)]
    assert T.extract_pages(spark.createDataFrame([], ddl)).count() == 0


TEXT = "This is a long text, with commas, and more. It goes on, and on."


@pytest.mark.parametrize("wrapper", ["class='layout has-sidebar'", "class=no-sidebar", "class=with-header", "class=hidden-print",
                                     "class=social", "id=overlay"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_words_of_a_wrapper_do_not_hide_the_text(wrapper, tag):
    page = f"<body><div {wrapper}><{tag}><p>{TEXT}</p><p>{TEXT}</p></{tag}></div><div class=sidebar><p>{TEXT}</p></div></body>"
    assert T.main_text(page) == f"{TEXT}\n\n{TEXT}"


def test_topics_of_an_article_are_no_marks():
    page = (f"<article><p>{TEXT}</p><h2 id='related-work'>Related work</h2><p>{TEXT}</p><section id=advertising><p>{TEXT}</p>"
            f"</section><div class=share><p>{TEXT}</p></div></article>")
    assert T.main_text(page) == f"{TEXT}\n\nRelated work\n\n{TEXT}\n\n{TEXT}"


@pytest.mark.parametrize("page, text", [
    (f"<main><h1>Title</h1><div class=lead><p>{TEXT}</p></div><div class=story>{f'<p>{TEXT}</p>' * 9}</div></main>",
     ["Title", *[TEXT] * 10]),
    (f"<body><div class=a><h2>One</h2><p>{TEXT}</p></div><div class=b><h2>Two</h2>{f'<p>{TEXT}</p>' * 9}</div></body>",
     ["One", TEXT, "Two", *[TEXT] * 9]),
    (f"<body><div class=b>{'<div class=tag>x</div>' * 8}{f'<p>{TEXT}</p>' * 4}<div class=by>By me</div><p>{TEXT}</p>"
     f"{'<div class=end>x 1</div>' * 8}</div></body>", [*[TEXT] * 4, "By me", TEXT])])
def test_paths_select_the_text(page, text):
    assert T.main_text(page) == "\n\n".join(text)
